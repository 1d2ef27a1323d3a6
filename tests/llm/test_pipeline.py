"""The pipeline stage by stage against plain versions, on the small table with planted cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from valuetide.llm import binary, simhash

from .conftest import SCHEMA, SMALL


def words(text):
    fold = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small table, exact and near copies, leaks of two items, NULLs and clashing columns."""
    base = tmp_path_factory.mktemp("corpus")
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    leaks = [r.text for r in items.collect() if len(words(r.text)) >= 10][:2]
    long = [d for d in docs if len((d[1] or "").split()) > 200][:12]
    extra = [(10_000 + k, d[1], d[2], d[3], d[4]) for k, d in enumerate(long)]
    extra += [(11_000 + k, d[1] + " end", d[2], None, d[4]) for k, d in enumerate(long)]
    extra += [(12_000 + k, f"{long[k][1]} {t}", "en", "src1", 0) for k, t in enumerate(leaks)]
    extra += [(13_000, None, None, None, None), (13_001, "", "en", "a", 0), (None, "no id at all " * 30, "en", "b", 9)]
    df = spark.createDataFrame(docs + extra, SCHEMA).selectExpr("*", "'own' AS key", "1 AS copies", "2 AS fingerprint")
    df.repartition(4).write.parquet(f"{base}/documents.parquet")
    items.write.parquet(f"{base}/benchmark.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{base}/labels.parquet")
    return str(base)


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def plain_heads(data):
    """First (id, key order aside) of each component of fingerprints at two or fewer bits."""
    prints = sorted({simhash.fingerprint((t or "").encode()) for _, t in data})
    group = {p: p for p in prints}
    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= 2 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {p: new if g == old else g for p, g in group.items()}
    heads = {}
    for i, t in data:
        g = group[simhash.fingerprint((t or "").encode())]
        heads[g] = min(heads.get(g, (True, 0)), (i is None, i or 0))
    return sorted(heads.values())


def test_every_stage_does_what_its_plain_version_does(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/out-{k}"
        stage(spark, held[-1], folder).write.parquet(path)
        held.append(spark.read.parquet(path))
        if name != "token_files":
            assert held[-1].columns == columns
    scored = corpus_pipeline.classifier.quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good, near, clean, mixed, tokens = held[1:]
    want = Counter(r.doc_id for r in scored.collect() if r.predicted)
    assert Counter(i for i, _ in rows(good)) == want and len(want) > 100

    assert sorted((i is None, i or 0) for i, _ in rows(near)) == plain_heads(rows(good))

    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    leaky = lambda t: any(tuple(words(t)[k : k + n]) in windows for n in sizes for k in range(len(words(t)) - n + 1))
    assert Counter(rows(clean)) == Counter(x for x in rows(near) if not leaky(x[1]))

    taken = Counter(rows(mixed))
    assert set(taken) <= set(rows(clean)) and max(taken.values()) <= 2
    plan = {r.doc_id: r for r in corpus_pipeline.mixing.mixed_words(clean).collect()}
    for (i, t), n in taken.items():
        assert n * len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) == plan[i].taken

    library = Tokenizer.from_file(binary.public_tokenizer("byte_bpe_50k.json")())
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids + [0]
    sums = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in rows(mixed) for x in [ids(t)])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.collect()) == sums

    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, tokens.collect()), key=repr)


def test_empty_tables_pass_through(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
