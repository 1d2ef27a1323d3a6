"""Each operator against a plain version of its contract, on hard and small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.compare import connect, differences
from valuetide.llm import (
    binary,
    classifier,
    decontam,
    mixing,
    quality,
    queries,
    secrets,
    simhash,
    suffixdedup,
    tokencount,
)
from valuetide.llm.common import row_key

from .conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(*names):
    return pytest.mark.parametrize("table", names or ("hard", "small"))


@pytest.fixture
def docs(request, table):
    return request.getfixturevalue(table)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    found = differences(queries.queries()[name](spark, SMALL), connect(SMALL), queries.oracle_sql()[name])
    assert not found


def test_empty_tables_give_no_rows(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    for frame in (
        secrets.secret_spans(none),
        mixing.mixed_words(none),
        mixing.mix(none),
        simhash.fingerprint_components(none),
        simhash.drop_near_duplicates(none),
        quality.apply_rules(none),
        tokencount.token_counts(none),
        suffixdedup.removed_bytes(none),
        classifier.quality_scores(none, labels),
        binary.token_files(none),
        decontam.overlap_counts(none, items),
        decontam.decontaminate(none, items),
    ):
        assert frame.collect() == []


# --- 1: secrets


def base_spans(text):
    kinds = (
        ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    )
    found = []
    for place, (kind, pattern, group, least) in enumerate(kinds):
        flags = re.I | re.A if kind == "assign" else 0
        for m in re.finditer(pattern, text, flags):
            if len(m[group]) >= least:
                found.append((m.start(), place, m.end(), kind))
    return sorted(found)


def high_windows(text):
    """Runs of high-entropy windows, each window's entropy counted from scratch."""
    found = []
    for m in re.finditer(secrets.CANDIDATE, text):
        own = m[0]
        if any(re.search(p, own) for p in secrets.ALLOWED):
            continue
        fake = "|".join(secrets.PLACE_HOLDERS)
        bits = next(bits for chars, bits in secrets.CLASSES if re.search(chars, own))
        for i in range(len(own) - secrets.WINDOW + 1):
            counts = Counter(own[i : i + secrets.WINDOW]).values()
            window = own[i : i + secrets.WINDOW]
            if sum(secrets.TERMS[c] for c in counts) <= secrets.highest_sum(bits) and not re.search(fake, window):
                a, b = m.start() + i, m.start() + i + secrets.WINDOW
                if found and found[-1][1] >= a:
                    found[-1][1] = b
                else:
                    found.append([a, b])
    return found


@both()
def test_secrets(docs):
    want = []
    for doc_id, text in pairs(docs):
        base = base_spans(text or "")
        name = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        extra = [
            (a, 3, b, "entropy")
            for a, b in high_windows(text or "")
            if not any(x <= a and b <= y for x, _, y, _ in base)
        ]
        counts = [sum(s[3] == k for s in base) for k in secrets.KINDS[:3]]
        digest = hashlib.sha256(name(base).encode()).hexdigest()
        want.append((doc_id, *counts, digest, name(base + extra), len(extra)))
    assert rows(secrets.secret_spans(docs)) == sorted(want, key=repr)


def test_long_candidates_are_scanned_whole(spark):
    rng = np.random.default_rng(5)
    chars = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    blob = "".join(rng.choice(chars, 2500)) + "a" * 1500 + "".join(rng.choice(chars, 500))
    many = " ".join(f"AKIA{'Z' * 14}{k}" for k in range(2500))
    df = spark.createDataFrame([(1, "é " + blob), (2, many)], "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    assert [[s.start, s.end] for s in got[1].entropy] == high_windows("é " + blob)
    assert [(s.start, s.end) for s in got[2].access] == [m.span() for m in re.finditer(secrets.ACCESS, many)]


def test_place_holders_bar_their_windows_only(spark):
    key = "zX9kQ2vB7mN4pL8wR3tY6uI1oP5aS0dF"
    texts = [f"path/example/{key}", f"{key}xXxx{key[::-1]}", "your/example/of/placeholder9", key.replace("7mN4", "XXXX")[:20]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [[s.start, s.end] for s in r.entropy] for r in secrets.scan(df).collect()}
    assert got == {k: high_windows(t) for k, t in enumerate(texts)}
    assert got[0][-1][1] == len(texts[0]) and got[0][0][0] > 5
    assert len(got[1]) == 1 and got[2] == got[3] == []


# --- 2: mixing


@both()
def test_mix_meets_targets(docs):
    plan = mixing.plan_mix(docs).collect()
    sizes = defaultdict(int)
    for r in plan:
        sizes[r.source] += r.size
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    goal, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        unit = rest / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * unit > 2 * sizes[s]}
        if not full:
            goal |= {s: weight[s] * unit for s in free}
            break
        goal |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        free -= full
    largest, taken = defaultdict(int), defaultdict(int)
    for r in plan:
        assert 0 <= r.copies <= 2
        assert math.isclose(r.target, goal[r.source], rel_tol=1e-9, abs_tol=1e-6)
        largest[r.source] = max(largest[r.source], r.size)
        taken[r.source] += r.copies * r.size
    for s in names:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1
    assert sorted((r.doc_id or -1, r.key) for r in plan) == sorted(
        (r.doc_id or -1, r.key) for r in docs.select("doc_id", row_key().alias("key")).collect()
    )


@both()
def test_mix_gives_the_planned_rows_each_time(docs):
    want = Counter()
    for r in mixing.plan_mix(docs).collect():
        want[r.doc_id, r.key] += r.copies
    for _ in range(2):
        got = mixing.mix(docs)
        assert got.columns == docs.columns
        assert Counter((r.doc_id, r.key) for r in got.select("doc_id", row_key().alias("key")).collect()) == +want


def test_mix_does_not_depend_on_partitions(small):
    one = rows(mixing.mixed_words(small.coalesce(1)))
    assert one == rows(mixing.mixed_words(small.repartition(7, "n_chars")))


# --- 3: SimHash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """A label for each (doc_id, print); equal where links of two bits join them."""
    group = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 2 and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    return group


def plain_components(prints):
    """(doc_id, print) with the smallest id that can be reached."""
    group, least = plain_groups(prints), {}
    for (doc_id, _), g in zip(prints, group):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return [(d, f"{p:016x}", least.get(g)) for (d, p), g in zip(prints, group)]


@both()
def test_simhash(docs):
    want = plain_components([(d, plain_print(t)) for d, t in pairs(docs)])
    assert rows(simhash.fingerprint_components(docs)) == sorted(want, key=repr)


@both()
def test_dedup_keeps_one_of_each_component(docs):
    prints = [(d, plain_print(t)) for d, t in pairs(docs)]
    least = {}
    for (doc_id, _), g in zip(prints, plain_groups(prints)):
        least[g] = min(least.get(g, math.inf), math.inf if doc_id is None else doc_id)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = Counter(None if x == math.inf else x for x in least.values())
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_golay_keys_meet_for_all_errors_of_two_bits():
    rng = np.random.default_rng(1)
    for value in rng.integers(0, 1 << 64, 5, np.uint64):
        masks = [1 << i | 1 << j for i in range(64) for j in range(i + 1)]
        near = np.append(value, value ^ np.array(masks, np.uint64))
        of, keys = simhash.fuzzy_keys(near)
        assert np.bincount(of).max() <= 18
        own = set(keys[of == 0].tolist())
        assert all(own & set(keys[of == k].tolist()) for k in range(1, len(near)))


@pytest.mark.parametrize("small_keys", [0, 3, 64])
def test_links_are_whole_for_crowded_keys(spark, small_keys):
    rng = np.random.default_rng(2)
    prints = set()
    for centre in rng.integers(0, 1 << 64, 3, np.uint64).tolist():
        for _ in range(80):
            prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)]
    df = spark.createDataFrame(signed, "fingerprint long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, small_keys)).collect()}
    want = plain_components([(k, p) for k, p in enumerate(sorted(prints))])
    classes = defaultdict(set)
    for (k, _, root), (p,) in zip(want, signed):
        classes[root].add(p)
    got = defaultdict(set)
    for (p,) in signed:
        got[roots.get(p, p)].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id * 7 % 201 AS a", "(id + 1) * 7 % 201 AS b")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len(got) == 200 and set(got.values()) == {0}


# --- 4: quality rules


def plain_quality(docs):
    data = [(r.doc_id, r.text or "", r.source) for r in docs.select("doc_id", "text", "source").collect()]
    normal = lambda x: re.sub(
        "[0-9]+", "0", re.sub(r"[\x20\x09-\x0D]+", " ", x.translate({c: c + 32 for c in range(65, 91)}))
    ).strip(" ")
    lines = [[x for x in t.split("\n") if WORD.search(x)] for _, t, _ in data]
    held = Counter((s, x) for (_, _, s), ls in zip(data, lines) for x in {normal(x) for x in ls})
    out = []
    for (doc_id, text, source), ls in zip(data, lines):
        words = WORD.findall(text)
        places = defaultdict(list)
        for k in range(len(words) - 2):
            places[tuple(words[k : k + 3])].append(k)
        covered = {k + i for ks in places.values() if len(ks) > 1 for k in ks for i in range(3)}
        lost = sum(
            len(WORD.findall(x)) for x in ls if held[source, normal(x)] >= quality.MIN_DOCS
        )
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        kept = not failed and len(words) - lost >= quality.MIN_LEFT * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append(
            (doc_id, len(words), sum(map(len, words)), symbols, len(ls) - len(set(ls)), len(covered), failed, kept, lost)
        )
    return out


@both()
def test_quality_rules(docs):
    assert rows(quality.apply_rules(docs)) == sorted(plain_quality(docs), key=repr)


def test_lines_of_many_documents_are_removed(spark):
    name = lambda n: chr(97 + n // 26) + chr(97 + n % 26)  # noqa: E731  digits fold to one
    own = [" ".join(name(k) + "x" + name(i) for i in range(60)) for k in range(60)]
    shared = "All Rights reserved 2024 by the  owner of this site and nobody else " * 3
    texts = [f"{t}\n{shared}" if k < 30 else t for k, t in enumerate(own)]
    texts += [f"{shared}\n{shared} \n" + " ".join(own[k].split()[:55]) for k in range(5)]
    data = [(k, t, "a") for k, t in enumerate(texts)] + [(99, texts[0], "b")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = quality.apply_rules(df)
    assert rows(got) == sorted(plain_quality(df), key=repr)
    assert {r.doc_id for r in got.collect() if not r.kept} == {60, 61, 62, 63, 64}


def test_hot_and_small_hosts_are_treated_alike(spark):
    """A notice in three documents goes from a host of 4 and from one of 3,000; two copies stay."""
    own = lambda k: " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    notice = " ".join(f"term{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    data = [(k, own(k), "hot") for k in range(3000)] + [(5000, own(1), "small")]
    data += [(6000 + k, f"{notice}\n{own(3000 + k)[:150]}", h) for k, h in enumerate(["hot"] * 3 + ["small"] * 3)]
    data += [(7000, own(4000), "small"), (7001, own(4000), "small")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality.apply_rules(df).collect()}
    assert {i for i, r in got.items() if not r.kept and not r.base_failed} == set(range(6000, 6006))
    assert got[7000].kept and got[7001].kept and got[5000].kept


# --- 5: token counts


@both()
def test_token_counts(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(binary.public_tokenizer("word_bpe_49k.json")())
    want = []
    for doc_id, text in pairs(docs):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    assert rows(tokencount.token_counts(docs)) == sorted(want, key=repr)


def test_plain_characters_split_as_in_the_library():
    from tokenizers import Tokenizer

    rng = np.random.default_rng(7)
    signs = [c for c in map(chr, range(0x250)) if binary.PLAIN.fullmatch(c)]
    texts = ["".join(rng.choice(signs, 60)) for _ in range(300)]
    texts += ["".join(rng.choice(list("a's 1\n\t '!dlvemt<|>"), 40)) for _ in range(300)]
    count = tokencount.Counts(binary.public_tokenizer("word_bpe_49k.json")(), {})
    encode = binary.Encoder(binary.public_tokenizer("byte_bpe_50k.json")())
    for text in texts:
        assert count(text) == len(count.library.encode(text, add_special_tokens=False).ids), text
        assert encode(text) == encode.ids(text), text
    assert isinstance(count.library, Tokenizer)


def test_packed_table_is_read_back():
    table = {"the": 1, "ñandú": 3, "!!": 1}
    assert tokencount.unpack(tokencount.pack(table)) == table


# --- 6: duplicate substrings


def plain_removed(docs):
    data = [(d, (t or "").encode()) for d, t in pairs(docs)]
    length = suffixdedup.LENGTH
    starts = Counter(hash(t[i : i + length]) for _, t in data for i in range(len(t) - length + 1))
    out = []
    for doc_id, text in data:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if starts[hash(text[i : i + length])] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    owners = defaultdict(set)
    strings = []
    for doc_id, text in data:
        words = text.split()
        strings.append([tuple(words[k : k + 51]) for k in range(len(words) - 50)])
        for s in strings[-1]:
            owners[s].add((doc_id, text))
    return [(*row, sum(len(owners[s]) > 1 for s in own)) for row, own in zip(out, strings)]


@both()
@pytest.mark.parametrize("group", [suffixdedup.GROUP, 1])
def test_duplicate_substrings(docs, group):
    assert rows(suffixdedup.removed_bytes(docs, group)) == sorted(plain_removed(docs), key=repr)


@both()
def test_passages_without_broadcast(docs):
    from valuetide.llm import passages

    numbered = docs.select(F.xxhash64(F.col("doc_id").isNull(), "doc_id", row_key()).alias("row"), "text")
    one = rows(passages.shared_passages(numbered))
    assert one and one == rows(passages.shared_passages(numbered, most_anchors=0))


def test_suffix_order_is_that_of_plain_sorting():
    rng = np.random.default_rng(3)
    for letters in (2, 4):
        parts = [bytes(rng.integers(97, 97 + letters, n, np.uint8)) for n in (30, 45, 60)]
        counts = [len(p) - 19 for p in parts]
        got = suffixdedup.suffix_order(parts, counts, 20)
        text = lambda x: parts[x[0]][x[1] : x[1] + 20]
        assert sorted(got) == [(p, i) for p, n in enumerate(counts) for i in range(n)]
        assert list(map(text, got)) == sorted(map(text, got))


def test_windows_across_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 123, n, np.uint8)) for n in (300, 400, 5000, 9000)]
    whole = list(suffixdedup._joined_windows(texts))
    monkeypatch.setattr(suffixdedup, "PIECE", 700)
    assert [w[:4] for w in suffixdedup._joined_windows(texts)] == [w[:4] for w in whole]
    assert sum(w[2] for w in whole) == sum(max(0, len(t) - 399) for t in texts)


# --- 7: classifier


def test_scores_rank_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [(r.score, r.quality) for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.95
    right = sum((s >= 0.3) == (q == 1) for s, q in held)
    assert right / len(held) > 0.95


def test_held_out_labels_do_not_matter(spark, small):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.withColumn(
        "quality", F.when(F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0"), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert np.array_equal(classifier.train(small, labels), classifier.train(small, flipped))


def test_scores_of_hard_rows(spark, hard):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(14)] + [(None, 1, 1), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    got = classifier.quality_scores(hard, labels).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    kept = classifier.keep_quality(hard, labels)
    assert kept.columns == hard.columns and kept.count() == sum(r.predicted for r in got)
    blank = classifier.quality_scores(hard, labels.limit(0)).collect()
    assert {r.score for r in blank} == {0.5}


# --- 8: token files


def plain_ids(text):
    encode = binary.Encoder(binary.public_tokenizer("byte_bpe_50k.json")())
    return encode.library.encode(text or "", add_special_tokens=False).ids + [0]


@both()
def test_token_files(docs):
    data = sorted(pairs(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    want, start = [], 0
    for doc_id, text in data:
        ids = plain_ids(text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in binary.token_files(docs).collect()), key=lambda r: r[1]) == want


def test_shards_are_mapped_and_follow_each_other(spark, small, tmp_path):
    path = str(tmp_path / "tokens")
    manifest = binary.write_tokens(small, path, binary.public_tokenizer("byte_bpe_50k.json"), shards=5)
    base, ids = 0, []
    for m in manifest.orderBy("shard").collect():
        tokens, offsets, names, absent = binary.open_shard(path, m.shard)
        assert isinstance(tokens, np.memmap) and tokens.dtype == np.uint16
        assert m.base == base and len(tokens) == m.n_ids and not absent.any()
        ids += names.tolist()
        base += m.n_ids
    assert ids == sorted(ids) and len(ids) == small.count()


# --- 10: decontamination


def plain_overlaps(docs, items):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = defaultdict(set)
    for name, text in items:
        words = fold(text)
        for k in range(max(1, len(words) - 9)) if words else ():
            windows[tuple(words[k : k + 10])].add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in pairs(docs):
        words = fold(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if (owners := windows.get(tuple(words[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


@pytest.fixture(scope="module")
def items(spark):
    rows = spark.read.parquet(f"{SMALL}/benchmark.parquet").selectExpr("item_id", "text").collect()
    words = "alphas betas beta alpha delta x 1234 Gamma zeta ñandú epsilon De De De De De De De De De De De one two".split()
    extra = [(1000 + k, " ".join(words[k : k + n])) for k in range(0, 20, 3) for n in (1, 3, 11)]
    extra += [(2000, None), (2001, ""), (2002, "..."), (None, "line a line a line b line a line a line b"), (2003, "One, TWO")]
    return spark.createDataFrame([tuple(r) for r in rows] + extra, "item_id long, text string")


@both()
@pytest.mark.parametrize("block_words", [100_000, 40])
def test_overlaps(docs, items, block_words):
    found = decontam.find_overlaps(docs, items, block_words=block_words)
    got = found.select(
        "doc_id",
        "n_words",
        decontam.n_hit("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("sha"),
        (F.size("spans") > 0).alias("hit"),
    )
    want = plain_overlaps(docs, [tuple(r) for r in items.collect()])
    assert rows(got) == sorted(want, key=repr)
    if block_words == 100_000:
        assert rows(decontam.overlap_counts(docs, items)) == sorted(want, key=repr)


def test_passages_are_cut_and_spent_documents_go(spark):
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    long = " ".join(f"word{k}" for k in range(40))
    data = [(1, f"{long}. {item.upper()}! {long}", 5), (2, item, 5), (3, long, 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontam.decontaminate(df, bench).collect()}
    assert set(got) == {1, 3} and got[3].n_chars == 5
    assert got[1].text == f"{long}. ! {long}" and got[1].n_chars == len(got[1].text)
    assert [r.doc_id for r in decontam.decontaminate(df, bench, coverage=0.0).collect()] == [3]


def test_texts_of_a_batch_are_encoded_in_portions():
    """No list holds more than a portion beside its first text; order, NULL and long texts are kept."""
    import pyarrow as pa

    from valuetide.llm import binary

    texts = [None, "", "a" * 30, "ä" * 40, None, *["word " * (k % 7) for k in range(200)], "b" * 500, "c"]
    parts = list(binary.portions(pa.array(texts, pa.string()), 100))
    assert [t for p in parts for t in p] == [t or "" for t in texts]
    assert len(parts) > 10 and all(sum(len(t.encode()) for t in p[1:]) <= 100 for p in parts)
    assert list(binary.portions(pa.array(["x", None], pa.string()))) == [["x", ""]]
