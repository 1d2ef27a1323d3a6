"""Vector codes against a plain full search."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from valuetide.llm import vectorcodes
from valuetide.llm.common import Recent

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    step = len(kept[0][1]) // parts
    cut = lambda v, k: v[k * step : (k + 1) * step]
    books = [[cut(v, k) for _, v, _ in kept[:entries]] for k in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda v, k: min(range(len(books[k])), key=lambda e: (apart(cut(v, k), books[k][e]), e))
    for _ in range(rounds):
        fresh = []
        for k in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[pick(v, k)].append(cut(v, k))
            mean = lambda e, old: [sum(c) // len(c) for c in zip(*members[e])] if members[e] else old  # noqa: E731, B023
            fresh.append([mean(e, old) for e, old in enumerate(books[k])])
        books = fresh
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, totals = [], defaultdict(int)
    for i, v, label in kept:
        picks = [pick(v, k) for k in range(parts)]
        error = sum(apart(cut(v, k), books[k][e]) for k, e in enumerate(picks))
        totals[label] += error
        out.append((i, "".join(f"{e:02x}" for e in picks), error, label))
    return sorted(((i, c, e, totals[label], sha) for i, c, e, label in out), key=repr)


def hard_rows():
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.2, (150, 32)).astype(np.float32)
    base[20:40] = np.round(base[20:40] * 4) / 4  # many ties
    base[50] *= 3000  # far from all others
    rows = [(int(i), v.tolist(), int(i) % 3 if i % 5 else None) for i, v in zip(rng.permutation(150) * 2, base)]
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1], 1), (None, rows[6][1], 2), (None, rows[7][1], None)]
    rows += [(-5, None, 1), (-4, [], 1), (-3, [None] * 32, 1), (-2, [math.nan] * 32, 1), (-1, [1.0, math.inf] * 16, 2)]
    return rows


def compressed(spark, rows, *args, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' AS code", "1 AS part", "'x' AS __n").repartition(4)
    return sorted(map(tuple, vectorcodes.compress(df, *args, **kwargs).collect()), key=repr)


@pytest.mark.parametrize("entries, rounds", [(64, 2), (7, 3), (256, 1)])
def test_codes_of_hard_rows(spark, entries, rounds):
    rows = hard_rows()
    assert compressed(spark, rows, entries=entries, rounds=rounds) == plain(rows, 16, entries, rounds)


def test_a_task_of_many_batches(spark):
    """The memo of a task outlives a batch: later ones meet cells that are known and cells that are not."""
    rows = hard_rows()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert compressed(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_memo_of_arrays():
    recent = Recent(lambda keys: [np.arange(k) for k in keys], 100)
    assert [len(v) for v in recent([2, 3])] == [2, 3]
    assert [len(v) for v in recent([3, 2, 4])] == [3, 2, 4]


def test_vectors_of_other_sizes_go(spark):
    rows = hard_rows()
    assert compressed(spark, [*rows, (-9, [0.5] * 16, 1)]) == plain(rows)


def test_few_rows_and_none(spark):
    rows = [(2, [0.1, 0.2] * 16, 1), (1, [0.3, -0.2] * 16, 1)]
    assert compressed(spark, rows) == plain(rows)
    assert compressed(spark, rows[:0]) == [] and compressed(spark, [(1, None, 1)]) == []


def test_many_labels_and_a_hot_one(spark):
    rows = [(k, [k / 64, -k / 32], 0 if k % 3 == 0 else k if k % 7 else None) for k in range(300)]
    coded = spark.createDataFrame([(k, label, f"{k:02x}", k) for k, _, label in rows], "vec_id long, label int, code string, error long")
    few = sorted(map(tuple, vectorcodes.with_label_errors(coded).collect()), key=repr)
    many = sorted(map(tuple, vectorcodes.with_label_errors(coded, small=1).collect()), key=repr)
    assert few == many and len(few) == 300


def test_memo_gives_what_a_full_search_gives():
    rng = np.random.default_rng(2)
    for spread in (1, 30, 1 << 20):
        book = rng.integers(-spread, spread + 1, (64, 4))
        rows = rng.integers(-2 * spread, 2 * spread + 1, (5000, 4))
        cells = vectorcodes.Cells(book, memo=50)
        for part in (rows[:2500], rows[2500:], book):
            index, apart = cells.nearest(part)
            full = ((part[:, None] - book) ** 2).sum(-1)
            assert (index == full.argmin(1)).all() and (apart == full.min(1)).all()


def test_cells_keep_few_entries():
    rng = np.random.default_rng(9)
    cells = vectorcodes.Cells(rng.integers(-100, 100, (64, 4)))
    cells.nearest(rng.integers(-100, 100, (4000, 4)))
    assert np.mean([len(k) for k in cells.memo.young.values()]) < 24


def test_codes_decode_to_entries():
    books = [np.array([[1, 2], [3, 4]]), np.array([[5], [6]])]
    assert vectorcodes.decode("0100", books) == [3, 4, 5]
    assert vectorcodes.edges(10, 4) == [0, 2, 5, 7, 10]


def test_large_components_are_cut_and_do_not_overflow(spark):
    rows = [(k, [1e30 * (-1) ** k] * 32, 1) for k in range(70)] + [(99, [0.0] * 32, 1)]
    got = compressed(spark, rows)
    assert len(got) == 71 and all(r[2] >= 0 for r in got)
