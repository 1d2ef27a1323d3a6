"""Vector codes by integer product quantisation, with memoised grid cells.

Vectors become integers and are cut into parts; each part has a codebook of a
few entries and is coded by the nearest one.  Instead of measuring a part
against all entries, the part's coarse grid cell is looked up in a memo.  A
cell is a box; an entry whose least distance to the box exceeds the smallest
of all entries' greatest distances can be nearest nowhere in it.  The entries
that remain are kept for the cell, and only they are measured, exactly and in
integers.  Ties go to the lower index, so an entry is dominated only by one
that is strictly nearer in the whole box: the codes are those of a full search
whatever the cells' width.

Codebooks are fitted by rounds over all rows.  A task sends its sums a part,
entry and component; Spark adds them up, and only the sums' totals, as many as
the codebooks have components, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Recent, store

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
MEMO_CELLS = 65_536
SMALL_LABELS = 100_000
HOT_SHARE = 1_000
SALTS = 64

Books = list[np.ndarray]  # for each part its entries as rows of integers


def edges(size: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; equal ones where the size allows it."""
    return [size * k // parts for k in range(parts + 1)]


def largest(size: int) -> int:
    """Greatest component for which a vector's squared distance fits a long."""
    return 1 << ((62 - max(size, 1).bit_length()) // 2 - 1)


def integers(column: pa.Array, size: int, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(places, rows): the vectors of ``size`` finite components, scaled and floored."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    places = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = column.filter(fits).flatten().to_numpy(zero_copy_only=False)
    values = flat.astype(np.float64, copy=False).reshape(len(places), size)
    finite = np.isfinite(values).all(axis=1)
    most = largest(size)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values[finite] * scale), -most, most)
    return places[finite], whole.astype(np.int64)


class Cells:
    """Nearest entries of one part's codebook through a memo of grid cells."""

    def __init__(self, book: np.ndarray, memo: int = MEMO_CELLS):
        self.book = book
        # About half the typical gap between neighbouring entries, as a power of two.
        gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(-1).astype(np.float64)
        np.fill_diagonal(gaps, np.inf)
        near = np.sqrt(np.min(gaps, axis=1)) if len(book) > 1 else np.ones(1)
        near = near[np.isfinite(near) & (near > 0)]
        self.shift = max(0, int(np.median(near)).bit_length() - 1) if len(near) else 0
        self.memo = Recent(self.undominated, memo)

    def undominated(self, cells: list[bytes]) -> list[bytes]:
        """For each cell the entries that may be nearest somewhere in its box, a byte each."""
        if not cells:
            return []
        low = np.frombuffer(b"".join(cells), np.int64).reshape(len(cells), 1, -1) << self.shift
        high = low + (1 << self.shift) - 1
        below, above = low - self.book, self.book - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(-1)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(-1)
        keep = least <= most.min(axis=1, keepdims=True)
        _, entries = np.nonzero(keep)
        entries, ends = entries.astype(np.uint8).tobytes(), np.cumsum(keep.sum(axis=1)).tolist()
        return [entries[a:b] for a, b in zip([0, *ends], ends)]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        index = np.zeros(len(rows), np.int64)
        if not rows.size:
            return index, np.zeros(len(rows), np.int64)
        cells, of = _distinct(rows >> self.shift)
        kept = self.memo([c.tobytes() for c in cells])
        counts = np.fromiter(map(len, kept), np.int64, len(kept))
        entries, first = np.frombuffer(b"".join(kept), np.uint8), np.cumsum(counts) - counts
        widths = 1 << np.ceil(np.log2(counts)).astype(np.int64)
        for width in np.unique(widths):
            # Cells of similar counts go together; the first entry fills up short lists.
            some = np.flatnonzero(widths == width)
            table = np.empty((len(cells), width), np.int32)
            slots = np.arange(width)
            table[some] = entries[first[some, None] + np.where(slots < counts[some, None], slots, 0)]
            members = np.flatnonzero(widths[of] == width)
            if width == 1:
                index[members] = table[of[members], 0]
                continue
            step = max(1, (1 << 20) // (width * rows.shape[1]))
            for k in range(0, len(members), step):
                own = members[k : k + step]
                tried = table[of[own]]
                apart = ((rows[own, None, :] - self.book[tried]) ** 2).sum(-1)
                index[own] = tried[np.arange(len(own)), apart.argmin(axis=1)]
        return index, ((rows - self.book[index]) ** 2).sum(axis=1)


def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and for each row the number of its distinct one."""
    low = cells.min(axis=0)
    spans = cells.max(axis=0) - low + 1
    if float(np.prod(spans.astype(np.float64))) < 2**62:
        keys = np.zeros(len(cells), np.int64)
        for k in range(cells.shape[1]):
            keys = keys * spans[k] + (cells[:, k] - low[k])
        _, first, of = np.unique(keys, return_index=True, return_inverse=True)
        return np.ascontiguousarray(cells[first]), of
    found, of = np.unique(cells, axis=0, return_inverse=True)
    return found, of.reshape(-1)


class Coder:
    """Codes of whole vectors; one for each task, so that its memos serve all batches."""

    def __init__(self, books: Books):
        sizes = [b.shape[1] for b in books]
        self.cuts = np.concatenate(([0], np.cumsum(sizes))).tolist()
        self.cells = [Cells(b) for b in books]

    def __call__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, errors): an index a part, and the sum of the squared distances."""
        codes = np.zeros((len(rows), len(self.cells)), np.int64)
        errors = np.zeros(len(rows), np.int64)
        for k, cells in enumerate(self.cells):
            codes[:, k], apart = cells.nearest(np.ascontiguousarray(rows[:, self.cuts[k] : self.cuts[k + 1]]))
            errors += apart
        return codes, errors


def common_size(vectors: DataFrame) -> int | None:
    """The commonest number of components, the larger one of equals; None for no vectors."""
    sizes = vectors.select(F.size("vector").alias("n")).filter("n > 0").groupBy("n").count()
    first = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return first and first.n


def first_rows(vectors: DataFrame, size: int, count: int) -> np.ndarray:
    """The integers of the ``count`` smallest ids, in their order.

    A task keeps as many rows of its own, these are dealt by id, and each
    receiving task keeps as many again, so no task and not the driver gets more
    than that from any other.
    """
    kind = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for batch in batches:
            places, rows = integers(batch.column(1), size)
            ids = batch.column(0).take(pa.array(places)).to_pylist()
            rest = [(i is None, i or 0, r) for i, r in zip(ids, rows.tolist())]
            best = sorted(best + rest)[:count]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if none else i for none, i, _ in best], kind),
                pa.array([r for *_, r in best], pa.list_(kind)),
            ],
            ["vec_id", "whole"],
        )

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for batch in batches:
            rest = [(i is None, i or 0, r) for i, r in zip(*(c.to_pylist() for c in batch.columns))]
            best = sorted(best + rest)[:count]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if none else i for none, i, _ in best], kind),
                pa.array([r for *_, r in best], pa.list_(kind)),
            ],
            ["vec_id", "whole"],
        )

    schema = "vec_id long, whole array<long>"
    own = vectors.select("vec_id", "vector").mapInArrow(run, schema)
    dealt = own.repartition(F.xxhash64("vec_id")).mapInArrow(again, schema)
    rows = dealt.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(count).collect()
    return np.array([r.whole for r in rows], np.int64).reshape(len(rows), size)


def refine(vectors: DataFrame, size: int, books: Books) -> Books:
    """Each entry replaced by the floored mean of the parts nearest to it; unused ones stay."""
    cuts = edges(size, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            _, rows = integers(batch.column(0), size)
            codes, _ = coder(rows)
            for k, (n, s) in enumerate(zip(counts, sums)):
                n += np.bincount(codes[:, k], minlength=len(n))
                np.add.at(s, codes[:, k], rows[:, cuts[k] : cuts[k + 1]])
        for k, (n, s) in enumerate(zip(counts, sums)):
            used, width = np.flatnonzero(n), s.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used) * width, k), pa.int32()),
                    pa.array(np.repeat(used, width), pa.int32()),
                    pa.array(np.tile(np.arange(width), len(used)), pa.int32()),
                    pa.array(np.repeat(n[used], width)),
                    pa.array(s[used].reshape(-1)),
                ],
                ["part", "entry", "place", "n", "s"],
            )

    sums = vectors.select("vector").mapInArrow(run, "part int, entry int, place int, n long, s long")
    # As many rows as the codebooks have components.
    totals = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    fresh = [b.copy() for b in books]
    for r in totals.collect():
        fresh[r.part][r.entry, r.place] = r.s // r.n
    return fresh


def fit(
    vectors: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Books:
    """Codebooks of ``vectors`` (vec_id, vector) whose vectors have ``size`` components."""
    seeds = first_rows(vectors, size, entries)
    cuts = edges(size, parts)
    books = [np.ascontiguousarray(seeds[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    for _ in range(rounds if len(seeds) else 0):
        books = refine(vectors, size, books)
    return books


def encode(vectors: DataFrame, size: int, books: Books) -> DataFrame:
    """(vec_id, label, code, error) of the rows whose vectors can be coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for batch in batches:
            places, rows = integers(batch.column(2), size)
            codes, errors = coder(rows)
            digits = codes.astype(np.uint8).tobytes().hex()
            step = 2 * len(books)
            own = pa.array(places)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(own),
                    batch.column(1).take(own),
                    pa.array([digits[k * step : (k + 1) * step] for k in range(len(places))], pa.string()),
                    pa.array(errors),
                ],
                ["vec_id", "label", "code", "error"],
            )

    rows = vectors.select("vec_id", "label", "vector")
    own = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    schema = T.StructType([*rows.schema.fields[:2], *own])
    return rows.mapInArrow(run, schema)


def decode(code: str, books: Books) -> list[int]:
    """The integers that a code stands for."""
    picks = bytes.fromhex(code)
    return [int(x) for b, k in zip(books, picks) for x in b[k]]


def codebooks_sha256(books: Books) -> str:
    text = ",".join(str(x) for b in books for x in b.reshape(-1).tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_errors(coded: DataFrame, small: int = SMALL_LABELS) -> DataFrame:
    """``coded`` with the error summed over its label's rows, NULL labels together.

    Up to ``small`` labels their sums are broadcast.  Beyond that rows and sums
    meet by label; the at most ``HOT_SHARE`` labels that hold more than such a
    share of all rows are dealt out over ``SALTS`` tasks each.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(
        F.least(total, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long").alias("label_error"),
        F.count(F.lit(1)).alias("__n"),
    )
    sums = store(sums, "labels").withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    n_labels, n_rows = sums.agg(F.count(F.lit(1)), F.sum("__n")).first()
    if n_labels <= small:
        return coded.join(F.broadcast(sums), same).drop("__label", "__n")
    limit = n_rows // HOT_SHARE + 1
    hot = sums.filter(F.col("__n") > limit).select(F.col("__label").alias("__hot"))
    salted = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("__hot")), "left_semi")
    rest = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("__hot")), "left_anti")
    salted = salted.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    rest = rest.withColumn("__salt", F.lit(0))
    salts = F.when(F.col("__n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = sums.withColumn("__deal", F.explode(salts))
    return (
        salted.unionByName(rest)
        .join(spread, same & (F.col("__salt") == F.col("__deal")))
        .drop("__label", "__n", "__salt", "__deal")
    )


def compress(
    vectors: DataFrame,
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    Rows go whose vector is NULL, empty, holds NULL, NaN or infinity, or has
    another number of components than most.  Seeds are the smallest ids, NULL
    ids last, rows of one id by vector; fewer rows than entries make smaller
    codebooks.  Repeated rows count each.  A size that does not divide evenly
    makes later parts longer by one; components beyond ``largest`` are cut
    there, a label's error beyond a long is the largest long.  Extra columns
    are left out; a table without any such vector gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hexadecimal digits name at most 256 entries")
    rows = vectors.select("vec_id", "label", F.col(vector).cast("array<double>").alias("vector"))
    size = common_size(rows)
    books = fit(rows, size, parts, entries, rounds) if size else [np.empty((0, 0), np.int64)] * parts
    if not size or not len(books[0]):
        coded = rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = encode(rows, size, books)
    coded = with_label_errors(store(coded, "codes"))
    return coded.select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
