"""Passages of more than 50 words that two documents share, beside the exact byte strings of op6.

Words are runs of bytes between ASCII white space.  Every string of ``WORDS``
words is put under an anchor, the smallest hash of the ``GRAM``-word pieces
inside it, so equal strings have equal anchors.  Consecutive starts of one
anchor form a run.  Anchors of one document are done with.  Where documents
have an anchor with one and the same run, the run is shared as a whole; where
their runs differ, the hashes of the runs' strings, at most as many as an
anchor has places, are counted across documents.  Up to ``MOST_ANCHORS`` such
anchors are broadcast and texts are read again where they lie; beyond that the
runs are sent to their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store

WORDS = 51
GRAM = 8
SLICE_BYTES = 4 << 20
MOST_ANCHORS = 2_000_000
ODD = 0x9E3779B97F4A7C15


def word_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of the texts, words of each text)."""
    digest = xxhash.xxh3_64_intdigest
    words = [t.split() if t else [] for t in texts]
    codes = np.array([digest(w) for own in words for w in own], np.uint64)
    return codes, np.array(list(map(len, words)), np.int64)


def rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` codes from each place on, put together from powers of two."""
    places = len(codes) - size + 1
    out, taken, power, width = np.zeros(max(places, 0), np.uint64), 0, codes, 1
    if places <= 0:
        return out
    while width <= size:
        factor = np.uint64(pow(ODD, width, 1 << 64))
        if size & width:
            out = out * factor + power[taken : taken + places]
            taken += width
        power = power[:-width] * factor + power[width:]
        width *= 2
    out ^= out >> np.uint64(32)
    out *= np.uint64(ODD)
    return out ^ (out >> np.uint64(29))


def slices(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of the texts of a few megabytes each."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or b"")
        if held >= SLICE_BYTES or k == len(texts) - 1:
            yield start, k + 1
            start, held = k + 1, 0


def text_runs(texts: list[bytes | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, first start, starts, anchor, content) of all runs of the texts."""
    from .suffixdedup import anchor_places

    codes, sizes = word_codes(texts)
    starts = len(codes) - WORDS + 1
    if starts <= 0:
        return
    grams = rolled(codes, GRAM)
    places = anchor_places(grams, starts, WORDS - GRAM + 1)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[:starts]
    valid = np.flatnonzero(np.arange(starts) + WORDS <= ends[owner])
    if not len(valid):
        return
    at, of = places[valid], owner[valid]
    fresh = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (of[1:] != of[:-1]))))
    counts = np.diff(np.append(fresh, len(valid))).tolist()
    anchors = grams[at[fresh]].view(np.int64).tolist()
    first = valid[fresh]
    offsets = (first - (ends - sizes)[of[fresh]]).tolist()
    for number, place, offset, count, anchor in zip(of[fresh].tolist(), first.tolist(), offsets, counts, anchors):
        held = codes[place : place + count + WORDS - 1].tobytes()
        yield number, offset, count, anchor, xxhash.xxh3_64_intdigest(held) - (1 << 63)


RUN = "row long, first int, starts int, anchor long, content long"
STRING = "h long, row long, place int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    for batch in batches:
        rows = batch.column(0).to_numpy(zero_copy_only=False)
        texts = batch.column(1).cast(pa.string()).cast(pa.binary()).to_pylist()
        for a, b in slices(texts):
            number, *rest = list(zip(*text_runs(texts[a:b]))) or [()] * 5
            columns = [rows[a:b][list(number)] if number else (), *rest]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "first", "starts", "anchor", "content"]
            )


def _string_batch(hashes: list, rows: list, places: list) -> pa.RecordBatch:
    joined = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    columns = [joined(hashes, np.int64), joined(rows, np.int64), joined(places, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "row", "place"])


def _run_strings(rows, texts, wanted) -> pa.RecordBatch:
    """The strings of the wanted runs (first, starts) of each text."""
    hashes, owners, places = [], [], []
    for row, text, runs in zip(rows, texts, wanted):
        if runs:
            own = rolled(word_codes([text])[0], WORDS).view(np.int64)
            at = np.concatenate([np.arange(first, first + starts, dtype=np.int32) for first, starts in runs])
            hashes.append(own[at])
            owners.append(np.full(len(at), row, np.int64))
            places.append(at)
    return _string_batch(hashes, owners, places)


def _joined_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.string()).cast(pa.binary()).to_pylist()
        wanted = [[(w["first"], w["starts"]) for w in own] for own in batch.column(2).to_pylist()]
        yield _run_strings(batch.column(0).to_pylist(), texts, wanted)


def _found_strings(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """STRING of all runs under the anchors, which are broadcast, from the texts where they lie."""
    packed = np.sort(np.array([r.anchor for r in anchors.collect()], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.string()).cast(pa.binary()).to_pylist()
            for a, b in slices(texts):
                wanted: list[list] = [[] for _ in range(a, b)]
                found = list(text_runs(texts[a:b]))
                codes = np.array([x[3] for x in found], np.int64)
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                for k in np.flatnonzero(known[at] == codes):
                    number, first, starts, *_ = found[k]
                    wanted[number].append((first, starts))
                yield _run_strings(rows[a:b], texts[a:b], wanted)

    return docs.select("row", "text").mapInArrow(run, STRING)


def shared_passages(docs: DataFrame, most_anchors: int = MOST_ANCHORS) -> DataFrame:
    """(row, n_passages): strings of ``WORDS`` words of the row that another row has.

    ``docs`` has row, a number that tells rows apart, and text; rows of one
    number are one document.  Rows without such strings are left out.
    """
    long_enough = docs.filter(F.octet_length("text") >= 2 * WORDS - 1)
    found = store(long_enough.select("row", "text").mapInArrow(_runs, RUN), "passages")
    anchors = (
        found.groupBy("anchor")
        .agg(
            (F.min("row") < F.max("row")).alias("shared"),
            ((F.min("content") < F.max("content")) | (F.min("starts") < F.max("starts"))).alias("differ"),
        )
        .filter("shared")
        .drop("shared")
    )
    anchors = store(anchors, "passage-anchors")
    whole = (
        found.join(anchors.filter("NOT differ").select("anchor"), "anchor")
        .select("row", "first", "starts")
        .distinct()
        .groupBy("row")
        .agg(F.sum("starts").alias("n"))
    )
    whole = store(whole, "passage-whole")
    differ = anchors.filter("differ").select("anchor")
    n = differ.count()
    if 0 < n <= most_anchors:
        strings = _found_strings(long_enough, differ)
    else:
        runs = found.join(differ, "anchor").groupBy(F.col("row").alias("__row"))
        wanted = store(runs.agg(F.collect_set(F.struct("first", "starts")).alias("wanted")), "passage-wanted")
        joined = long_enough.join(wanted, F.col("row") == F.col("__row"))
        strings = joined.select("row", "text", "wanted").mapInArrow(_joined_strings, STRING)
    # The runs are the widest table; they go before the strings are written.
    discard(found, anchors)
    strings = store(strings, "passage-strings")
    often = strings.groupBy("h").agg((F.min("row") < F.max("row")).alias("often")).filter("often").select("h")
    partly = strings.join(often, "h").select("row", "place").distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    counts = whole.unionByName(partly).groupBy("row").agg(F.sum("n").alias("n_passages"))
    result = store(counts, "passage-counts")
    discard(strings)
    return result
