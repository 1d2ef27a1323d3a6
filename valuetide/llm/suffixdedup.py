"""Exact duplicate substrings, found with suffix arrays sorted in two stages.

A byte goes when a string of ``LENGTH`` bytes over it also starts anywhere
else.  Only such strings can matter, and each is put under an anchor: of the
hashed ``GRAM``-byte pieces inside it the smallest, leftmost of equals.  Equal
strings have equal anchors, so strings are compared under one anchor only.

Consecutive starts with the same anchor form a window: the bytes from the
first start to the end of the last string.  Windows are counted by content,
combined before the shuffle; a copied document costs counts, not sorting.

* A window that occurs twice holds duplicate strings only.
* Different windows under one anchor are merged into a suffix array.  Stage one
  sorts the suffixes that are smaller than their successors; stage two scans
  the buckets in order and induces the place of each other suffix from that of
  its successor.  Neighbours with a common prefix of ``LENGTH`` bytes are
  duplicates.
* Under an anchor with more than ``GROUP`` different windows, no task could
  hold them: there each string is hashed to 128 bits and counted instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, store
from .passages import shared_passages

LENGTH = 400
GRAM = 128
GROUP = 2_000
PIECE = 1 << 18
# Row width of the window minimum: places inside a row take the low 12 bits.
ROW_BITS = 12

_random = np.random.default_rng(400)
BYTE_CODES = _random.integers(0, 1 << 63, 256, np.uint64)
ODD = int(_random.integers(1 << 61, 1 << 62)) * 2 + 1
MASK = (1 << 64) - 1


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on, by doubling; a power of two."""
    h, size, factor = BYTE_CODES[data], 1, ODD
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor & MASK
    h ^= h >> np.uint64(32)
    h *= np.uint64(ODD)
    h ^= h >> np.uint64(29)
    return h


def anchor_places(hashes: np.ndarray, starts: int, width: int) -> np.ndarray:
    """For each start the place of the smallest of the next ``width`` hashes.

    Hashes stand in overlapping rows with their place in the low bits, so a
    minimum brings its place along and the leftmost of equals wins.
    """
    row, low = 1 << ROW_BITS, np.uint64((1 << ROW_BITS) - 1)
    step = row - width + 1
    rows = -(-starts // step)
    padded = np.full(rows * step + row, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(hashes)] = hashes
    table = np.lib.stride_tricks.as_strided(padded, (rows, row), (8 * step, 8))
    least = (table & ~low) | np.arange(row, dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:, :-size], least[:, size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:, : size - width], least[:, width - size :])
    places = (least[:, :step] & low).astype(np.int64) + step * np.arange(rows)[:, None]
    return places.ravel()[:starts]


def windows(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple]:
    """(text number, first start, starts, anchor hash, anchor place) of all windows of the texts.

    Texts are laid end to end in pieces; long ones are cut into pieces that
    overlap by a string less one, and a window across a cut is put together.
    """
    laid, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, PIECE):
            part = text[at : at + PIECE + length - 1]
            laid.append((number, at, part))
            size += len(part)
            if size >= PIECE:
                yield from _piece_windows(laid, length, gram)
                laid, size = [], 0
    if laid:
        yield from _piece_windows(laid, length, gram)


def _piece_windows(laid: list[tuple[int, int, bytes]], length: int, gram: int) -> Iterator[tuple]:
    data = np.frombuffer(b"".join(part for _, _, part in laid), np.uint8)
    hashes = gram_hashes(data, gram)
    starts = len(data) - length + 1
    places = anchor_places(hashes, starts, length - gram + 1)
    sizes = np.array([len(part) for _, _, part in laid])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(laid)), sizes)[:starts]
    valid = np.flatnonzero(np.arange(starts) + length <= ends[owner])
    anchors, owner = places[valid], owner[valid]
    fresh = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1]))))
    counts = np.diff(np.append(fresh, len(valid)))
    codes = hashes[anchors[fresh]].view(np.int64)
    shift = np.array([at for _, at, _ in laid]) - (ends - sizes)
    numbers = np.array([number for number, _, _ in laid])
    of = owner[fresh]
    yield from zip(
        numbers[of].tolist(),
        (valid[fresh] + shift[of]).tolist(),
        counts.tolist(),
        codes.tolist(),
        (anchors[fresh] + shift[of]).tolist(),
    )


def _joined_windows(texts: list[bytes]) -> Iterator[tuple]:
    """Windows, those of one anchor that a cut between pieces has parted put together."""
    last = None
    for window in windows(texts):
        number, at, count, _, place = window
        if last and (last[0], last[1] + last[2], last[4]) == (number, at, place):
            last = (number, last[1], last[2] + count, *last[3:])
            continue
        if last:
            yield last
        last = window
    if last:
        yield last


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).cast(pa.string()).cast(pa.binary()).to_pylist()
        of, first, starts, anchor, content = [], [], [], [], []
        for number, at, count, code, _ in _joined_windows(texts):
            of.append(number)
            first.append(at)
            starts.append(count)
            anchor.append(code)
            content.append(
                xxhash.xxh3_64_intdigest(texts[number][at : at + count + LENGTH - 1]) - (1 << 63)
            )
        rows = pa.array(of, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor, pa.int64()),
                pa.array(content, pa.int64()),
                pa.array(starts, pa.int32()),
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(first, pa.int32()),
            ],
            ["anchor", "content", "starts", "doc_id", "key", "first"],
        )


def suffix_order(parts: list[bytes], counts: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """The suffixes (part, start) with start below the part's count, sorted.

    Sorted to a depth of ``length`` bytes at least.  Each part is followed by
    its end, which is smaller than any byte.
    """
    induced: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    direct: list[list[tuple[bytes, int, int]]] = [[] for _ in range(256)]
    larger: list[np.ndarray] = []
    for p, (part, count) in enumerate(zip(parts, counts)):
        data = np.frombuffer(part, np.uint8).astype(np.int16)
        step = np.sign(np.diff(data))
        # An equal pair is of the kind of the next unequal one.
        at = np.where(step != 0, np.arange(len(step)), len(step))
        at = np.minimum.accumulate(at[::-1])[::-1]
        falls = np.append(step, -1)[at] < 0
        # The end is smaller than all, so before it suffixes fall; the last
        # byte is sorted directly, like those smaller than their successors.
        kind = np.append(falls, False)
        smaller = np.flatnonzero(~kind)
        stop = int(smaller[np.searchsorted(smaller, count - 1)])
        larger.append(kind[: stop + 1])
        for i in smaller[: np.searchsorted(smaller, stop, "right")].tolist():
            direct[part[i]].append((part[i : i + length], p, i))
    order = []
    for byte in range(256):
        direct[byte].sort()
        for source in (induced[byte], direct[byte]):
            for entry in source:
                p, i = entry[-2:]
                if i < counts[p]:
                    order.append((p, i))
                if i and larger[p][i - 1]:
                    induced[parts[p][i - 1]].append((p, i - 1))
    return order


def shared_starts(parts: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each part, which of its starts begin a string that starts elsewhere too."""
    found = [np.zeros(n, bool) for n in counts]
    before, text = None, b""
    for p, i in suffix_order(parts, counts, length):
        own = parts[p][i : i + length]
        # A common prefix of this length with the neighbour makes a duplicate.
        if own == text and before:
            found[p][i] = found[before[0]][before[1]] = True
        before, text = (p, i), own
    return found


def runs(flags: np.ndarray) -> list[int]:
    """Byte ranges [from, to) covered by the flagged starts, flat."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0])))).tolist()
    return [e if k % 2 == 0 else e + LENGTH - 1 for k, e in enumerate(edges)]


COVERED = "anchor long, content long, starts int, covered array<int>"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: build the suffix array of each anchor's windows."""
    current, group, out = None, {}, []
    for batch in batches:
        for anchor, content, count, times, window in zip(*(c.to_pylist() for c in batch.columns)):
            if anchor != current:
                _compare_group(current, group, out)
                current, group = anchor, {}
            group[content, count] = (window, times)
        yield _covered(out)
        out = []
    _compare_group(current, group, out)
    yield _covered(out)


def _compare_group(anchor: int, group: dict, out: list[tuple]) -> None:
    parts = [window for window, _ in group.values()]
    found = shared_starts(parts, [count for _, count in group]) if len(parts) > 1 else []
    for (content, count), (_, times), flags in zip(group, group.values(), found):
        if times == 1 and flags.any():
            out.append((anchor, content, count, runs(flags)))


def _covered(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "content", "starts", "covered"]
    )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit hashes of all strings of large groups' windows."""
    for batch in batches:
        rows, at, high, low = [], [], [], []
        for k, (count, window) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())):
            for i in range(count):
                digest = xxhash.xxh3_128_intdigest(window[i : i + LENGTH])
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & MASK) - (1 << 63))
            rows += [k] * count
            at += range(count)
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(high, pa.int64()), pa.array(low, pa.int64())]
            + [batch.column(c).take(take) for c in range(4)]
            + [pa.array(at, pa.int32())],
            ["high", "low", "anchor", "content", "starts", "times", "at"],
        )


def _count_strings(members: DataFrame) -> DataFrame:
    """COVERED for windows of large groups, by counting hashed strings."""
    kind = "high long, low long, anchor long, content long, starts int, times long, at int"
    strings = members.mapInArrow(_strings, kind)
    often = strings.groupBy("high", "low").agg(F.sum("times").alias("n")).filter("n > 1").drop("n")
    return (
        strings.filter("times = 1")
        .join(often, ["high", "low"])
        .groupBy("anchor", "content", "starts")
        .agg(F.flatten(F.collect_set(F.array(F.col("at"), F.col("at") + LENGTH))).alias("covered"))
    )


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "content", "starts", "times", "window"]
    for batch in batches:
        out = []
        texts = batch.column(0).cast(pa.string()).cast(pa.binary()).to_pylist()
        for text, wanted in zip(texts, batch.column(1).to_pylist()):
            for w in wanted:
                piece = text[w["first"] : w["first"] + w["starts"] + LENGTH - 1]
                out.append((w["anchor"], w["content"], w["starts"], w["times"], piece))
                if len(out) >= 10_000:
                    yield _window_batch(out, names)
                    out = []
        yield _window_batch(out, names)


def _window_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def same_row(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["__id"]) & (left["key"] == right["__key"])


def covered_ranges(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, key, ranges): for each row with duplicates its byte ranges, unmerged.

    ``docs`` has doc_id, key and text.  Ranges are (first, covered) of windows.
    """
    long_enough = docs.filter(F.octet_length("text") >= LENGTH)
    found = store(
        long_enough.select("doc_id", "key", "text").mapInArrow(
            _window_rows,
            f"anchor long, content long, starts int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
            "key long, first int",
        ),
        "windows",
    )
    # Combined by content first: an anchor's rows are then its different windows.
    by_content = store(
        found.groupBy("anchor", "content", "starts").agg(
            F.count(F.lit(1)).alias("times"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "first")).alias("one"),
        ),
        "contents",
    )
    kinds = by_content.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    members = by_content.join(kinds, "anchor")
    wanted = members.groupBy("one.doc_id", "one.key").agg(
        F.collect_list(
            F.struct("anchor", "content", "starts", "times", F.col("one.first").alias("first"), "kinds")
        ).alias("wanted")
    )
    wanted = wanted.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "wanted")
    cut = long_enough.join(wanted, same_row(long_enough, wanted)).select("text", "wanted")
    window = "anchor long, content long, starts int, times long, window binary"
    small = F.filter("wanted", lambda w: w["kinds"] <= group)
    large = F.filter("wanted", lambda w: w["kinds"] > group)
    compared = (
        cut.select("text", small.alias("wanted"))
        .mapInArrow(_cut_windows, window)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_compare, COVERED)
    )
    parts = [compared]
    if kinds.filter(F.col("kinds") > group).limit(1).count():
        rest = cut.select("text", large.alias("wanted")).filter(F.size("wanted") > 0)
        members = store(rest.mapInArrow(_cut_windows, window), "large-groups")
        parts.append(_count_strings(members.dropDuplicates(["anchor", "content", "starts"])))
    whole = by_content.filter("times > 1").select(
        "anchor", "content", "starts", F.array(F.lit(0), F.col("starts") + (LENGTH - 1)).alias("covered")
    )
    result = whole
    for part in parts:
        result = result.unionByName(part)
    return (
        found.join(store(result, "covered"), ["anchor", "content", "starts"])
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("first", "covered")).alias("ranges"))
    )


def merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Absolute byte ranges, merged where they overlap or touch."""
    flat = sorted(
        (r["first"] + a, r["first"] + b)
        for r in ranges or ()
        for a, b in zip(r["covered"][::2], r["covered"][1::2])
    )
    out: list[tuple[int, int]] = []
    for a, b in flat:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        texts = batch.column(1).cast(pa.string()).cast(pa.binary()).to_pylist()
        for text, ranges in zip(texts, batch.column(2).to_pylist()):
            text = text or b""
            cuts = merged(ranges)
            kept = hashlib.sha256()
            at = 0
            for a, b in cuts:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            rows.append((len(text), sum(b - a for a, b in cuts), len(cuts), kept.hexdigest()))
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)]
            + [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            + [batch.column(3)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages"],
        )


def with_ranges(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, text, ranges, n_passages) of every row; NULL and 0 without duplicates."""
    rows = docs.select("doc_id", row_key().alias("key"), F.col("text").cast("string").alias("text"))
    found = covered_ranges(rows, group).select(number("doc_id", "key").alias("__row"), "ranges")
    passages = shared_passages(rows.select(number("doc_id", "key").alias("row"), "text"))
    found = found.join(passages.withColumnRenamed("row", "__row"), "__row", "full")
    return (
        rows.join(found, number("doc_id", "key") == F.col("__row"), "left")
        .select("doc_id", "text", "ranges", F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages"))
    )


def number(doc_id: str, key: str) -> Column:
    """A number of the rows of one id and text."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.col(key))


def removed_bytes(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """The digest row of each document.

    A NULL text is an empty one.  Texts of fewer than ``LENGTH`` bytes hold no
    string and stay whole.  Rows that repeat another are documents of their
    own, so both lose all their strings.  ``n_passages`` counts the strings of
    51 words that a document of another id or text has, whatever their bytes.
    Extra columns are left out; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_ranges(docs, group).mapInArrow(
        _digest_rows,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long",
    )
