"""SimHash near-duplicates, found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments.  Two fingerprints that differ
in at most two bits agree on one segment altogether and differ in at most two
bits on the next one.  The perfect binary Golay code of length 23 gives such a
segment, padded with zeros, up to six codewords: those that it or a word one
bit away decodes to.  Two segments with at most two different bits have one of
these in common, as a word between them lies within one bit of both.  So
(segment, its bits, codeword of the next segment) is a key that linked
fingerprints share, and every candidate pair is verified.

Only distinct fingerprints take part, so exact copies cost nothing.  A key of
more than ``SMALL`` fingerprints is not paired up: each of them is sent to its
65 words within one bit, and all fingerprints that meet at a word differ in at
most two bits there.  That finds the same links, with at most 65 members each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick_rows, row_key, store

SHINGLE = 3
SEED = 42
BITS = 2
SMALL = 64

# Generator polynomial of the binary Golay code (23, 12, 7);
# first bit and length of the three segments.
GOLAY = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits over the XXH64 of all word shingles, repeats counted."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle + 1, 1)
    spans = zip(starts[:last].tolist(), ends[-last:].tolist())
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
    bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(bits), 1 << 16):
        counts += np.unpackbits(bits[k : k + (1 << 16)], axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with a long column ``fingerprint``; NULL and blank texts get 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = [fingerprint((t or "").encode(), shingle) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn("fingerprint", of("text"))


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of all 23-bit words, and the errors that a remainder stands for."""
    remainders = np.zeros(1, np.uint16)
    for bit in range(23):
        value = 1 << bit
        for top in range(22, 10, -1):
            if value >> top & 1:
                value ^= GOLAY << (top - 11)
        remainders = np.concatenate((remainders, remainders ^ np.uint16(value)))
    errors = np.zeros(2048, np.uint32)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            word = sum(1 << p for p in places)
            errors[remainders[word]] = word
    return remainders, errors


def codewords(segments: np.ndarray) -> np.ndarray:
    """Row by row the 24 codeword indices of a segment and its one-bit neighbours."""
    remainders, errors = golay_tables()
    flips = np.concatenate(([0], 1 << np.arange(23))).astype(np.uint32)
    near = segments.astype(np.uint32)[:, None] ^ flips
    return ((near ^ errors[remainders[near]]) >> 11).astype(np.int64)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, key) of all keys, each key once a fingerprint."""
    of, keys = [], []
    parts = [(prints >> np.uint64(a)) & np.uint64((1 << n) - 1) for a, n in SEGMENTS]
    for k, part in enumerate(parts):
        words = np.sort(codewords(parts[(k + 1) % len(parts)]), axis=1)
        fresh = np.ones(words.shape, bool)
        fresh[:, 1:] = words[:, 1:] != words[:, :-1]
        rows, columns = np.nonzero(fresh)
        of.append(rows)
        exact = part.astype(np.int64)[rows]
        keys.append((np.int64(k) << 34) | (exact << 12) | words[rows, columns])
    return np.concatenate(of), np.concatenate(keys)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        of, keys = fuzzy_keys(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[of])], ["key", "fingerprint"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each short list of fingerprints, links that join all that are linked in it."""
    for batch in batches:
        a, b = [], []
        for members in batch.column(0).to_pylist():
            prints = np.unique(np.array(members, np.int64))
            words = prints.view(np.uint64)
            apart = np.bitwise_count(words[:, None] ^ words[None, :])
            group = list(range(len(prints)))
            for i, j in zip(*np.nonzero(np.triu(apart <= BITS, 1))):
                if (x := group[i]) != (y := group[j]):
                    group = [x if g == y else g for g in group]
                    a.append(prints[i])
                    b.append(prints[j])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )


def links(prints: DataFrame, small: int = SMALL) -> DataFrame:
    """(a, b): enough links between distinct fingerprints to join all that are linked."""
    keys = store(prints.select("fingerprint").mapInArrow(_key_rows, "key long, fingerprint long"), "keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keys.join(sizes, "key")
    few = (
        shared.filter(F.col("n") <= small)
        .groupBy("key")
        .agg(F.collect_list("fingerprint").alias("members"))
        .select("members")
        .mapInArrow(_verify, "a long, b long")
    )
    near = F.array(
        F.col("fingerprint"),
        *[F.col("fingerprint").bitwiseXOR(F.lit(v)) for v in np.left_shift(1, np.arange(64)).tolist()],
    )
    many = (
        shared.filter(F.col("n") > small)
        .select("fingerprint")
        .distinct()
        .select("fingerprint", F.explode(near).alias("word"))
        .groupBy("word")
        .agg(F.collect_set("fingerprint").alias("members"))
        .filter(F.size("members") > 1)
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
        .filter("a <> b")
    )
    return few.union(many).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) can reach.

    Alternates large and small stars: every node hands its larger neighbours,
    then its smaller ones, to the smallest node it knows.  Each round is
    stored; a round that changes nothing is the last.  Only counts and hash
    sums come to the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = store(edges.filter("u <> v").distinct(), name)
    seen = None
    while True:
        # A hash sum tells the edge sets apart; 32 bits each keep it from overflowing.
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first())
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = large.distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = store(least.select("u", F.col("m").alias("v")).union(small).distinct(), name)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fingerprint, component_id, first) of every row.

    Fingerprints are linked at ``BITS`` or fewer different bits; component_id
    is the smallest doc_id that can be reached, NULL only if no row there has
    an id.  ``first`` marks the rows of the component's first (doc_id, key),
    NULL ids last.  Blank and NULL texts share fingerprint 0 and are linked as
    any other.  Extra columns are left out; an empty table gives no rows.
    """
    rows = store(
        fingerprints(docs.select("doc_id", row_key().alias("key"), "text"), shingle).drop("text"),
        "fingerprints",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    prints = store(rows.groupBy("fingerprint").agg(first), "prints")
    roots = components(links(prints))
    classes = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first"
    )
    heads = classes.groupBy("root").agg(F.min("first").alias("head"))
    known = classes.join(heads, "root").select(F.col("fingerprint").alias("__print"), "head")
    return rows.join(known, F.col("fingerprint") == F.col("__print")).select(
        "doc_id",
        "key",
        "fingerprint",
        F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("key") == F.col("head.key"))).alias("first"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component: the first by doc_id, with all its columns."""
    firsts = near_duplicates(docs, shingle).filter("first").groupBy("doc_id", "key")
    return pick_rows(docs, firsts.agg(F.lit(1).alias("copies"), F.count(F.lit(1)).alias("rows")))


def fingerprint_components(docs: DataFrame) -> DataFrame:
    """The digest row of each document (see ``near_duplicates``)."""
    return near_duplicates(docs).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )
