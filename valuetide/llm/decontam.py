"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items are laid into one automaton; training words stream
through it, and the length of the longest match that ends at each word tells
which windows of an item occur.  Documents are never shuffled.

Items are dealt into blocks of about ``BLOCK_WORDS`` words, so what is
broadcast and built in a worker is bounded whatever the benchmark's size; each
block is one pass over all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_key, store

WINDOW = 10
BLOCK_WORDS = 100_000

# Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a
# space; bytes of other characters belong to words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("cleaned", T.StringType()),
    ]
)


def split_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences.

    State 0 is the root.  ``items_at`` names the items in which the strings of
    a state occur, for states that hold strings of at least ``window`` words;
    ``short_at`` the items of fewer words that end in a state.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ids = self.vocabulary
        coded = [(name, [ids.setdefault(w, len(ids)) for w in ws]) for name, ws in items if ws]
        for _, sequence in coded:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.items_at: dict[int, set[str]] = {}
        self.short_at: dict[int, list[tuple[int, str]]] = {}
        for name, sequence in coded:
            self._own(name, sequence)
        self.shortest = min([window, *(len(s) for _, s in coded)]) if coded else 0
        self.short_link = self._short_links()

    def _add(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the strings of ``q`` no longer than those of ``p`` and ``word``."""
        copy = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if (q := self.next[last].get(word)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._add(self.length[last] + 1, 0, {}), last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def _own(self, name: str, sequence: list[int]) -> None:
        state = 0
        for word in sequence:
            state = self.next[state][word]
            up = state
            while self.length[up] >= self.window:
                owners = self.items_at.setdefault(up, set())
                if name in owners:
                    break
                owners.add(name)
                up = self.link[up]
        if len(sequence) < self.window:
            while self.length[self.link[state]] >= len(sequence):
                state = self.link[state]
            self.short_at.setdefault(state, []).append((len(sequence), name))

    def _short_links(self) -> list[int]:
        """For each state the nearest one on its suffix path with short items, or 0."""
        found = [0] * len(self.length)
        if self.short_at:
            for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                found[state] = state if state in self.short_at else found[self.link[state]]
        return found

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Hit word ranges [from, to), merged, and the items with occurring windows."""
        spans: list[list[int]] = []
        items: set[str] = set()
        if len(words) < max(self.shortest, 1) or not self.shortest:
            return spans, items
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        # Only stretches of known words that are long enough can hold a window.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        long_enough = ends - starts >= self.shortest
        for a, b in zip(starts[long_enough].tolist(), ends[long_enough].tolist()):
            self._stream(ids[a:b].tolist(), a, spans, items)
        return spans, items

    def _stream(self, ids: list[int], at: int, spans: list[list[int]], items: set[str]) -> None:
        edges, link, length, window = self.next, self.link, self.length, self.window
        shorts = self.short_link if self.short_at else None
        state = matched = 0
        for k, word in enumerate(ids, at + 1):
            while (to := edges[state].get(word)) is None and state:
                state = link[state]
                matched = length[state]
            if to is None:
                continue
            state, matched = to, matched + 1
            hit = 0
            if matched >= window:
                up = state
                while length[link[up]] >= window:
                    up = link[up]
                items |= self.items_at[up]
                hit = window
            if shorts:
                up = shorts[state]
                while up:
                    for size, name in self.short_at[up]:
                        if size <= matched:
                            items.add(name)
                            hit = max(hit, size)
                    up = shorts[link[up]]
            if hit:
                start = k - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, k])


def cut_words(text: bytes, spans: list[list[int]], longest: int) -> str:
    """``text`` without the word ranges of at least ``longest`` words.

    What stands between removed words goes with them.
    """
    folded = text.translate(FOLD)
    places, at = [], 0
    for word in folded.split():
        at = folded.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    kept, done = [], 0
    for a, b in spans:
        if b - a >= longest:
            kept.append(text[done : places[a][0]])
            done = places[b - 1][1]
    kept.append(text[done:])
    return b"".join(kept).decode()


_built: dict[str, Automaton] = {}


def _automaton(tag: str, items, window: int) -> Automaton:
    """One automaton for each worker process; the last block only."""
    if tag not in _built:
        _built.clear()
        _built[tag] = Automaton([(n, split_words(t)) for n, t in items], window)
    return _built[tag]


def _scan(
    docs: DataFrame, items: list[tuple[str, bytes]], window: int, longest: int, texts: bool = True
) -> DataFrame:
    """``docs`` with a struct ``__found`` from one block of items; a narrow map.

    Without ``texts`` neither the texts nor their cut form come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = docs.columns
    at = names.index("text")
    kept = [i for i in range(len(names)) if texts or i != at]
    tag = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.list_(pa.int32()))),
            ("items", pa.list_(pa.string())),
            ("cleaned", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(tag, shared.value, window)
        for batch in batches:
            out = []
            texts = batch.column(at).cast(pa.string()).cast(pa.binary())
            for value in texts:
                text = value.as_py() or b""
                words = split_words(text)
                spans, found = machine.matches(words)
                cleaned = cut_words(text, spans, longest) if spans and texts else None
                out.append((len(words), spans, sorted(found), cleaned))
            struct = pa.array([dict(zip(FOUND.names, x)) for x in out], kind)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), struct], [*(names[i] for i in kept), "__found"]
            )

    fields = [docs.schema.fields[i] for i in kept]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("__found", FOUND)]))


def item_blocks(benchmark: DataFrame, block_words: int) -> tuple[int, Iterator[list]]:
    """Blocks of (item_id, text), about ``block_words`` words each; items stay whole."""
    rows = benchmark.filter("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    )
    # A word takes a byte and a separator at least; this bounds the words.
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // (5 * block_words)))

    def load(block: int) -> list:
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        return sorted((r.item_id, r.text.encode()) for r in part.collect())

    return blocks, map(load, range(blocks))


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    longest: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    texts: bool = True,
) -> DataFrame:
    """``docs`` with what they share with the benchmark.

    Added columns (they replace columns of these names): ``n_words``, ``spans``
    (word ranges [from, to) inside an occurrence of a window, merged),
    ``items`` (ids of the items with occurring windows, as strings, sorted) and
    ``cleaned`` (the text without spans of at least ``longest`` words).  With
    ``texts`` off the columns text and cleaned are left out.

    A NULL or empty text has no words.  A NULL or empty item has no window; a
    NULL item_id counts as ''.  Equal items are all named.  An empty benchmark
    hits nothing; an empty table gives no rows.
    """
    number, blocks = item_blocks(benchmark, block_words)
    mine = ["n_words", "spans", "items", "cleaned"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in mine])
    done = _scan(docs, next(blocks), window, longest, texts or number > 1)
    for items in blocks:
        done = _merge(done, docs, items, window, longest)
    done = done.select("*", "__found.*").drop("__found")
    return done if texts else done.drop("text", "cleaned")


def _merge(done: DataFrame, docs: DataFrame, items: list, window: int, longest: int) -> DataFrame:
    """Add the hits of a further block to what the earlier blocks found."""
    hits = (
        _scan(docs.select("doc_id", "text"), items, window, longest)
        .filter(F.size("__found.spans") > 0)
        .select(
            F.col("doc_id").alias("__id"),
            row_key().alias("__other"),
            F.col("__found.spans").alias("__spans"),
            F.col("__found.items").alias("__items"),
        )
        .dropDuplicates(["__id", "__other"])
    )
    hits = store(hits, "overlaps")
    joined = done.withColumn("__key", row_key()).join(
        hits,
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__other")),
        "left",
    )

    @F.udf(FOUND)
    def union(text, found, spans, names):
        if not spans:
            return found
        merged: list[list[int]] = []
        for a, b in sorted([*found.spans, *spans]):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        cleaned = cut_words(text.encode(), merged, longest)
        return found.n_words, merged, sorted({*found.items, *names}), cleaned

    both = union("text", "__found", "__spans", "__items")
    return joined.withColumn("__found", both).drop("__key", "__id", "__other", "__spans", "__items")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    longest: int = WINDOW,
    coverage: float = 0.5,
) -> DataFrame:
    """Training texts without test passages.

    Spans of at least ``longest`` words are cut from the text (``n_chars``, if
    there, follows); a document goes when more than the share ``coverage`` of
    its words is hit, so 0 drops every document with a hit.
    """
    found = find_overlaps(docs, benchmark, window, longest)
    kept = found.withColumn("__hit", n_hit("spans")).filter(
        F.col("__hit") <= F.lit(float(coverage)) * F.col("n_words")
    )
    text = F.coalesce("cleaned", "text")
    out = kept.withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("cleaned").isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def n_hit(spans: str):
    """Words inside the merged spans."""
    return F.aggregate(
        F.col(spans), F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long")
    )


def overlap_counts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest row of each document (see ``find_overlaps``)."""
    found = find_overlaps(docs.select("doc_id", "text"), benchmark, texts=False)
    return found.select(
        "doc_id",
        "n_words",
        n_hit("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
