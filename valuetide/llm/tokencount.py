"""Token counts by a two-tier lookup of pre-token lengths.

A text's tokens are those of its pre-tokens, which the library encodes
independently of each other, so only their lengths are needed.  Tier one is a
compact table of frequent pre-tokens, broadcast once; tier two is a cache in
each worker, filled by encoding what neither tier knows.  Pre-tokens are never
shuffled: documents go through one narrow map.

Both tiers hold true lengths, so the sample behind the table sways the speed
and no count.  It is a hash sample of the whole corpus, counted where it lies:
each task sends a bounded list of its commonest pre-tokens, and only these
lists are added up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .binary import LETTERS, NUMBERS, PLAIN, byte_letters, public_tokenizer
from .common import Recent

TOKEN_LIMIT = 2048
TABLE_PIECES = 65_536
SAMPLE_ONE_IN = 32
TASK_PIECES = 8_192
CACHE_PIECES = 400_000
# Capitals like U+0181 have small letters beyond the plain ones: the library counts those texts.
LOWERED = re.compile("[" + re.escape("".join(
    c for c in map(chr, range(0x250)) if PLAIN.fullmatch(c) and PLAIN.fullmatch(c.lower())
)) + "]*")

# Fixed value: how the word vocabulary splits a text in lower case.
PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")


class Counts:
    """Token counts of texts as the library at ``path`` gives them.

    Texts with characters beyond the plain ones, or with a special string, are
    encoded whole by the library.
    """

    def __init__(self, path: str, table: dict[str, int]):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.frequent = table
        self.recent = Recent(self.lengths, CACHE_PIECES)

    def lengths(self, pieces: list[str]) -> list[int]:
        tokenize = self.library.model.tokenize
        return [len(tokenize(byte_letters(p))) for p in pieces]

    def __call__(self, text: str) -> int:
        if not LOWERED.fullmatch(text) or self.special.search(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        pieces = PIECES.findall(text.lower())
        found = list(map(self.frequent.get, pieces))
        missed = [p for p, n in zip(pieces, found) if n is None]
        return sum(filter(None, found)) + sum(self.recent(missed))


@cache
def counter(path: str, packed: tuple[bytes, bytes]) -> Counts:
    """One for each worker process and table; a process serves many tasks."""
    return Counts(path, unpack(packed))


def pack(table: dict[str, int]) -> tuple[bytes, bytes]:
    """Pieces, parted by line feeds, which no piece holds, and a byte for each length."""
    return "\n".join(table).encode(), bytes(table.values())


def unpack(packed: tuple[bytes, bytes]) -> dict[str, int]:
    return dict(zip(packed[0].decode().split("\n"), packed[1]))


def frequent_pieces(
    docs: DataFrame, tokenizer: Callable[[], str], one_in: int, size: int
) -> tuple[bytes, bytes]:
    """The commonest pre-tokens of every ``one_in``-th document with their lengths, packed.

    Documents are picked by hash of id and length.  A task sends at most
    ``TASK_PIECES`` pieces of at most 64 characters, and the driver gets at most
    ``size`` of them, whatever the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if LOWERED.fullmatch(text):
                    seen.update(p for p in PIECES.findall(text.lower()) if len(p) <= 64)
            if len(seen) > 64 * TASK_PIECES:
                seen = Counter(dict(seen.most_common(8 * TASK_PIECES)))
        pieces = seen.most_common(TASK_PIECES)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in pieces], pa.string()), pa.array([n for _, n in pieces], pa.int64())],
            ["piece", "n"],
        )

    picked = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(one_in)) == 0
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(picked & F.col("text").isNotNull())
    counts = sample.select("text").mapInArrow(run, "piece string, n long")
    common = counts.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    pieces = [r.piece for r in common.collect()]
    return pack(dict(zip(pieces, Counts(tokenizer(), {}).lengths(pieces))))


def count_tokens(
    docs: DataFrame,
    tokenizer: Callable[[], str],
    limit: int = TOKEN_LIMIT,
    one_in: int = SAMPLE_ONE_IN,
    table_pieces: int = TABLE_PIECES,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``tokenizer`` gives the file's place on the machine it is called on.  A
    NULL text counts as empty: no bytes, no tokens.  Rows are counted each for
    itself, whatever their ids; extra columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        frequent_pieces(docs, tokenizer, one_in, table_pieces)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer(), shared.value)
        for batch in batches:
            n = [count(t) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("string").alias("text"),
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType())])
    counted = rows.mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def token_counts(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """The digest row of each document."""
    return count_tokens(docs, public_tokenizer(name))
