"""Token ids as flat binary files with document offsets.

A dataset is a folder of shards.  ``part-N.bin`` holds the ids of the shard's
documents one after the other as little-endian unsigned integers, 16 bits wide
where the vocabulary allows it and 32 otherwise.  ``part-N.idx`` holds, as
64-bit words: magic, version, bytes an id, documents, ids; then documents + 1
offsets into the shard, the document ids, and a word for each document that is
1 where its id is NULL.  Shards follow each other in ascending doc_id order; a
shard's base, the ids of all shards before it, is a prefix sum over the
manifest.

Texts are dealt by ranges of doc_id and encoded where they arrive.  A task
writes its shard under a name of its own attempt and renames it when complete,
so a repeated task leaves one whole shard with the same bytes.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_at_exit, scratch_path
from .common import Recent

MAGIC, VERSION = 0x54494445, 1
END_ID = 0
CACHE_PIECES = 400_000
PORTION_BYTES = 1 << 20
SHARD_BYTES, MOST_SHARDS = 256 << 20, 1 << 20

# In texts of these characters only, Python's classes equal the library's.
LETTERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "L")
NUMBERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "N")
PLAIN = re.compile(r"[\t\n\r\x20-\x7E\xA1-\xAC\xAE-ɏ]*")
# Fixed value: how the byte-level vocabulary splits a text.
PIECES = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)


# Fixed value: the letter that stands for each byte in byte-level vocabularies.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _OWN)}


def byte_letters(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(BYTE_LETTERS)


class Encoder:
    """Ids of whole texts, piece by piece; recent pieces are kept.

    The pieces that a text splits into are encoded independently of each
    other, so a piece's ids can be used again.  Texts with other characters or
    with a special string go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.recent = Recent(self.pieces, CACHE_PIECES)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        tokenize = self.library.model.tokenize
        code = "H" if self.kind.itemsize == 2 else "I"
        return [array(code, [t.id for t in tokenize(byte_letters(p))]).tobytes() for p in pieces]

    def ids(self, text: str) -> bytes:
        encoded = self.library.encode(text, add_special_tokens=False)
        return np.array(encoded.ids, self.kind).tobytes()

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the pieces of all of them are looked up together."""
        split = [
            PIECES.findall(t) if PLAIN.fullmatch(t) and not self.special.search(t) else None for t in texts
        ]
        found = iter(self.recent([p for own in split if own for p in own]))
        return [
            self.ids(t) if own is None else b"".join(islice(found, len(own))) for t, own in zip(texts, split)
        ]

    def __call__(self, text: str) -> bytes:
        return self.texts([text])[0]


def portions(column: pa.Array, size: int = PORTION_BYTES) -> Iterator[list[str]]:
    """The texts of a batch in turn, in lists of about ``size`` bytes; NULL is an empty text.

    A text's pieces take many times its size, so those of a whole batch are
    never in memory together.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = (np.flatnonzero(np.diff(ends // size)) + 1).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(column)]):
        yield [t or "" for t in column.slice(a, b - a).to_pylist()]


@cache
def encoder(path: str) -> Encoder:
    """One for each worker process, which serves many tasks."""
    return Encoder(path)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@contextmanager
def _draft(path: str) -> Iterator:
    """A stream to write, renamed when complete, so that the name stands for a whole file only."""
    files, place = _filesystem(path)
    folder, name = place.rsplit("/", 1)
    files.create_dir(folder, recursive=True)
    draft = f"{folder}/_{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        yield out
    files.move(draft, place)


def shard_count(docs: DataFrame) -> int:
    """Shards of about ``SHARD_BYTES`` by the plan's estimate, as many as shuffles have tasks at least."""
    estimate = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(-(-estimate // SHARD_BYTES), MOST_SHARDS))


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: Callable[[], str],
    end_id: int = END_ID,
    shards: int | None = None,
) -> DataFrame:
    """Encode ``text``, append ``end_id``, write shards; return the manifest.

    ``tokenizer`` gives the file's place on the machine it is called on.  A
    NULL text is an empty one; documents without an id come first; rows of one
    id follow each other by text.  The manifest, one row for each shard that
    has documents: shard, n_docs, n_ids, base.  Nothing is written for an empty
    table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b for b in batches if b.num_rows)
        if (batch := next(filled, None)) is None:
            return
        encode = encoder(tokenizer())
        shard, width = TaskContext.get().partitionId(), encode.kind.itemsize
        end = np.array([end_id], encode.kind).tobytes()
        # Of the ids only the documents' ends stay in memory.
        names, absent, ends = array("q"), array("Q"), array("Q", [0])
        with _draft(f"{path}/part-{shard:06d}.bin") as out:
            for batch in chain([batch], filled):
                for i in batch.column(0).to_pylist():
                    names.append(i or 0)
                    absent.append(i is None)
                for texts in portions(batch.column(1)):
                    pieces = encode.texts(texts)
                    out.write(end.join([*pieces, b""]))
                    for piece in pieces:
                        ends.append(ends[-1] + len(piece) // width + 1)
        header = np.array([MAGIC, VERSION, width, len(names), ends[-1]], "<u8")
        with _draft(f"{path}/part-{shard:06d}.idx") as out:
            for part in (header, np.array(ends, "<u8"), np.array(names, "<i8"), np.array(absent, "<u8")):
                out.write(part.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([len(names)]), pa.array([ends[-1]], pa.int64())],
            ["shard", "n_docs", "n_ids"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = (F.col("doc_id").asc_nulls_first(), F.col("text"))
    dealt = rows.repartitionByRange(shards or shard_count(docs), F.col("doc_id").asc_nulls_first())
    written = dealt.sortWithinPartitions(*order).mapInArrow(run, "shard long, n_docs long, n_ids long")
    # The shards are written here, once; the manifest has one row for each.
    found = sorted(tuple(r) for r in written.collect())
    manifest = docs.sparkSession.createDataFrame(found, "shard long, n_docs long, n_ids long")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


class Remote:
    """Ids in a file that cannot be mapped, read by the slices that are asked for."""

    def __init__(self, file, kind: str):
        self.file, self.kind = file, np.dtype(kind)

    def __getitem__(self, part: slice) -> np.ndarray:
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at((part.stop - part.start) * width, part.start * width), self.kind)


def open_shard(path: str, shard: int):
    """(ids, offsets, doc ids, absent) of a shard, memory-mapped where it is local."""

    def load(name: str, kind: str):
        files, place = _filesystem(f"{path}/{name}")
        if isinstance(files, pafs.LocalFileSystem):
            return np.memmap(place, kind, "r") if os.path.getsize(place) else np.empty(0, kind)
        if name.endswith(".bin"):
            return Remote(files.open_input_file(place), kind)
        with files.open_input_file(place) as file:
            return np.frombuffer(file.read(), kind)

    index = load(f"part-{shard:06d}.idx", "<u8")
    magic, version, width, n_docs, _ = index[:5].tolist()
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError(f"shard {shard} of {path} is not in this format")
    offsets, rest = index[5 : 6 + n_docs], index[6 + n_docs :]
    return load(f"part-{shard:06d}.bin", f"<u{width}"), offsets, rest[:n_docs].view("<i8"), rest[n_docs:]


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, offsets, names, absent = open_shard(path, shard)
                cuts = offsets.astype(np.int64)
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(names), mask=np.array(absent) == 1),
                        pa.array(cuts[:-1] + base),
                        pa.array(np.diff(cuts)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A row stands for a whole shard, so each gets a task of its own.
    spread = manifest.select("shard", "base").repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def public_tokenizer(name: str) -> Callable[[], str]:
    """Where the installed vocabulary of this name lies, found on each machine."""

    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)

    return path


def token_files(docs: DataFrame, name: str = "byte_bpe_50k.json") -> DataFrame:
    """The digest row of each document, read back from the files written for it."""
    spark: SparkSession = docs.sparkSession
    path = scratch_path(spark, "tokens")
    manifest = write_tokens(docs, path, public_tokenizer(name))
    delete_at_exit(spark, path)
    return read_tokens(manifest, path)
