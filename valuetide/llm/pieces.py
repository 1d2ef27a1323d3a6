"""SentencePiece ids of merge-type vocabularies, by an agenda of symbol pairs.

A normalised text starts as its characters.  Every two neighbours whose
joined string is a piece stand on an agenda, the highest score first, the
leftmost of equal scores.  The top pair is merged and the merged symbol's
pairs with its neighbours take their places.  What is left when the agenda is
empty are the text's pieces; characters that are no piece become their bytes.
The agenda of a long text is a heap, in which pairs that have changed since are
passed over.  Short ones are worked side by side, each a row of symbols and one
of its pairs' costs in order of place: a round merges the first least pair of
every row.  Vocabularies without bytes have plain lists for runs with unknown
characters.

Where no piece has a space sign behind another character, no pair crosses the
edge before a space sign, so the runs between these edges are encoded each for
itself and a worker keeps the ids of recent ones.  A vocabulary with such a
piece has its texts encoded whole.

Texts go through one narrow map in Arrow batches.  What a batch holds of runs
that the worker does not know is encoded by the agenda and, in one call, by the
library; a text agrees if all of its runs do.  The library decodes the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .binary import public_tokenizer
from .common import Recent

CACHE_RUNS = 600_000
CACHED_CHARS = 64
# Runs up to a length share an agenda of so many columns; longer ones have a heap each.
WIDTHS = (8, 12, 16, 24, 48)
# Runs worked side by side, few enough for the processor's cache.
ROWS = 2_000
NEVER = float("inf")
BATCH_CHARS = 4_000_000

# Fixed value: the sign that stands for a space in pieces.
SPACE = "▁"
RUN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """Ids of whole texts by the vocabulary at ``path``."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = library = SentencePieceProcessor(model_file=path)
        size = library.vocab_size()
        names = [library.id_to_piece(i) for i in range(size)]
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        own = [
            i
            for i in range(size)
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))
        ]
        if any(library.is_unused(i) for i in own):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids = {names[i]: i for i in own}
        self.costs = {names[i]: -library.get_score(i) for i in own}
        self.unknown = library.unk_id()
        self.whole = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.decimal = list(map(str, range(size)))
        self.pairs: np.ndarray | None = None
        self.differing: set[str] = set()
        self.recent = Recent(self.checked, CACHE_RUNS)

    def _number_pairs(self) -> None:
        """Numbers for symbols, those of pieces their ids, and what each pair of them makes.

        Characters that are no piece come after the ids, in order of their code
        points, and then the edge of a row.
        """
        size = len(self.decimal)
        numbers = {c: size + ord(c) for p in self.ids for c in p} | self.ids
        self.pieces, self.edge = size, size + 0x110000
        self.letters = np.arange(size, self.edge, dtype=np.int32)
        for symbol, number in numbers.items():
            if len(symbol) == 1:
                self.letters[ord(symbol)] = number
        made = {
            (numbers[p[:cut]] * (self.edge + 1) + numbers[p[cut:]]): i
            for p, i in self.ids.items()
            for cut in range(1, len(p))
            if p[:cut] in numbers and p[cut:] in numbers
        }
        self.pairs = np.array(sorted(made) + [np.iinfo(np.int64).max])
        self.made = np.array([made[k] for k in self.pairs[:-1].tolist()] + [0], np.int32)
        costs = np.full(size, NEVER)
        for piece, i in self.ids.items():
            costs[i] = self.costs[piece]
        self.made_costs = costs[self.made]

    def _joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs of pairs of symbols and what they make; no cost is as high as that of no piece."""
        keys = left.astype(np.int64) * (self.edge + 1) + right
        places = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[places] == keys, self.made_costs[places], NEVER), self.made[places]

    def side_by_side(self, runs: list[str], width: int) -> list[bytes | None]:
        """Ids of runs of at most ``width`` characters; None where an unknown one has no bytes."""
        if self.pairs is None:
            self._number_pairs()
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        columns = np.arange(width + 2)
        symbols = np.full((len(runs), width + 2), self.edge, np.int32)
        inside = (columns >= 1) & (columns <= lengths[:, None])
        symbols[inside] = self.letters[np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")]
        costs, made = self._joined(symbols[:, :-1], symbols[:, 1:])
        out: list[bytes | None] = [None] * len(runs)
        rows = np.arange(len(runs))
        while len(rows):
            first = costs.argmin(1)
            each = np.arange(len(rows))
            on = costs[each, first] < NEVER
            if not on.all():
                # Nothing is left on these agendas: their symbols are the pieces.
                done = symbols[~on]
                whole = ((done < self.pieces) | (done == self.edge)).all(1)
                counts = (done != self.edge).sum(1)
                for row, fine, n, ids in zip(rows[~on].tolist(), whole.tolist(), counts.tolist(), done):
                    if fine:
                        out[row] = ids[1 : n + 1].tobytes()
                    elif self.bytes:
                        out[row] = self._with_bytes(ids[1 : n + 1].tolist())
                rows, symbols, costs, made, first = rows[on], symbols[on], costs[on], made[on], first[on]
                each = each[: len(rows)]
                if not len(rows):
                    break
            merged, k = made[each, first], first[:, None]
            symbols = np.take_along_axis(symbols, np.minimum(columns + (columns > k), width + 1), 1)
            symbols[:, -1] = self.edge
            symbols[each, first] = merged
            kept = np.minimum(columns[:-1] + (columns[:-1] >= k), width)
            costs, made = np.take_along_axis(costs, kept, 1), np.take_along_axis(made, kept, 1)
            for place in (first - 1, first):
                costs[each, place], made[each, place] = self._joined(symbols[each, place], symbols[each, place + 1])
        return out

    def _with_bytes(self, symbols: list[int]) -> bytes:
        out: list[int] = []
        for s in symbols:
            out += [s] if s < self.pieces else [self.bytes[b] for b in chr(s - self.pieces).encode()]
        return np.array(out, "<u4").tobytes()

    def symbols(self, text: str) -> list[str]:
        """What is left of the characters of ``text`` when no pair can be merged."""
        return self.by_list(text) if len(text) <= WIDTHS[-1] else self.by_heap(text)

    def by_list(self, text: str) -> list[str]:
        cost = self.costs.get
        symbols = list(text)
        agenda = [cost(pair, NEVER) for pair in map(str.__add__, text, text[1:])]
        while agenda and (least := min(agenda)) < NEVER:
            k = agenda.index(least)
            merged = symbols[k] = symbols[k] + symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = cost(merged + symbols[k + 1], NEVER)
            if k:
                agenda[k - 1] = cost(symbols[k - 1] + merged, NEVER)
        return symbols

    def by_heap(self, text: str) -> list[str]:
        held: list[str | None] = list(text)
        costs, n = self.costs, len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []
        for k in range(n - 1):
            pair = held[k] + held[k + 1]
            if (cost := costs.get(pair)) is not None:
                agenda.append((cost, k, k + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            a, b = held[left], held[right]
            # Symbols only grow, so a pair of the same length is the same pair.
            if a is None or b is None or len(a) + len(b) != len(pair):
                continue
            held[left], held[right] = pair, None
            follows = after[left] = after[right]
            if follows < n:
                before[follows] = left
                joined = pair + held[follows]
                if (cost := costs.get(joined)) is not None:
                    heapq.heappush(agenda, (cost, left, follows, joined))
            if (leads := before[left]) >= 0:
                joined = held[leads] + pair
                if (cost := costs.get(joined)) is not None:
                    heapq.heappush(agenda, (cost, leads, left, joined))
        return [s for s in held if s is not None]

    def run_ids(self, text: str) -> list[int]:
        found = self.ids.get
        out: list[int] = []
        for symbol in self.symbols(text):
            if (i := found(symbol)) is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        if self.bytes or self.unknown not in out:
            return out
        # Without bytes, neighbouring unknown characters share one id.
        return [i for k, i in enumerate(out) if i != self.unknown or k == 0 or out[k - 1] != i]

    def checked(self, runs: list[str]) -> list[bytes]:
        """The ids of runs as 32-bit words; runs that the library encodes otherwise are noted."""
        found: list[bytes | None] = [None] * len(runs)
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        for above, width in zip((0, *WIDTHS), WIDTHS):
            places = np.flatnonzero((lengths > above) & (lengths <= width)).tolist()
            for start in range(0, len(places), ROWS):
                some = places[start : start + ROWS]
                for place, ids in zip(some, self.side_by_side([runs[k] for k in some], width)):
                    found[place] = ids
        ids = [np.array(self.run_ids(r), "<u4").tobytes() if x is None else x for r, x in zip(runs, found)]
        # The library puts its space sign before a text, so a run's own first one is left out.
        bare = [r.removeprefix(SPACE).replace(SPACE, " ") for r in runs]
        theirs = self.library.encode(bare, num_threads=1)
        counts = np.fromiter(map(len, theirs), np.int64, len(runs))
        whole = np.fromiter(chain.from_iterable(theirs), "<u4", counts.sum()).tobytes()
        ends = (4 * counts.cumsum()).tolist()
        same = (x == whole[a:b] for x, a, b in zip(ids, [0, *ends], ends))
        self.differing.update(r for r, fine in zip(runs, same) if not fine and r != SPACE)
        return ids

    def runs(self, normal: str) -> list[str]:
        """Parts of a normalised text that are encoded each for itself."""
        if self.whole or not self.bytes or not normal.startswith(SPACE):
            return [normal] if normal else []
        return RUN.findall(normal)

    def encode(self, texts: list[str]) -> list[tuple[list[int], bool]]:
        """For each text its ids, and whether the library agrees."""
        runs = [self.runs(n) for n in map(self.library.normalize, texts)]
        # Long runs hardly come again and would fill the cache.
        ids = iter(self.recent([r for own in runs for r in own if len(r) <= CACHED_CHARS]))
        out = []
        for own in runs:
            if not own or len(max(own, key=len)) <= CACHED_CHARS:
                parts = list(islice(ids, len(own)))
            else:
                long = iter(self.checked([r for r in own if len(r) > CACHED_CHARS]))
                parts = [next(ids if len(r) <= CACHED_CHARS else long) for r in own]
            agrees = not self.differing or self.differing.isdisjoint(own)
            out.append((np.frombuffer(b"".join(parts), "<u4").tolist(), agrees))
        return out


@cache
def vocabulary(path: str) -> Pieces:
    """One for each worker process, which serves many tasks."""
    return Pieces(path)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Places of the batch, cut where the texts so far are long enough together."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= BATCH_CHARS:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(
    docs: DataFrame, tokenizer: Callable[[], str], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids, decoded, agrees) of every row; see ``piece_digests`` for hard rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, decoded, agrees in _encoded(batches, tokenizer()):
            columns = [keys, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(agrees)]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded", "agrees"])

    rows = docs.select(key, F.col(text).cast("string").alias("__text"))
    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
        T.StructField("agrees", T.BooleanType()),
    ]
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], *fields]))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple]:
    for batch in batches:
        pieces = vocabulary(path)
        texts = batch.column(1).to_pylist()
        for a, b in _slices(texts):
            some = [t or "" for t in texts[a:b]]
            ids, agrees = map(list, zip(*pieces.encode(some)))
            yield batch.column(0).slice(a, b - a), ids, pieces.library.decode(ids, num_threads=1), agrees


def piece_digests(docs: DataFrame, name: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees) of every row.

    ``agrees`` says whether the library gives the same ids for the text's runs.  NULL
    and empty texts have no ids and decode to the empty text.  Rows are encoded
    each for itself, whatever their ids and however often they come; extra
    columns are left out; an empty table gives no rows.
    """
    tokenizer = public_tokenizer(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for keys, ids, decoded, agrees in _encoded(batches, tokenizer()):
            decimal = vocabulary(tokenizer()).decimal.__getitem__
            columns = [
                keys,
                pa.array(list(map(len, ids)), pa.int64()),
                pa.array([digest(",".join(map(decimal, x))) for x in ids], pa.string()),
                pa.array(list(map(digest, decoded)), pa.string()),
                pa.array(agrees, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("agrees", T.BooleanType()),
    ]
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], *fields]))
