"""Repair of conversation structure by the cheapest edits, Hirschberg's way.

A conversation's rows are kept, given another role, deleted, or preceded by
inserted turns, until their roles read: nothing, or an optional system turn and
then user and assistant in turn, once or more.  What matters of the turns so
far is one of four states (nothing yet, system, user, assistant), so the edits'
costs up to a row are a vector of four.  The forward vector of the first half
and the backward vector of the second half meet mid-conversation; the state
that the cheapest edits cross there in is known then, and the two halves are
solved alone.  Only vectors are kept, never a table of back pointers.

Of equally cheap edits those with the ASCII-least audit, the edits' initials in
order, are taken.  The forward vector carries the rank of each state's least
audit.  Rank and state decide: a crossing lies right behind a row's own edit,
so no audit up to it is the beginning of another, and whichever is less there
stays less whatever follows.

Rows take part as one byte each, and a conversation may have more of them than
a task should: rows are dealt by ranges of (conversation, turn, role, text
hash), and each range holds one piece of the conversations at its rims.  For
such a piece the vectors from each of the four states are a small matrix; the
matrices of a conversation give its crossings at the rims, and the pieces are
solved apart.  Equal rows of one turn are counted before they are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store

# Fixed values of the contract: costs, white space, marks that end a turn.
RETITLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# The state after a user or assistant turn, whichever is due.
DUE = (USER, USER, ASSISTANT, USER)
KEEPS = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
LEGAL = {"su", "ua", "au"}
INITIALS = "sua?"
# A row's byte: place of its initial, and whether it must go or is cut short.
MUST_GO, CUT_SHORT = 4, 8
FAR = 1 << 60
CACHED_ROWS = 256


@cache
def moves(code: int) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """For each state the (state, cost, letters) that a row with its insertions leads to."""
    initial, extra = INITIALS[code & 3], UNFINISHED if code & CUT_SHORT else 0
    out = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}

        def offer(state: int, cost: int, letters: str) -> None:
            if state not in best or (cost, letters) < best[state]:
                best[state] = (cost, letters)

        state = start
        for n in range(3):
            cost, letters = n * INSERT, "I" * n
            offer(state, cost + DELETE, letters + "D")
            if not code & MUST_GO:
                if (state, initial) in KEEPS:
                    offer(KEEPS[state, initial], cost + extra, letters + "K")
                offer(DUE[state], cost + RETITLE + extra, letters + "R")
            state = DUE[state]
        out.append(tuple((s, c, x) for s, (c, x) in sorted(best.items())))
    return tuple(out)


# What completes a conversation from each state.
FINISH = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
MOVES = tuple(moves(c) for c in range(16))


def forward(codes: bytes, start: int) -> tuple[list[int], list[int]]:
    """(costs, ranks) of the four states behind the rows, beginning in ``start``."""
    costs, ranks = [FAR] * 4, [0] * 4
    costs[start] = 0
    for code in codes:
        fresh, keys = [FAR] * 4, [(0, "")] * 4
        for before, ways in enumerate(MOVES[code]):
            if (have := costs[before]) >= FAR:
                continue
            rank = ranks[before]
            for state, cost, letters in ways:
                total = have + cost
                if total < fresh[state] or (total == fresh[state] and rank < keys[state][0]):
                    fresh[state], keys[state] = total, (rank, letters)
        costs = fresh
        for rank, state in enumerate(sorted(range(4), key=keys.__getitem__)):
            ranks[state] = rank
    return costs, ranks


def backward(codes: bytes, end: int) -> list[int]:
    """Costs from each state before the rows to ``end`` behind them."""
    costs = [FAR] * 4
    costs[end] = 0
    for code in reversed(codes):
        costs = [min([FAR, *(cost + costs[state] for state, cost, _ in ways)]) for ways in MOVES[code]]
    return costs


def crossing(costs: list[int], ranks: list[int], rest: Iterable[int]) -> int:
    """The state of the cheapest way, the audit-least one of equals."""
    totals = [a + b for a, b in zip(costs, rest)]
    return min(range(4), key=lambda s: (totals[s], ranks[s]))


def audit_between(codes: bytes, start: int, end: int) -> str:
    """The least of the cheapest audits that lead from ``start`` to ``end``."""
    if len(codes) < 2:
        return next(x for state, _, x in MOVES[codes[0]][start] if state == end) if codes else ""
    half = len(codes) // 2
    left, right = codes[:half], codes[half:]
    state = crossing(*forward(left, start), backward(right, end))
    return audit_between(left, start, state) + audit_between(right, state, end)


def solve(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    costs, ranks = forward(codes, NOTHING)
    last = crossing(costs, ranks, [c for c, _ in FINISH])
    return costs[last] + FINISH[last][0], audit_between(codes, NOTHING, last) + FINISH[last][1]


@lru_cache(1 << 16)
def solve_short(codes: bytes) -> tuple[int, str]:
    """``solve`` with a memory: short conversations have few different shapes."""
    return solve(codes)


def matrix(codes: bytes) -> list[int]:
    """For each state before the rows the costs and the ranks of those behind."""
    return [x for start in range(4) for part in forward(codes, start) for x in part]


def crossings(matrices: list[list[int]]) -> tuple[int, list[int]]:
    """(cost, states at the rims) of a conversation from the matrices of its pieces."""
    rest = [[c for c, _ in FINISH]]
    for m in reversed(matrices):
        rest.append([min(m[8 * p + q] + rest[-1][q] for q in range(4)) for p in range(4)])
    rest.reverse()
    costs, ranks, states = [0, FAR, FAR, FAR], [0] * 4, [NOTHING]
    for m, after in zip(matrices, rest[1:]):
        ways = [
            min((costs[p] + m[8 * p + q], ranks[p], m[8 * p + 4 + q]) for p in range(4)) for q in range(4)
        ]
        costs = [min(w[0], FAR) for w in ways]
        for rank, q in enumerate(sorted(range(4), key=lambda q: ways[q][1:])):
            ranks[q] = rank
        states.append(crossing(costs, ranks, after))
    return rest[0][NOTHING], states


# --- rows


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) with the contract's damage done; NULLs are one space."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"), fault.alias("fault"))
    return rows.filter("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def with_hashes(rows: DataFrame) -> DataFrame:
    """Role and text as two 64-bit hashes; equal ones are taken for equal."""
    return rows.withColumns(
        {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit("again"), "role", "text")}
    )


def turn_order() -> list[Column]:
    """Rows by turn, NULL first; of one turn by role and hash, so equal ones are neighbours."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2")]


def coded_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, n, code, blank, seen), one row for all equal ones.

    ``code`` is the first one's byte and ``seen`` whether an earlier turn has
    its role and text; the others are duplicates in any case, unless blank.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    initial = F.left("role", F.lit(1))
    of = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    counted = (
        with_hashes(rows)
        .groupBy("conv_id", "turn", "role", "h1", "h2", of.alias("of"), (last == "").alias("blank"), last.isin(*ENDS).alias("ended"))
        .agg(F.sum("copies").cast("long").alias("n"))
    )
    counted = store(counted, "turns")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (
        counted.groupBy("conv_id", "h1", "h2")
        .agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("turns"))
        .filter("turns > 1")
        .select(F.col("conv_id").alias("__id"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
    seen = F.col("first").isNotNull() & (when > F.col("first"))
    must_go = F.when(F.col("blank") | F.col("seen"), MUST_GO).otherwise(0)
    cut = F.when(F.col("blank") | F.col("seen") | F.col("ended"), 0).otherwise(CUT_SHORT)
    return (
        counted.join(again, same, "left")
        .withColumn("seen", seen)
        .select(
            "conv_id", "turn", "role", "h1", "h2", "n",
            (F.col("of") + must_go + cut).cast("int").alias("code"),
            "blank", "seen",
        )
    )


ROW_FIELDS = ("turn", "role", "h1", "h2", "n", "code", "blank", "seen")
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of each run of rows that are equal in their first ``keys`` columns."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    for key, run in groupby(rows(), key=lambda r: r[:keys]):
        yield key, [r[keys:] for r in run]


def codes_of(rows: list[tuple]) -> bytes:
    """A byte a row; equal ones behind the first must go."""
    parts = []
    for _, _, _, _, n, code, _, _ in rows:
        parts.append(bytes((code,)) + bytes((code & 3 | MUST_GO,)) * (n - 1))
    return b"".join(parts)


def tally(rows: list[tuple], codes: bytes) -> dict:
    """Counts of the faults in a piece, and what its rims need for those across them."""
    counts = dict.fromkeys(COUNTS, 0)
    for _, _, _, _, n, code, blank, seen in rows:
        if blank:
            counts["blank"] += n
        else:
            counts["duplicate"] += n if seen else n - 1
            counts["truncated"] += bool(code & CUT_SHORT)
    initials = [INITIALS[c & 3] for c in codes]
    counts["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    known = [r[0] for r in rows if r[0] is not None]
    return counts | {
        "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None,
        "turns": len(set(known)),
        "first_initial": initials[0],
        "last_initial": initials[-1],
    }


def edits(rows: list[tuple], audit: str, state: int) -> Iterator[tuple]:
    """(turn, role, h1, h2, new role, edit) of the turns that ``audit`` leaves or inserts."""
    letters = iter(audit)
    for turn, role, h1, h2, n, _, _, _ in rows:
        for _ in range(n):
            while (letter := next(letters)) == "I":
                state = DUE[state]
                yield None, None, None, None, ROLES[state], letter
            if letter == "K":
                state = KEEPS[state, role[0]]
                yield turn, role, h1, h2, role, letter
            elif letter == "R":
                state = DUE[state]
                yield turn, role, h1, h2, ROLES[state], letter
    for letter in letters:
        state = DUE[state]
        yield None, None, None, None, ROLES[state], letter


EDIT_SCHEMA = "place long, old_turn {turn}, old_role string, h1 long, h2 long, new_role string, edit string"
PIECE_SCHEMA = (
    "audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
    "first_turn {turn}, last_turn {turn}, turns long, first_initial string, last_initial string, matrix array<long>"
)


def _schema(rows: DataFrame, *ddl: str) -> T.StructType:
    """conv_id and turn with the types that ``rows`` has, and the rest as written."""
    turn = rows.schema["turn"].dataType.simpleString()
    own = T.StructField("conv_id", rows.schema["conv_id"].dataType)
    return T.StructType([own, *T.StructType.fromDDL(", ".join(ddl).format(turn=turn)).fields])


def _batches(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few thousand."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 4096:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


def solve_pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces, edits) of coded rows.

    ``pieces``: conv_id, part and the columns of ``PIECE_SCHEMA``, in order of
    part those of one conversation.  ``edits``: conv_id, part, place and what
    is done for each turn of the repaired conversations.
    """
    order = [F.col("conv_id").asc_nulls_first(), *turn_order()]
    held = ", ".join(
        ["part int", "kind int", EDIT_SCHEMA, "n long, code int, blank_row boolean, seen boolean", PIECE_SCHEMA]
    )
    schema = _schema(rows, held)
    names = schema.names
    empty = dict.fromkeys(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def emitted() -> Iterator[tuple]:
            runs = _runs(batches, 1)
            here, first = next(runs, None), True
            while here:
                following = next(runs, None)
                (conv,), own = here
                codes = codes_of(own)
                base = empty | {"conv_id": conv, "part": part}
                found = tally(own, codes)
                if first or following is None:
                    # At a rim: the conversation may go on in the neighbouring range.
                    yield tuple((base | found | {"kind": 1, "matrix": matrix(codes)}).values())
                    for place, (turn, role, h1, h2, n, code, blank, seen) in enumerate(own):
                        row = {"kind": 2, "place": place, "old_turn": turn, "old_role": role, "h1": h1, "h2": h2}
                        yield tuple((base | row | {"n": n, "code": code, "blank_row": blank, "seen": seen}).values())
                else:
                    cost, audit = solve_short(codes) if len(codes) <= CACHED_ROWS else solve(codes)
                    yield tuple((base | found | {"kind": 0, "audit": audit, "cost": cost}).values())
                    for place, (turn, role, h1, h2, new, edit) in enumerate(edits(own, audit, NOTHING)):
                        row = {"place": place, "old_turn": turn, "old_role": role, "h1": h1, "h2": h2}
                        yield tuple((base | row | {"kind": 3, "new_role": new, "edit": edit}).values())
                here, first = following, False

        yield from _batches(emitted(), schema)

    ordered = rows.select("conv_id", *ROW_FIELDS).repartitionByRange(*order).sortWithinPartitions(*order)
    done = store(ordered.mapInArrow(run, schema), "pieces")
    edit_names = ["conv_id", "part", *T.StructType.fromDDL(EDIT_SCHEMA.format(turn="long")).names]
    piece_names = ["conv_id", "part", *T.StructType.fromDDL(PIECE_SCHEMA.format(turn="long")).names]
    inner = done.filter("kind = 0").select(*piece_names)
    rims = done.filter("kind = 1").select(*piece_names)
    solved, changed = _solve_rims(rims, done.filter("kind = 2"))
    whole = rims.drop("audit", "cost").join(
        solved.withColumnsRenamed({"conv_id": "__id", "part": "__part"}),
        F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("part") == F.col("__part")),
    )
    return (
        inner.unionByName(whole.select(*piece_names)),
        done.filter("kind = 3").select(*edit_names).unionByName(changed),
    )


def _solve_rims(rims: DataFrame, pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, audit, cost) and the edits of pieces that lie at a range's rim.

    A task gets a conversation's matrices, one for each range it spans, and
    then each piece is solved on its own.
    """
    conv = rims.schema["conv_id"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (key,), run in _runs(batches, 1):
                cost, states = crossings([m for _, m in run])
                for k, (part, _) in enumerate(run):
                    last = k == len(run) - 1
                    tail = FINISH[states[-1]][1] if last else ""
                    yield key, part, states[k], states[k + 1], tail, cost if k == 0 else 0

        yield from _batches(rows(), schema)

    schema = T.StructType(
        [conv, *T.StructType.fromDDL("part int, entry int, leave int, tail string, cost long").fields]
    )
    met = (
        rims.select("conv_id", "part", "matrix")
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
        .mapInArrow(meet, schema)
    )
    met = store(met, "crossings")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (key, part), run in _runs(batches, 2):
                entry, leave, tail, cost = run[0][:4]
                own = [r[5:] for r in run]
                audit = audit_between(codes_of(own), entry, leave) + tail
                yield key, part, None, audit, cost, None, None, None, None, None, None
                for place, edit in enumerate(edits(own, audit, entry)):
                    yield key, part, place, None, None, *edit

        yield from _batches(rows(), out)

    turn = pending.schema["old_turn"].dataType.simpleString()
    rest = f"old_turn {turn}, old_role string, h1 long, h2 long, new_role string, edit string"
    out = T.StructType(
        [conv, *T.StructType.fromDDL(f"part int, place long, audit string, cost long, {rest}").fields]
    )
    other = met.withColumnsRenamed({"conv_id": "__id", "part": "__part", "cost": "__cost"})
    joined = pending.join(
        other, F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("part") == F.col("__part"))
    ).select(
        "conv_id", "part", "entry", "leave", "tail", "__cost", "place", "old_turn", "old_role", "h1", "h2", "n", "code",
        F.col("blank_row"), "seen",
    )
    rebuilt = (
        joined.repartition("conv_id", "part")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "place")
        .mapInArrow(rebuild, out)
    )
    rebuilt = store(rebuilt, "rims")
    solved = rebuilt.filter("place IS NULL").select("conv_id", "part", "audit", "cost")
    return solved, rebuilt.filter("place IS NOT NULL").drop("audit", "cost")


def summaries(pieces: DataFrame) -> DataFrame:
    """One row a conversation, its pieces put together in order."""
    listed = F.array_sort(F.collect_list(F.struct("part", *[c for c in pieces.columns if c not in ("conv_id", "part", "matrix")])))
    parts = pieces.groupBy("conv_id").agg(listed.alias("p"))
    known = F.filter("p", lambda x: x["first_turn"].isNotNull())
    total = lambda c: F.aggregate(F.col(f"p.{c}"), F.lit(0).cast("long"), lambda a, x: a + x)
    pairs = lambda col, f: F.aggregate(
        F.when(F.size(col) > 1, F.sequence(F.lit(1), F.size(col) - 1)).otherwise(F.array().cast("array<int>")),
        F.lit(0).cast("long"),
        lambda a, i: a + F.when(f(F.get(col, i - 1), F.get(col, i)), 1).otherwise(0),
    )
    across = pairs(F.col("p"), lambda x, y: ~F.concat(x["last_initial"], y["first_initial"]).isin(*sorted(LEGAL)))
    shared = pairs(F.col("known"), lambda x, y: x["last_turn"] == y["first_turn"])
    span = F.get("known", F.size("known") - 1)["last_turn"] - F.get("known", F.lit(0))["first_turn"] + 1
    return parts.withColumn("known", known).select(
        "conv_id",
        F.coalesce(span - (total("turns") - shared), F.lit(0)).cast("long").alias("gaps"),
        total("blank").alias("blank"),
        total("duplicate").alias("duplicate"),
        total("truncated").alias("truncated"),
        (total("illegal") + across).cast("long").alias("illegal"),
        total("cost").alias("cost"),
        F.array_join(F.col("p.audit"), "").alias("audit"),
    )


def repaired_rows(rows: DataFrame, changed: DataFrame) -> DataFrame:
    """(conv_id, part, place, turn, role, text, edit): the edits with the texts they leave.

    Texts are met by conversation, turn, role and hash, equal ones once, so a
    long conversation is spread over many tasks.
    """
    keys = {"conv_id": "__id", "turn": "__turn", "role": "__role", "h1": "__h1", "h2": "__h2"}
    texts = with_hashes(rows).groupBy(*keys).agg(F.min("text").alias("text")).withColumnsRenamed(keys)
    same = (
        F.col("conv_id").eqNullSafe(F.col("__id"))
        & F.col("old_turn").eqNullSafe(F.col("__turn"))
        & (F.col("old_role") == F.col("__role"))
        & (F.col("h1") == F.col("__h1"))
        & (F.col("h2") == F.col("__h2"))
    )
    kept = changed.filter("edit <> 'I'").join(texts, same)
    inserted = changed.filter("edit = 'I'").withColumn("text", F.lit(""))
    columns = ["conv_id", "part", "place", F.col("old_turn").alias("turn"), F.col("new_role").alias("role"), "text", "edit"]
    return kept.select(*columns).unionByName(inserted.select(*columns))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summaries, repaired rows) of rows (conv_id, turn, role, text, copies).

    Rows of one turn are taken by role and by hash of role and text; NULL turns
    come first; NULL conv_ids are one conversation.  An initial other than s, u
    and a cannot be kept, an empty role neither.
    """
    pieces, changed = solve_pieces(coded_rows(rows))
    return summaries(pieces), repaired_rows(rows, changed)


def text_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha): the digest of each conversation's lines ``role:text``.

    A digest is of the whole in order, so a task streams a conversation's rows
    through it; it holds one batch at a time.
    """
    schema = T.StructType([rows.schema["conv_id"], T.StructField("sha", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def digests() -> Iterator[tuple]:
            for conv, run in groupby(lines(), key=lambda r: r[0]):
                digest, gap = hashlib.sha256(), ""
                for _, role, text in run:
                    digest.update(f"{gap}{role}:{text}".encode())
                    gap = "\n"
                yield conv, digest.hexdigest()

        yield from _batches(digests(), schema)

    return (
        rows.repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "place")
        .select("conv_id", "role", "text")
        .mapInArrow(run, schema)
    )


def damaged_repairs(conversations: DataFrame) -> DataFrame:
    """The digest row of every conv_id, NULL included, after damage and repair.

    See ``damage`` and ``repair`` for hard rows; rows of one conversation may
    be repeated.  Conversations without rows after damage have zeros, an empty
    audit and the digest of the empty text.  Extra columns are left out; an
    empty table gives no rows.
    """
    found, rows = repair(damage(conversations))
    digests = text_digests(rows).select(F.col("conv_id").alias("__text"), "sha")
    found = found.withColumnRenamed("conv_id", "__id")
    nothing = hashlib.sha256(b"").hexdigest()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        conversations.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("__text")), "left")
        .select(
            "conv_id",
            *map(zero, ("gaps", *COUNTS, "cost")),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"),
        )
    )
