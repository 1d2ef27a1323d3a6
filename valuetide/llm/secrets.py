"""Secret scans: fixed patterns, and a sliding-window entropy test.

Candidate strings are long runs of token characters.  Each belongs to the
narrowest character class that holds it, and a window slides over it: the sum
of c * log2(c) over the counts c of its characters is updated for the one
character that leaves and the one that enters, and tells the Shannon entropy.
Windows at or above the class's threshold become spans.  An allow list keeps
words, numbers and identifiers out as a whole, and place-holders where a window
holds one.

All of it is DataFrame expressions on one row: nothing is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base patterns and the characters that must follow.
ASSIGN = (
    "(" + "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# Narrowest class first: its characters, and the entropy in bits a character.
CLASSES = (
    ("^[0-9A-Fa-f]+$", 3.0),
    ("^[0-9A-Za-z]+$", 3.7),
    ("^[A-Za-z0-9+/_=-]+$", 3.8),
)
ALLOWED = (
    r"^[A-Za-z]+([-_/+=]+[A-Za-z]+)*[-_/+=]*$",
    r"^[0-9+/_=-]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
)
PLACE_HOLDERS = (either_case("example"), either_case("placeholder"), "[Xx]{4}")
# A candidate is cut into pieces that overlap by a window less one, so that a
# step costs the same in a long one.
PIECE = 1000
# c * log2(c) in steps of 2 ** -20, for whole-number sums.
TERMS = [round(c * math.log2(c) * (1 << 20)) if c else 0 for c in range(WINDOW + 1)]
PREFIX_BLOCK = 1000


def highest_sum(bits: float) -> int:
    """The largest sum of terms of a window with at least this entropy."""
    return int(WINDOW * (math.log2(WINDOW) - bits) * (1 << 20))


def prefix_sums(steps: str) -> str:
    """SQL for the running totals of a long array, in blocks.

    Appending to an array copies it; blocks keep that from growing with the
    square of a long array.
    """
    b = PREFIX_BLOCK
    block = f"slice({steps}, k * {b} + 1, {b})"
    offsets = f"""aggregate(sequence(0, (size({steps}) - 1) DIV {b}), array(0L),
      (acc, k) -> concat(acc, array(element_at(acc, -1) + aggregate({block}, 0L, (x, y) -> x + y))))"""
    return f"""flatten(transform({offsets}, (base, k) ->
      slice(aggregate({block}, array(base),
                      (acc, y) -> concat(acc, array(element_at(acc, -1) + y))), 2, {b})))"""


def matches(df: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Add array ``name`` of (start, end, string) of all matches in ``text``.

    ``split`` finds the same matches as ``regexp_extract_all``, so what stands
    between them and the matches' own lengths give the places, in code points.
    ``string`` is the given group.
    """
    found, own = f"__{name}_found", f"__{name}_own"
    some = F.col("text").rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.when(some, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(
        own,
        F.when(F.size(found) > 0, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(none)
        if group
        else F.col(found),
    )
    steps, starts = f"__{name}_steps", f"__{name}_starts"
    df = df.withColumn(f"__{name}_gaps", F.when(F.size(found) > 0, F.split("text", pattern, -1)).otherwise(none))
    df = df.withColumn(
        steps,
        F.expr(
            f"""zip_with(slice(__{name}_gaps, 1, size({found})),
                         slice(concat(array(''), {found}), 1, size({found})),
                         (gap, before) -> CAST(length(gap) + length(before) AS BIGINT))"""
        ),
    )
    df = df.withColumn(starts, F.expr(f"IF(size({found}) = 0, array(), {prefix_sums(steps)})"))
    spans = f"""zip_with({starts}, zip_with({found}, {own}, (a, b) -> struct(a AS whole, b AS string)),
      (s, m) -> struct(s AS start, s + length(m.whole) AS end, m.string AS string))"""
    return df.withColumn(name, F.expr(spans)).drop(found, own, steps, starts, f"__{name}_gaps")


def entropy_spans(candidates: str) -> Column:
    """(start, end) of the runs of high-entropy windows in the candidates."""
    limits = "CASE " + " ".join(
        f"WHEN c.string RLIKE '{chars}' THEN {highest_sum(bits)}L" for chars, bits in CLASSES
    ) + " END"
    suspicious = " AND ".join(f"NOT c.string RLIKE '{p}'" for p in ALLOWED)
    terms = "array(" + ", ".join(f"{t}L" for t in TERMS) + ")"
    fake = "|".join(PLACE_HOLDERS)
    w, step = WINDOW, PIECE - WINDOW + 1
    pieces = f"""flatten(transform(filter({candidates}, c -> {suspicious}), c ->
      transform(sequence(0, greatest(0, (length(c.string) - {w}) DIV {step})), k -> struct(
        c.start + k * {step} AS base, {limits} AS most,
        c.string RLIKE '{fake}' AS fake, substr(c.string, k * {step} + 1, {PIECE}) AS s))))"""
    # In a step, ``kept`` is the window without the character that leaves.
    leaving = f"IF(i > {w}, substr(p.s, i - {w}, 1), '')"
    kept = f"IF(i > {w}, substr(p.s, i - {w - 1}, {w - 1}), substr(p.s, 1, i - 1))"
    count = lambda char: f"(length(x.kept) - length(replace(x.kept, {char}, '')))"
    without = f"IF(x.gone = '', 0L, element_at({terms}, {count('x.gone')} + 1) - element_at({terms}, {count('x.gone')} + 2))"
    added = f"element_at({terms}, {count('x.came')} + 2) - element_at({terms}, {count('x.came')} + 1)"
    total = f"""element_at(transform(array(struct({leaving} AS gone, substr(p.s, i, 1) AS came, {kept} AS kept)),
      x -> a.total + {without} + {added}), 1)"""
    hit = f"i >= {w} AND t <= p.most AND NOT (p.fake AND substr(p.s, i - {w - 1}, {w}) RLIKE '{fake}')"
    grown = f"""CASE WHEN NOT ({hit}) THEN a.spans
      WHEN size(a.spans) > 0 AND element_at(a.spans, -1).end >= p.base + i - {w}
        THEN concat(slice(a.spans, 1, size(a.spans) - 1),
                    array(struct(element_at(a.spans, -1).start AS start, p.base + i AS end)))
      ELSE concat(a.spans, array(struct(p.base + i - {w} AS start, p.base + i AS end))) END"""
    none = "CAST(array() AS array<struct<start: bigint, end: bigint>>)"
    scan = f"""aggregate(sequence(1, length(p.s)), struct(0L AS total, {none} AS spans),
      (a, i) -> element_at(transform(array({total}), t -> struct(t AS total, {grown} AS spans)), 1),
      a -> a.spans)"""
    found = f"flatten(transform({pieces}, p -> {scan}))"
    merged = f"""aggregate({found}, {none}, (acc, s) ->
      IF(size(acc) > 0 AND element_at(acc, -1).end >= s.start,
         concat(slice(acc, 1, size(acc) - 1),
                array(struct(element_at(acc, -1).start AS start, s.end AS end))),
         concat(acc, array(s))))"""
    return F.expr(f"IF(size({candidates}) = 0, {none}, {merged})")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, assign, access, hex, entropy): arrays of (start, end) in code points.

    Ends are exclusive.  A NULL text is an empty one and has no span.  Entropy
    spans inside a span of another kind are left out.  Rows are scanned each
    for itself, whatever their ids; extra columns are left out.
    """
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = matches(df, "assign", ASSIGN, 2)
    df = matches(matches(matches(df, "access", ACCESS), "hex", HEX), "candidates", CANDIDATE)
    df = df.drop("text").withColumn("entropy", entropy_spans("candidates")).drop("candidates")
    long_enough = f"filter(assign, m -> length(m.string) >= {ASSIGN_LEAST})"
    plain = lambda name: f"transform({name}, m -> struct(m.start AS start, m.end AS end))"
    df = df.select(
        "doc_id",
        F.expr(plain(long_enough)).alias("assign"),
        F.expr(plain("access")).alias("access"),
        F.expr(plain("hex")).alias("hex"),
        "entropy",
    )
    inside = " OR ".join(f"exists({k}, b -> b.start <= e.start AND e.end <= b.end)" for k in KINDS[:3])
    return df.withColumn("entropy", F.expr(f"filter(entropy, e -> NOT ({inside}))"))


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by start, then kind as listed, comma-joined."""
    parts = ", ".join(
        f"transform({k}, m -> struct(m.start AS start, {i} AS place, m.end AS end, '{k}' AS kind))"
        for i, k in enumerate(kinds)
    )
    return F.expr(
        f"""array_join(transform(sort_array(concat({parts})),
                                 m -> concat_ws(':', m.kind, m.start, m.end)), ',')"""
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """The digest row of each document (see ``scan``)."""
    return scan(docs).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )
