"""Quality rules: text statistics, and lines that many documents of a host share.

Lines are normalised and hashed with their host; for each hash the documents
of the host that hold it are counted.  Lines above the limits are removed, and
a document that loses too many of its words is rejected.  Everything is built
of DataFrame functions.

Texts are read once.  What is stored and shuffled are 64-bit line hashes and
word counts, combined before each shuffle, so a line in a third of all
documents costs no more than another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, words

# A line goes when at least MIN_DOCS documents of its host hold it, whatever the
# host's size; a document when less than MIN_LEFT of its words stay.
MIN_DOCS = 3
MIN_LEFT = 0.5
MIN_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_line(line: Column) -> Column:
    """Letters A-Z lowered, runs of digits to one 0, runs of space to one space, trimmed."""
    spaced = F.regexp_replace(F.translate(line, UPPER, LOWER), r"[\x20\x09-\x0D]+", " ")
    return F.trim(F.regexp_replace(spaced, "[0-9]+", "0"))


def sorted_windows(w: str) -> Column:
    """(h, at) of all three-word windows of array ``w``; equal ones are neighbours."""
    return F.expr(
        f"""
        sort_array(transform(
          IF(size({w}) < 3, array(), sequence(0, size({w}) - 3)),
          i -> struct(xxhash64(get({w}, i), get({w}, i + 1), get({w}, i + 2)) AS h, i AS at)))
        """
    )


def repeated_places(s: str) -> Column:
    """Places of the windows that occur twice or more, in order."""
    return F.expr(
        f"""
        sort_array(transform(
          filter(IF(size({s}) = 0, array(), sequence(0, size({s}) - 1)),
                 k -> coalesce(get({s}, k - 1).h = get({s}, k).h, false)
                      OR coalesce(get({s}, k + 1).h = get({s}, k).h, false)),
          k -> get({s}, k).at))
        """
    )


def covered_words(places: str) -> Column:
    """Words inside three-word windows at these places."""
    return F.expr(
        f"""
        aggregate({places}, struct(0L AS n, -3 AS last),
                  (a, at) -> struct(a.n + least(3, at - a.last) AS n, at AS last), a -> a.n)
        """
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """One row for each document: base statistics, and its lines as hashes.

    ``lines`` has (h, words) for each line with a word; h stands for the
    normalised line and the host.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col("source").alias("host"), text.alias("text")).select(
        "doc_id",
        "host",
        words(F.col("text")).alias("w"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("raw"),
    )
    counted = split.select(
        "doc_id",
        "host",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        sorted_windows("w").alias("windows"),
        F.transform("raw", normal_line).alias("normal"),
    )
    counted = counted.withColumn("places", repeated_places("windows")).drop("windows")
    counted = counted.withColumn("n_repeat_words", covered_words("places")).drop("places")
    spaces = lambda x: F.length(x) - F.length(F.translate(x, " ", ""))
    return counted.withColumn(
        "lines",
        F.transform(
            "normal",
            lambda x: F.struct(
                F.xxhash64(F.col("host").isNull(), F.col("host"), x).alias("h"), (spaces(x) + 1).alias("words")
            ),
        ),
    ).drop("normal")


def common_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """(h): lines that too many documents of their host hold."""
    each = rows.select(F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    held = each.groupBy("h").agg(F.count(F.lit(1)).alias("docs"))
    return held.filter(F.col("docs") >= min_docs).select("h")


def apply_rules(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """The digest row of each document, with ``n_common_words`` in removed lines.

    The host of a document is its ``source``; NULL is a host of its own.  A
    NULL text is an empty one: it has no words and fails the base rule.  Every
    row is a document, also one that repeats another.  Extra columns are left
    out; an empty table gives no rows.
    """
    rows = text_statistics(docs).withColumn("row", F.monotonically_increasing_id())
    # Stored, so that the row numbers are the same in every job that follows.
    rows = store(rows, "lines")
    lost = (
        rows.select("row", F.explode("lines").alias("line"))
        .select("row", "line.h", "line.words")
        .join(common_lines(rows, min_docs), "h")
        .groupBy("row")
        .agg(F.sum("words").alias("n_common_words"))
    )
    judged = rows.drop("lines").join(lost, "row", "left").fillna(0, ["n_common_words"])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    left = F.col("n_words") - F.col("n_common_words") >= F.lit(min_left) * F.col("n_words")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & left).alias("kept"),
        F.col("n_common_words").cast("long").alias("n_common_words"),
    )
