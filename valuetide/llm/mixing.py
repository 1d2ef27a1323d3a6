"""Mixing sources to target weights by Pareto order sampling.

Each source gets a number of words to contribute.  As many whole copies of all
its documents as fit are certain; what is left of the target is drawn: every
document gets a random number U from its id, and documents are ranked by the
odds U / (1 - U) divided by their inclusion odds.  The first ones, up to the
words still wanted, are taken once more.

The ranking never sorts a source in one task: ranks are dealt into buckets of
about sqrt(n) documents, bucket totals give the words that stand before a
bucket, and only rows of one bucket are put in order together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, pick_rows, row_key, store

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, source_size, docs, target): words wanted of each source.

    Sources by code point, NULL last, take ``weights`` in turn and share
    ``share`` times all words.  A target stops at ``most`` times the source's
    words; the excess goes to the others by weight.  The common level is the
    largest one that follows from holding the first k sources, by words per
    weight, at their stop.  The windows here see one row for each source.
    """
    per = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    stops = per.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn.cast("int"))
    ).withColumn("stop", F.col("source_size") * most)
    order = (F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    up = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = F.coalesce(F.sum("source_size").over(up), F.lit(0)) * most
    level = (F.sum("source_size").over(everything) * share - before) / F.sum("weight").over(down)
    return (
        stops.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "source_size",
            "docs",
            F.least("stop", F.col("weight") * F.col("level")).alias("target"),
        )
    )


def uniform(key: Column, seed: str) -> Column:
    """A number between 0 and 1, ends excluded, from 52 bits of a digest of ``key``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def draw(sized: DataFrame, targets: DataFrame, seed: str = "mix") -> DataFrame:
    """``sized`` (source, size, doc_id, key, ...) with source_size, target and copies.

    Inclusion odds are those of the source's remaining share times sqrt(size),
    so longer documents are somewhat likelier.  Documents are taken in rank
    order while less than half of the next one lies beyond the words wanted.
    Equal ranks are broken by doc_id, size and key.
    """
    known = targets.withColumn("rate", F.try_divide("target", "source_size"))
    known = known.select(
        F.col("source").alias("__source"),
        "source_size",
        "target",
        F.coalesce(F.floor("rate"), F.lit(0)).cast("long").alias("__whole"),
        F.ceil(F.sqrt("docs")).cast("long").alias("__buckets"),
        F.sqrt(F.try_divide("source_size", "docs")).alias("__usual"),
    ).withColumn("__left", F.col("target") - F.col("__whole") * F.col("source_size"))
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("__source")))
    u = uniform(F.col("doc_id"), seed)
    share = F.col("__left") / F.col("source_size")
    wanted = (F.col("size") > 0) & (F.col("__left") > 0)
    rank = F.when(wanted, (u / (1 - u)) / (share / (1 - share) * F.sqrt("size")))
    # Ranks follow U / (1 - U) of a document of usual size, scaled; undone, they fill (0, 1) evenly.
    scaled = F.col("__rank") * (share / (1 - share)) * F.col("__usual")
    bucket = F.floor(scaled / (1 + scaled) * F.col("__buckets"))
    ranked = rows.withColumn("__rank", rank).withColumn("__bucket", bucket)
    # A row without a rank is never drawn; such rows are spread by their key.
    ranked = ranked.withColumn(
        "__bucket", F.coalesce("__bucket", -1 - F.pmod(F.xxhash64("doc_id", "key"), F.col("__buckets")))
    )
    in_source = Window.partitionBy("source").orderBy("__bucket")
    totals = (
        ranked.filter("__rank IS NOT NULL")
        .groupBy("source", "__bucket")
        .agg(F.sum("size").alias("__words"))
        .withColumn("__before", F.sum("__words").over(in_source) - F.col("__words"))
        .select(F.col("source").alias("__s"), F.col("__bucket").alias("__b"), "__before")
    )
    in_bucket = (
        Window.partitionBy("source", "__bucket")
        .orderBy("__rank", "doc_id", "size", "key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = ranked.withColumn("__words", F.sum("size").over(in_bucket)).join(
        totals,
        F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")),
        "left",
    )
    through = F.col("__before") + F.col("__words")
    drawn = F.col("__rank").isNotNull() & (2 * through - F.col("size") <= 2 * F.col("__left"))
    return placed.withColumn(
        "copies", F.col("__whole") + F.coalesce(drawn, F.lit(False)).cast("long")
    ).select(*sized.columns, "source_size", "target", "copies")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """(doc_id, key, source, size, source_size, target, copies) of every row.

    Texts are read once, to count their words; a NULL text has none.  Documents
    without a word are in as many copies as are certain for their source.  NULL
    is a source of its own.  Rows of one doc_id share a random number; reruns
    agree.  Extra columns are left out.  ``most`` is at most 2 and whole.
    """
    sized = store(
        docs.select("doc_id", row_key().alias("key"), "source", word_count(F.col("text")).alias("size")),
        "sizes",
    )
    return draw(sized, source_targets(sized, weights, share, most), seed)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as mixed: each row as often as it is taken, with all its columns."""
    picks = plan_mix(docs, **settings).groupBy("doc_id", "key")
    return pick_rows(
        docs, picks.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    )


def mixed_words(docs: DataFrame) -> DataFrame:
    """The digest row of each document (see ``plan_mix``)."""
    return plan_mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
