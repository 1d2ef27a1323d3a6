"""Role adapters: users, events and transactions out of the star-schema tables.

The star schema has no signup dates, devices or refunds, so two fixtures derive
them deterministically.  ``activity`` reads the event stream (sub-day times,
one month); ``commerce`` reads orders and line items (day-granular, seven
years, refunds, many signup cohorts).

Both are clean.  The ``raw`` form of each is what a source may deliver: all
customers are users, also those never active; some users are missing, repeated
or signed up late; a stretch of days is silent; some amounts, refunds and
durations break their rules.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import pieces_of
from .sinks import materialize

# Fixture choices for the derived roles.
ACTIVITY_TYPES = {
    "signup": "login",
    "view": "browse",
    "click": "search",
    "error": "add_to_cart",
    "purchase": "purchase",
}
LINE_TYPES = ["login", "browse", "search", "favorite", "add_to_cart"]
DEVICES = ["Android", "iOS", "Web"]
ACTIVITY_SNAPSHOTS = [dt.date(2024, 1, d) for d in (5, 12, 19, 26)]
COMMERCE_SNAPSHOTS = [dt.date(2000, m, 1) for m in range(7, 13)] + [
    dt.date(2001, m, 1) for m in range(1, 4)
]
# Days of a user are wider than the orders and lines they come from.
PIECES_BY_USER = 2


SILENT = {
    "activity": (dt.date(2024, 1, 9), dt.date(2024, 1, 17)),
    "commerce": (dt.date(1996, 5, 1), dt.date(1996, 7, 31)),
}


@dataclass(frozen=True)
class World:
    users: DataFrame
    events: DataFrame
    transactions: DataFrame
    snapshot_dates: list[dt.date]
    # Into how many pieces users and their facts are dealt; None leaves it to the session.
    user_pieces: int | None = None
    # Users out of events, for who stores these first; None where users are a table.
    users_of: Callable[[DataFrame], DataFrame] | None = None

    @property
    def tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.users, self.events, self.transactions


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    chosen = F.when(index == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        chosen = chosen.when(index == i, v)
    return chosen


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    place = (
        _table(spark, folder, "nation")
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("region"))
    )
    return (
        _table(spark, folder, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("channel"), "region")
    )


def _users(spark: SparkSession, folder: str, events: DataFrame) -> DataFrame:
    """Signup is the first event day; attributes come from the customer table."""
    signup = events.groupBy("user_id").agg(F.to_date(F.min("event_time")).alias("signup_date"))
    return signup.join(_customers(spark, folder), "user_id", "left").select(
        "user_id",
        "signup_date",
        "channel",
        "region",
        _pick(DEVICES, F.col("user_id") % 3).alias("device"),
    )


def activity_world(spark: SparkSession, folder: str) -> World:
    raw = _table(spark, folder, "events")
    mapped = F.when(F.lit(False), F.lit(""))
    for source, role in ACTIVITY_TYPES.items():
        mapped = mapped.when(F.col("event_type") == source, role)
    events = raw.select(
        "event_id",
        "user_id",
        F.col("ts").alias("event_time"),
        mapped.alias("event_type"),
        F.col("value").cast("decimal(10,2)").alias("session_duration"),
    )
    amount = F.col("value").cast("decimal(12,2)")
    refund = F.when(F.col("event_id") % 10 == 0, amount).otherwise(F.lit(0).cast("decimal(12,2)"))
    transactions = raw.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"),
        "user_id",
        F.col("ts").alias("order_time"),
        amount.alias("amount"),
        refund.alias("refund_amount"),
    )
    return World(_users(spark, folder, events), events, transactions, ACTIVITY_SNAPSHOTS)


def commerce_world(spark: SparkSession, folder: str, channel: str | None = None) -> World:
    """With ``channel`` the roles of its customers only, whose orders are taken before they meet their lines."""
    orders = _table(spark, folder, "orders")
    if channel is not None:
        members = _customers(spark, folder).where(F.col("channel") == channel).select("user_id")
        orders = orders.join(members, F.col("o_custkey") == F.col("user_id"), "left_semi")
    # Line numbers repeat within an order; the place in it is its own.
    content = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*content))
    lines = _table(spark, folder, "lineitem")
    pieces = pieces_of(lines)
    lines = lines.repartition(*pieces, "l_orderkey").withColumn("place", place)
    headers = orders.repartition(*pieces, "o_orderkey")
    order_events = orders.select(
        (F.col("o_orderkey") * 1000).alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        (F.col("o_orderkey") % 60).cast("decimal(10,2)").alias("session_duration"),
    )
    owner = headers.select("o_orderkey", "o_custkey")
    line_events = lines.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 1000 + F.col("place")).alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_shipdate").alias("event_time"),
        _pick(LINE_TYPES, F.col("l_linenumber") % 5).alias("event_type"),
        F.col("l_quantity").cast("decimal(10,2)").alias("session_duration"),
    )
    events = order_events.unionByName(line_events)
    returned = (
        lines.where(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("returned"))
    )
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    refund = F.least(amount, F.coalesce("returned", F.lit(0))).cast("decimal(12,2)")
    transactions = headers.join(
        returned, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_time"),
        amount.alias("amount"),
        refund.alias("refund_amount"),
    )
    by_user = PIECES_BY_USER * pieces[0] if pieces else None
    users_of = partial(_users, spark, folder)
    return World(users_of(events), events, transactions, COMMERCE_SNAPSHOTS, by_user, users_of)


def stored_facts(w: World, events: tuple[str, ...] = ()) -> World:
    """The roles with facts stored once, of which lines meet their orders once, and users from the stored events.

    ``events`` names the columns to store of them, all if none.
    """
    events = materialize(w.events.select(*(events or "*")), "events")
    transactions = materialize(w.transactions, "transactions")
    return replace(w, users=w.users_of(events) if w.users_of else w.users, events=events, transactions=transactions)


def stored_commerce(spark: SparkSession, folder: str) -> World:
    """The commerce roles, each stored once, for queries that take them several times."""
    w = stored_facts(commerce_world(spark, folder))
    return replace(w, users=materialize(w.users, "users"))


def raw_world(spark: SparkSession, folder: str, name: str) -> World:
    clean = WORLDS[name](spark, folder)
    first = clean.users.select("user_id", F.col("signup_date").alias("first_day"))
    fallback = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("user_id") % 700).cast("int"))
    late = F.when(F.col("user_id") % 97 == 5, 400).otherwise(0)
    users = (
        _customers(spark, folder)
        .where(F.col("user_id") % 89 != 3)
        .join(first, "user_id", "left")
        .select(
            "user_id",
            F.date_add(F.coalesce("first_day", fallback), late).alias("signup_date"),
            "channel",
            "region",
            _pick(DEVICES, F.col("user_id") % 3).alias("device"),
        )
    )
    users = users.unionByName(users.where(F.col("user_id") % 501 == 7))
    silent = F.to_date("event_time").between(*map(F.lit, SILENT[name]))
    broken = F.when(F.col("event_id") % 211 == 4, -1).otherwise(F.col("session_duration"))
    events = clean.events.where(~silent).withColumn("session_duration", broken.cast("decimal(10,2)"))
    amount = F.when(F.col("order_id") % 53 == 2, 0).otherwise(F.col("amount"))
    refund = F.when(F.col("order_id") % 59 == 1, F.col("amount") + 1).otherwise(F.col("refund_amount"))
    transactions = clean.transactions.withColumns(
        {"amount": amount.cast("decimal(12,2)"), "refund_amount": refund.cast("decimal(12,2)")}
    )
    return World(users, events, transactions, clean.snapshot_dates)


WORLDS = {"activity": activity_world, "commerce": commerce_world}
WORLDS |= {
    f"{name}_raw": lambda spark, folder, name=name: raw_world(spark, folder, name) for name in list(WORLDS)
}
