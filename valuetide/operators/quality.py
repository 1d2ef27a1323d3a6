"""Data-quality rules, declared constraints and table profiles.

Each fact table is scanned once for all of its rules.  A users table that fits
a broadcast comes to the facts, which are then not shuffled at all; beyond that
they are reduced to one row per user and day before they meet it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast
from ..sources import schemas

# What each rule says when rows break it.
RULES = {
    "users_key": "user ids are missing or repeated in {n} rows",
    "orphan_events": "{n} user ids of events are not among the users",
    "orphan_transactions": "{n} user ids of transactions are not among the users",
    "event_before_signup": "{n} events lie before their user's signup",
    "session_duration": "{n} session durations are missing or negative",
    "order_before_signup": "{n} orders lie before their user's signup",
    "amount": "{n} amounts are missing or not above zero",
    "refund": "{n} refunds are missing, negative or above the amount",
}


def _signups(users: DataFrame) -> DataFrame:
    """One row per known user, even where the key is violated."""
    return users.groupBy("user_id").agg(F.min(F.to_date("signup_date")).alias("signup_date"))


def _check_facts(users, facts, time, bad: dict) -> DataFrame:
    """One row: unknown users, rows before signup, and the row-level rules.

    A row's time precedes midnight of the signup day exactly when its date
    does, so the comparison works on days.
    """
    rows = facts.select("user_id", F.to_date(time).alias("date"), *[c.alias(k) for k, c in bad.items()])
    known = _signups(users).withColumn("known", F.lit(True))
    if fits_broadcast(users):
        each = rows.join(F.broadcast(known), "user_id", "left").select(
            "*", F.lit(1).alias("n"), *[F.col(k).cast("int").alias(f"n_{k}") for k in bad]
        )
    else:
        daily = rows.groupBy("user_id", "date").agg(
            F.count("*").alias("n"), *[F.count_if(k).alias(f"n_{k}") for k in bad]
        )
        each = daily.join(known, "user_id", "left")
    stranger = F.col("known").isNull()
    early = F.col("date") < F.col("signup_date")
    return each.agg(
        (
            F.countDistinct(F.when(stranger, F.col("user_id")))
            + F.coalesce(F.max((stranger & F.col("user_id").isNull()).cast("int")), F.lit(0))
        ).alias("orphans"),
        F.coalesce(F.sum(F.when(early, F.col("n"))), F.lit(0)).alias("before_signup"),
        *[F.coalesce(F.sum(f"n_{k}"), F.lit(0)).alias(k) for k in bad],
    )


def users_key_violations(users: DataFrame) -> DataFrame:
    """NULL ids plus rows that repeat an id."""
    return users.agg((F.count("*") - F.countDistinct("user_id")).alias("violations"))


def event_violations(users: DataFrame, events: DataFrame) -> DataFrame:
    session = F.col("session_duration")
    return _check_facts(
        users, events, "event_time", {"session_duration": session.isNull() | (session < 0)}
    )


def transaction_violations(users: DataFrame, transactions: DataFrame) -> DataFrame:
    amount, refund = F.col("amount"), F.col("refund_amount")
    return _check_facts(
        users,
        transactions,
        "order_time",
        {
            "amount": amount.isNull() | (amount <= 0),
            "refund": refund.isNull() | (refund < 0) | (refund > amount),
        },
    )


def quality_report(users: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """(rule, violations): eight rows, zero everywhere on valid data.

    Orphan rules count distinct unknown users, all other rules count rows.
    """
    pieces = [
        users_key_violations(users).select(
            F.array(_finding("users_key", "violations")).alias("findings")
        ),
        event_violations(users, events).select(
            F.array(
                _finding("orphan_events", "orphans"),
                _finding("event_before_signup", "before_signup"),
                _finding("session_duration", "session_duration"),
            ).alias("findings")
        ),
        transaction_violations(users, transactions).select(
            F.array(
                _finding("orphan_transactions", "orphans"),
                _finding("order_before_signup", "before_signup"),
                _finding("amount", "amount"),
                _finding("refund", "refund"),
            ).alias("findings")
        ),
    ]
    return reduce(DataFrame.unionByName, pieces).select(F.inline("findings"))


def _finding(rule: str, column: str):
    return F.struct(
        F.lit(rule).alias("rule"), F.col(column).cast("bigint").alias("violations")
    )


def validate(
    users: DataFrame, events: DataFrame, transactions: DataFrame, strict: bool = True
) -> DataFrame:
    """Row counts and status, ``valid`` or ``invalid``.

    Invalid data raises ``ValueError`` if ``strict``: a broken user key is
    reported alone, any other violations all together.
    """
    found = {r["rule"]: r["violations"] for r in quality_report(users, events, transactions).collect()}
    broken = [r for r in RULES if found[r]]
    if "users_key" in broken:
        broken = ["users_key"]
    if broken and strict:
        lines = [RULES[r].format(n=found[r]) for r in broken]
        raise ValueError("Data validation failed:\n- " + "\n- ".join(lines))
    status = "invalid" if broken else "valid"
    return row_counts(users, events, transactions).withColumn("status", F.lit(status))


def row_counts(users: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row with the number of rows of each table."""
    named = {"users": users, "events": events, "transactions": transactions}
    pieces = [t.agg(F.count("*").alias(n)).withColumn("_one", F.lit(1)) for n, t in named.items()]
    return reduce(lambda a, b: a.join(b, "_one"), pieces).drop("_one")


# Declared constraints --------------------------------------------------------


def check_key(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows beyond the first per key plus rows with a NULL in the key."""
    key = F.struct(*columns)
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    whole = F.when(~has_null, key)
    return df.agg(
        (F.count("*") - F.countDistinct(whole)).alias("violations")
    ).select(
        F.lit(table).alias("table_name"),
        F.lit("primary_key").alias("constraint_type"),
        F.lit(",".join(columns)).alias("columns"),
        "violations",
    )


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column, all counted in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit("not_null").alias("constraint_type"),
                        F.lit(c).alias("columns"),
                        F.col(c).alias("violations"),
                    )
                    for c in columns
                ]
            )
        )
    )


def check_foreign_key(df: DataFrame, table: str, column: str, parent: DataFrame) -> DataFrame:
    """Child rows without a parent; children are counted per key first."""
    per_key = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    lost = per_key.join(parent.select(column), column, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit("foreign_key").alias("constraint_type"),
        F.lit(column).alias("columns"),
        "violations",
    )


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Key, NOT NULL and foreign-key violations of every given table."""
    pieces = []
    for name, df in tables.items():
        pieces.append(check_key(df, name, schemas.PRIMARY_KEYS[name]))
        required = [c for c in schemas.NOT_NULL[name] if c in df.columns]
        if required:
            pieces.append(check_not_null(df, name, required))
        if name in schemas.FOREIGN_KEYS:
            column, parent = schemas.FOREIGN_KEYS[name]
            if parent in tables:
                pieces.append(check_foreign_key(df, name, column, tables[parent]))
    return reduce(DataFrame.unionByName, pieces)


def table_profile(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, duplicate keys and missing cells per table; one aggregate each."""
    pieces = []
    for name, (df, key) in tables.items():
        missing = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
        has_null_key = F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
        pieces.append(
            df.agg(
                F.count("*").alias("rows"),
                (F.count("*") - F.countDistinct(key) - has_null_key)
                .cast("bigint")
                .alias("duplicate_keys"),
                missing.alias("missing_cells"),
            ).select(F.lit(name).alias("table_name"), "rows", "duplicate_keys", "missing_cells")
        )
    return reduce(DataFrame.unionByName, pieces)


def require_key(df: DataFrame, table: str, columns: list[str]) -> None:
    """Raise if the key repeats or has a NULL."""
    broken = check_key(df, table, columns).first()["violations"]
    if broken:
        raise ValueError(f"{broken} rows of {table} break the key ({', '.join(columns)})")


def require_rows(tables: dict[str, DataFrame]) -> None:
    """Raise if any table is empty."""
    hollow = [name for name, df in tables.items() if df.isEmpty()]
    if hollow:
        raise ValueError(f"Empty tables: {', '.join(hollow)}")
