"""Snapshots from a stored state of user-days that new facts are merged into.

Below one folder lie

* ``days/<batch>``: the user-days of one batch of facts, by month;
* ``batches``: one row for each batch that is whole, written after its days;
* ``base/<n>``: the days of many batches as one, by month, and each user's
  totals before a cut, the first day of a month;
* ``bases``: one row for each base that is whole: its batches and its cut;
* ``snapshots``, ``marks``: the snapshots of each date, and by which batches
  and users they were made.

A new date reads the totals at the cut, the days from the cut to the end of its
labels and the days of batches behind the base, never the facts.  All columns of
a day are sums or maxima, so the order of batches and late facts do not matter.
What a crash leaves half written has no row in ``batches``, ``bases`` or
``marks`` and is written again.  One writer at a time is assumed.

Only rows of batches, bases and dates come to the driver.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import snapshots
from .stages import content

BATCH = "batch string, first_day date, last_day date"
BASE = "number int, batches array<string>, cut date"
MARK = "snapshot_date date, key string, written timestamp_ntz"
# The longest trailing frame of a snapshot.
LOOKBACK_DAYS = 90


class DayState:
    """User-days below ``folder`` and the snapshots made of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # Small tables -----------------------------------------------------------------

    def _rows(self, name: str) -> list:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return []
        ddl = {"batches": BATCH, "bases": BASE, "marks": MARK}[name]
        return self.spark.read.schema(ddl).parquet(f"{self.folder}/{name}").collect()

    def _note(self, name: str, rows: list[tuple]) -> None:
        ddl = {"batches": BATCH, "bases": BASE, "marks": MARK}[name]
        self.spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def batches(self) -> dict[str, tuple[dt.date | None, dt.date | None]]:
        """First and last day of every batch that is whole; None for one without facts."""
        return {r["batch"]: (r["first_day"], r["last_day"]) for r in self._rows("batches")}

    def base(self) -> tuple[int, list[str], dt.date] | None:
        """Number, batches and cut of the newest base."""
        return max(((r["number"], r["batches"], r["cut"]) for r in self._rows("bases")), default=None)

    # Days -------------------------------------------------------------------------

    def add(self, batch: str, events: DataFrame, transactions: DataFrame) -> bool:
        """Store the user-days of a batch of facts; False if the batch is already there.

        The name stands for the content: a batch of a known name is not read,
        so a run that broke off can simply add all of its batches again.
        """
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError(f"a batch is named by letters, digits and dashes, not {batch!r}")
        if batch in self.batches():
            return False
        path = f"{self.folder}/days/{batch}"
        self._write_days(snapshots.daily_rollup(events, transactions), path)
        span = self._days(path).agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
        self._note("batches", [(batch, span["first"], span["last"])])
        return True

    def _write_days(self, days: DataFrame, path: str) -> None:
        # AQE cuts a large month into several files; a small one is written by one task.
        dealt = days.withColumn("month", F.trunc("date", "month")).hint("rebalance", F.col("month"))
        dealt.write.mode("overwrite").partitionBy("month").parquet(path)

    def _days(self, path: str, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Day rows in ``[since, before)``; months outside are not listed as input."""
        days = self.spark.read.schema(self._schema()).parquet(path)
        if since:
            days = days.where((F.col("month") >= F.lit(since.replace(day=1))) & (F.col("date") >= F.lit(since)))
        if before:
            days = days.where((F.col("month") <= F.lit(before.replace(day=1))) & (F.col("date") < F.lit(before)))
        return days.drop("month")

    @staticmethod
    def _schema() -> str:
        kinds = {"active": "int", "seen_at": "timestamp_ntz", "bought_at": "timestamp_ntz"}
        columns = [f"{c} {kinds.get(c, 'bigint')}" for c in (*snapshots.LARGEST, *snapshots.SUMMED)]
        return ", ".join(["user_id bigint", "date date", *columns, "month date"])

    def days(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """One row per user and day of all facts in ``[since, before)``.

        With ``since`` at the base's cut, earlier days of the base come as one
        row of totals a user, the day before the cut, and days of later batches
        as they are.
        """
        base, parts = self.base(), []
        folded: list[str] = []
        if base:
            number, folded, cut = base
            from_cut = since is not None and since >= cut
            parts.append(self._days(f"{self.folder}/base/{number}/days", cut if from_cut else None, before))
            if from_cut:
                totals = self.spark.read.parquet(f"{self.folder}/base/{number}/totals")
                parts.append(totals.withColumn("date", F.lit(cut - dt.timedelta(days=1))))
        for batch, (first, _) in sorted(self.batches().items()):
            if batch not in folded and first and (before is None or first < before):
                parts.append(self._days(f"{self.folder}/days/{batch}", None, before))
        if not parts:
            return self.spark.createDataFrame([], self._schema()).drop("month")
        # Dealt by user alone: the windows behind it need no further exchange.
        return self._merged(reduce(DataFrame.unionByName, parts))

    @staticmethod
    def _merged(days: DataFrame) -> DataFrame:
        return days.repartition("user_id").groupBy("user_id", "date").agg(*snapshots.merged_days())

    def compact(self, cut: dt.date | None = None) -> int | None:
        """Write all batches as one base with the users' totals before ``cut``.

        Without ``cut`` it is the last first of a month from which a snapshot
        of the newest day can be made.  The new base counts from its row in
        ``bases`` on; until then the earlier one is read.
        """
        known, base = self.batches(), self.base()
        spans = [last for _, last in known.values() if last]
        if not spans:
            return None
        cut = (cut or max(spans) - dt.timedelta(days=LOOKBACK_DAYS)).replace(day=1)
        number = base[0] + 1 if base else 1
        path = f"{self.folder}/base/{number}"
        self._write_days(self.days(), f"{path}/days")
        # Totals enter lifetime features only: what trailing frames count stays out.
        totals = self._days(f"{path}/days", before=cut).groupBy("user_id").agg(*snapshots.merged_days())
        empty = {c: F.lit(None).cast(totals.schema[c].dataType) for c in ("active", *snapshots.COUNTED_EVENTS)}
        totals.withColumns(empty).write.mode("overwrite").parquet(f"{path}/totals")
        self._note("bases", [(number, sorted(known), cut)])
        return number

    # Snapshots --------------------------------------------------------------------

    def snapshots_at(self, users: DataFrame, snapshot_dates) -> DataFrame:
        """Snapshots of the dates from the state, equal to those from all facts."""
        dates = snapshots.as_dates(snapshot_dates)
        base = self.base()
        reach = dates[0] - dt.timedelta(days=LOOKBACK_DAYS)
        since = base[2] if base and base[2] <= reach else None
        return snapshots.snapshots_of_days(users, self.days(since, snapshots.horizon_of(dates)), dates)

    def refresh(self, users: DataFrame, snapshot_dates) -> list[dt.date]:
        """Make the stored snapshots of the dates current; returns the dates made anew.

        A date is made anew if it is not stored, if a batch that it was made
        without has a day before the end of its labels, or if the users' ids or
        signup days have changed.  All such dates come from one pass.
        """
        dates = snapshots.as_dates(snapshot_dates)
        people = content(users.select("user_id", F.to_date("signup_date").alias("signup_date")))
        known = self.batches()
        wanted = {}
        for date in dates:
            end = snapshots.horizon_of([date])
            bearing = sorted(b for b, (first, _) in known.items() if first and first < end)
            wanted[date] = hashlib.sha256(json.dumps([bearing, people]).encode()).hexdigest()
        marks = {r["snapshot_date"]: r["key"] for r in sorted(self._rows("marks"), key=lambda r: r["written"])}
        stale = [d for d in dates if marks.get(d) != wanted[d]]
        if stale:
            rows = self.snapshots_at(users, stale)
            # Each date's folder is replaced as a whole once all of them are written.
            rows.hint("rebalance", F.col("snapshot_date")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("snapshot_date").parquet(f"{self.folder}/snapshots")
            first = users.agg(F.min(F.to_date("signup_date"))).first()[0]
            for date in stale:
                if first is None or first >= date:
                    self._drop(f"snapshots/snapshot_date={date}")
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            self._note("marks", [(d, wanted[d], now) for d in stale])
        return stale

    def _drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def stored(self, users: DataFrame) -> DataFrame:
        """All stored snapshots; ``users`` gives their columns and types."""
        schema = self.snapshots_at(users, [dt.date(1970, 1, 1)]).schema
        ordered = [f.name for f in schema.fields]
        return self.spark.read.schema(schema).parquet(f"{self.folder}/snapshots").select(*ordered)
