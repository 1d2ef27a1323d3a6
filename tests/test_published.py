import pytest
from pyspark.sql import functions as F

from valuetide.sources import published, schemas, sinks


def _frames(sample):
    return dict(zip(("users", "events", "transactions"), sample))


def _counts(found):
    return {t: found[t].count() for t in schemas.TABLES}


def _catalog(spark, database):
    return _counts({t: spark.table(f"{database}.{t}") for t in schemas.TABLES})


OLD = {"users": 2, "events": 4, "transactions": 1, "user_snapshots": 0, "customer_predictions": 0}
NEW = {"users": 1, "events": 0, "transactions": 0, "user_snapshots": 0, "customer_predictions": 0}


def test_failure_while_staging_leaves_the_old_tables(spark, sample):
    run = sinks.refresh_tables(spark, "staged_db", _frames(sample))
    bad = sample[1].withColumn("session_duration", F.raise_error(F.lit("source broke off")).cast("double"))
    with pytest.raises(Exception, match="source broke off"):
        sinks.refresh_tables(spark, "staged_db", {"users": sample[0].limit(1), "events": bad})
    assert _catalog(spark, "staged_db") == OLD == _counts(published.tables(spark, "staged_db"))
    left = published.sweep(spark, "staged_db")
    assert len(left) == 1 and run not in left
    assert _catalog(spark, "staged_db") == OLD


def test_failure_among_the_locations_is_rolled_forward(spark, sample, monkeypatch):
    sinks.refresh_tables(spark, "moved_db", _frames(sample))
    run = published.stage(spark, "moved_db", {"users": sample[0].limit(1)})
    published.switch(spark, "moved_db", run)
    refreshed = type(spark.catalog).refreshTable

    def broken(catalog, name):
        if name.endswith(".events"):
            raise RuntimeError("driver lost")
        refreshed(catalog, name)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark.catalog), "refreshTable", broken)
        with pytest.raises(RuntimeError, match="driver lost"):
            published.recover(spark, "moved_db")
    # One run's tables even now; the locations follow when someone comes by.
    assert _counts(published.tables(spark, "moved_db")) == NEW
    assert published.recover(spark, "moved_db") and not published.recover(spark, "moved_db")
    assert _catalog(spark, "moved_db") == NEW


def test_the_run_before_stays_readable_and_older_ones_go(spark, sample):
    first = sinks.refresh_tables(spark, "kept_db", _frames(sample))
    under_way = published.tables(spark, "kept_db")
    second = sinks.refresh_tables(spark, "kept_db", {"users": sample[0].limit(1)})
    assert _counts(under_way) == OLD and _catalog(spark, "kept_db") == NEW
    third = sinks.refresh_tables(spark, "kept_db", {"users": spark.table("kept_db.users")})
    assert _catalog(spark, "kept_db") == NEW
    assert len({first, second, third}) == 3
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        _counts(under_way)


def test_nothing_published_is_an_error_and_types_hold(spark, sample):
    published.create_tables(spark, "bare_db")
    assert not published.recover(spark, "bare_db") and published.sweep(spark, "bare_db") == []
    with pytest.raises(ValueError, match="nothing has been published"):
        published.tables(spark, "bare_db")
    sinks.refresh_tables(spark, "bare_db", {"users": sample[0].withColumn("extra", F.lit(1))})
    for table, df in published.tables(spark, "bare_db").items():
        kinds = [f.dataType for f in schemas.struct(table)]
        assert [f.dataType for f in df.schema] == kinds == [f.dataType for f in spark.table(f"bare_db.{table}").schema]
    assert spark.table("bare_db.users").where("region IS NULL").count() == 2
