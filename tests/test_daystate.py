import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import EVENTS, ORDERS, USERS, day, frame
from tests.test_snapshots_splits import MONTHS, _random_tables
from valuetide.operators import snapshots
from valuetide.plans.daystate import DayState

CUTS = [day("2024-05-01"), day("2024-09-15")]


@pytest.fixture
def facts(spark):
    """Users, the rows of events and of orders; the first user has a third of them."""
    u, e, t = _random_tables(spark, seed=11)
    return frame(spark, u, USERS), e, t


def _batch(spark, e, t, since=None, before=None):
    keep = lambda x: (not since or x[2].date() >= since) and (not before or x[2].date() < before)
    return frame(spark, [x for x in e if keep(x)], EVENTS), frame(spark, [x for x in t if keep(x)], ORDERS)


def _values(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def _rebuilt(spark, users, e, t, dates=MONTHS):
    return snapshots.build_snapshots(users, frame(spark, e, EVENTS), frame(spark, t, ORDERS), dates)


@pytest.mark.parametrize(("order", "base_after"), [((0, 1, 2), None), ((2, 0, 1), 1), ((2, 1, 0), 3)])
def test_state_equals_full_rebuild(spark, facts, tmp_path, order, base_after):
    users, e, t = facts
    edges = [None, *CUTS, None]
    state = DayState(spark, str(tmp_path / "state"))
    for n, k in enumerate(order, 1):
        assert state.add(f"b{k}", *_batch(spark, e, t, edges[k], edges[k + 1]))
        if n == base_after:
            state.compact(day("2024-04-01"))
    state.refresh(users, MONTHS)
    want = _rebuilt(spark, users, e, t)
    assert _values(state.stored(users)) == _values(want)
    assert dict(state.stored(users).dtypes) == dict(want.dtypes)


def test_facts_of_one_day_in_two_batches_are_one_active_day(spark, facts, tmp_path):
    users, e, t = facts
    state = DayState(spark, str(tmp_path / "state"))
    state.add("even", frame(spark, e[::2], EVENTS), frame(spark, t[::2], ORDERS))
    state.compact()
    state.add("odd", frame(spark, e[1::2], EVENTS), frame(spark, t[1::2], ORDERS))
    assert _values(state.snapshots_at(users, MONTHS)) == _values(_rebuilt(spark, users, e, t))


def test_only_dates_that_a_batch_bears_on_are_made_anew(spark, facts, tmp_path):
    users, e, t = facts
    state = DayState(spark, str(tmp_path / "state"))
    state.add("old", *_batch(spark, e, t, before=day("2025-01-15")))
    assert state.refresh(users, MONTHS[:-1]) == MONTHS[:-1]
    assert state.refresh(users, MONTHS[:-1]) == []
    # A date is appended: it alone is made.
    assert state.refresh(users, MONTHS) == MONTHS[-1:]
    assert state.add("new", *_batch(spark, e, t, since=day("2025-01-15")))
    # Labels that were whole before the first new day stay.
    assert state.refresh(users, MONTHS) == [d for d in MONTHS if d + dt.timedelta(days=90) > day("2025-01-15")]
    assert _values(state.stored(users)) == _values(_rebuilt(spark, users, e, t))
    # A known batch is not counted twice.
    assert not state.add("new", *_batch(spark, e, t, since=day("2025-01-15")))
    assert state.refresh(users, MONTHS) == []


def test_changed_users_make_every_date_anew(spark, facts, tmp_path):
    users, e, t = facts
    state = DayState(spark, str(tmp_path / "state"))
    state.add("all", *_batch(spark, e, t))
    state.refresh(users, MONTHS)
    late = users.withColumn("signup_date", F.lit(day("2024-08-15")))
    assert state.refresh(late, MONTHS) == MONTHS
    # July and August have no users now; their rows are gone.
    assert _values(state.stored(late)) == _values(_rebuilt(spark, late, e, t))


def test_a_new_date_reads_neither_facts_nor_old_days(spark, facts, tmp_path):
    users, e, t = facts
    state = DayState(spark, str(tmp_path / "state"))
    state.add("all", *_batch(spark, e, t))
    state.compact(day("2024-11-01"))
    made = state.snapshots_at(users, MONTHS[-1:])
    days = [f for f in made.inputFiles() if "/days/" in f]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "days/all" not in "".join(days)
    assert plan.count("Exchange hashpartitioning(user_id") <= 3 and plan.count("Window [") == 1
    # Without the months before the cut the answer is the same.
    for old in (tmp_path / "state/base/1/days").glob("month=2024-0*"):
        for file in old.iterdir():
            file.write_bytes(b"")
    assert _values(made) == _values(_rebuilt(spark, users, e, t, MONTHS[-1:]))


def test_half_written_batch_and_base_do_not_count(spark, facts, tmp_path, monkeypatch):
    users, e, t = facts
    state = DayState(spark, str(tmp_path / "state"))
    state.add("b1", *_batch(spark, e, t, before=CUTS[1]))

    def lost(*_):
        raise RuntimeError("driver lost")

    rest = _batch(spark, e, t, since=CUTS[1])
    with monkeypatch.context() as broken:
        broken.setattr(DayState, "_note", lost)
        with pytest.raises(RuntimeError):
            state.add("b2", *rest)
        with pytest.raises(RuntimeError):
            state.compact()
    assert list(state.batches()) == ["b1"] and state.base() is None
    state = DayState(spark, str(tmp_path / "state"))
    state.add("b2", *rest)
    state.compact()
    assert _values(state.snapshots_at(users, MONTHS)) == _values(_rebuilt(spark, users, e, t))


def test_empty_batches_nulls_and_bad_names(spark, facts, tmp_path):
    users, e, t = facts
    state = DayState(spark, str(tmp_path / "state"))
    assert state.compact() is None
    assert state.snapshots_at(users, MONTHS).count() == _rebuilt(spark, users, [], []).count()
    state.add("none", frame(spark, [], EVENTS), frame(spark, [], ORDERS))
    untimed = [(9001, 0, None, "login", 1.0), (9002, None, None, None, None)]
    state.add("all", frame(spark, e + untimed, EVENTS), frame(spark, t, ORDERS))
    assert state.batches()["none"] == (None, None)
    assert _values(state.snapshots_at(users, MONTHS)) == _values(_rebuilt(spark, users, e, t))
    with pytest.raises(ValueError, match="named by"):
        state.add("a/b", frame(spark, [], EVENTS), frame(spark, [], ORDERS))
