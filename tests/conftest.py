import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from valuetide.session import build_session  # noqa: E402
from valuetide.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "checkpoint"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


USERS = "user_id long, signup_date date, channel string, device string"
EVENTS = (
    "event_id long, user_id long, event_time timestamp_ntz, event_type string, "
    "session_duration double"
)
ORDERS = schemas.TRANSACTIONS


@pytest.fixture
def sample(spark):
    """Two users, four events, one order with a refund."""
    from decimal import Decimal

    users = frame(
        spark,
        [(1, day("2024-01-01"), "organic", "Web"), (2, day("2024-01-02"), "search", "iOS")],
        USERS,
    )
    events = frame(
        spark,
        [
            (1, 1, ts("2024-01-01"), "login", 10.0),
            (2, 1, ts("2024-01-08"), "browse", 20.0),
            (3, 2, ts("2024-01-03"), "login", 5.0),
            (4, 1, ts("2024-02-01"), "purchase", 30.0),
        ],
        EVENTS,
    )
    orders = frame(
        spark,
        [(1, 1, ts("2024-02-01"), Decimal("100.00"), Decimal("10.00"), "Home")],
        ORDERS,
    )
    return users, events, orders
