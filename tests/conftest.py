import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

from basketlake.schemas import RAW


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


RAW_ROWS = [
    # invoice, code, description, quantity, at, price, customer, country
    ("536365", "85123A", "WHITE HEART", 6, day("2010-12-01T08:26"), Decimal("2.55"), "17850", "United Kingdom"),
    ("536365", "71053", " ", 2, day("2010-12-01T08:26"), Decimal("3.39"), "17850.0", "United Kingdom"),
    ("536366", "85123A", "WHITE HEART", 1, day("2010-12-01T09:00"), Decimal("2.55"), "", "France"),
    ("C536379", "85123A", "WHITE HEART", -2, day("2010-12-02T09:41"), Decimal("2.55"), "17850", "United Kingdom"),
    ("536380", "71053", None, -1, day("2010-12-02T10:00"), Decimal("3.39"), "13047", " "),
    ("536381", "85123A", "HEART, WHITE", 4, day("2010-12-03T10:00"), Decimal("2.65"), "13047", "France"),
    ("536381", "85123A", "HEART, WHITE", 4, day("2010-12-03T10:00"), Decimal("2.65"), "13047", "France"),
    # rejected
    (None, "71053", "x", 1, day("2010-12-01T08:26"), Decimal("1.00"), "1", "France"),
    ("536382", None, "x", 1, day("2010-12-01T08:26"), Decimal("1.00"), "1", "France"),
    ("536383", "71053", "x", 1, None, Decimal("1.00"), "1", "France"),
    ("536384", "71053", "x", 1, day("2010-12-01T08:26"), Decimal("0.00"), "1", "France"),
    ("536385", "71053", "x", 1, day("2010-12-01T08:26"), Decimal("-1.00"), "1", "France"),
    ("536386", "71053", "x", 1, day("2010-12-01T08:26"), None, "1", "France"),
    ("536387", "71053", "x", 0, day("2010-12-01T08:26"), Decimal("1.00"), "1", "France"),
    ("536388", "71053", "x", None, day("2010-12-01T08:26"), Decimal("1.00"), "1", "France"),
    ("536389", "71053", "x", 1, day("2010-12-01T08:26"), Decimal("1.00"), "abc", "France"),
]


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, RAW)


def rows(df):
    return [tuple(r) for r in df.collect()]
