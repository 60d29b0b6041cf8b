import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.functions import dates as D

d = dt.date


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("1/10/21", d(2021, 1, 10)), ("1/10/2021", d(2021, 1, 10)), ("01/10/21", d(2021, 1, 10)),
    ("1/10/75", d(1975, 1, 10)), ("1/10/68", d(2068, 1, 10)), (" 1/10/2021", d(2021, 1, 10)),
    ("1/10/2/021", d(2021, 1, 10)), ("unknown", None), (None, None)])
def test_poll_date_layouts(spark, raw, expected):
    assert one(spark, D.parse_poll_date, raw) == expected


def test_poll_date_literal_no_repair(spark):
    assert one(spark, lambda c: D.parse_poll_date(c, repair=False), "1/10/2/021") is None


@pytest.mark.parametrize("day,expected", [(d(2025, 1, 25), d(2025, 1, 19)), (d(2025, 1, 26), d(2025, 1, 26))])
def test_sunday_week(spark, day, expected):
    assert one(spark, D.sunday_week, day, "date") == expected


def test_month_parse(spark):
    df = spark.createDataFrame([("1", "2020"), (None, "2020")], "m string, y string")
    got = [r[0] for r in df.select(D.parse_month_year("m", "y")).collect()]
    assert got == [d(2020, 1, 1), None]
    bad = spark.createDataFrame([("13", "2020")], "m string, y string")
    with pytest.raises(Exception):
        bad.select(D.parse_month_year("m", "y")).collect()


@pytest.mark.parametrize("day,expected", [(d(2025, 1, 22), d(2025, 1, 17)), (d(2025, 1, 24), d(2025, 1, 24))])
def test_most_recent_friday(spark, day, expected):
    assert one(spark, D.most_recent_friday, day, "date") == expected
