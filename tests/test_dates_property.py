"""parse_poll_date against Python's strptime on random dates and layouts (one Spark job)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from panelkit.functions.dates import parse_poll_date


def expected(s: str):
    t = s.strip()
    for fmt in ("%m/%d/%y", "%m/%d/%Y"):
        try:
            return dt.datetime.strptime(t, fmt).date()
        except ValueError:
            pass
    parts = t.split("/")
    if len(parts) == 4:  # M/d/y/yyy -> M/d/yyyy
        try:
            return dt.datetime.strptime("/".join(parts[:2]) + "/" + parts[2] + parts[3], "%m/%d/%Y").date()
        except ValueError:
            return None
    return None


def render(d: dt.date, layout: int) -> str:
    y = str(d.year)
    if layout == 0:
        return f"{d.month}/{d.day}/{y[2:]}"
    if layout == 1:
        return f"{d.month:02d}/{d.day:02d}/{y[2:]}"
    if layout == 2:
        return f"{d.month}/{d.day}/{y}"
    if layout == 3:
        return f"{d.month}/{d.day}/{y[0]}/{y[1:]}"
    return f" {d.month}/{d.day}/{y} "


samples = st.lists(st.tuples(st.dates(min_value=dt.date(1000, 1, 1), max_value=dt.date(2099, 12, 31)),
                             st.integers(min_value=0, max_value=4)), min_size=50, max_size=200)


@settings(max_examples=5, deadline=None)
@given(samples)
def test_parse_poll_date_matches_strptime(spark, rows):
    texts = [render(d, k) for d, k in rows] + ["unknown", "13/40/21", "1/10/2/0/21", ""]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_poll_date("s")).collect()]
    assert got == [expected(t) for t in texts]
