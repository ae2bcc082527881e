"""Property checks of the date helpers against their plain definitions, on
generated timestamps clustered around the window edges (one Spark job per
property: all examples are evaluated in one DataFrame)."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from careledger.functions.columns import days_between, hour_boundaries
from careledger.functions.predicates import (
    active_on, in_window_by_date, in_window_half_open, in_window_raw, overlaps_window,
)

START, END = dt.date(1998, 6, 1), dt.date(1998, 6, 15)
EDGES = [dt.datetime.combine(d, dt.time()) for d in (START, END, END + dt.timedelta(days=1))]

stamps = st.one_of(
    st.sampled_from(EDGES).flatmap(lambda e: st.integers(-3600 * 30, 3600 * 30).map(
        lambda s: e + dt.timedelta(seconds=s))),
    st.datetimes(min_value=dt.datetime(1998, 5, 1), max_value=dt.datetime(1998, 7, 1)),
)


def _midnight(d):
    return dt.datetime.combine(d, dt.time())


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(stamps, stamps), min_size=200, max_size=200))
def test_hour_and_day_boundaries(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", hour_boundaries("a", "b").alias("h"), days_between("a", "b").alias("d")).collect()
    for r in got:
        ha, hb = r["a"].replace(minute=0, second=0, microsecond=0), r["b"].replace(minute=0, second=0, microsecond=0)
        assert r["h"] == int((hb - ha).total_seconds() // 3600)
        assert r["d"] == (r["b"].date() - r["a"].date()).days


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(stamps, st.one_of(st.none(), stamps)), min_size=300, max_size=300))
def test_window_predicates(spark, rows):
    df = spark.createDataFrame(rows, "x timestamp_ntz, y timestamp_ntz")
    x, y = F.col("x"), F.col("y")
    got = df.select("x", "y",
                    in_window_by_date(x, START, END).alias("p7"), in_window_raw(x, START, END).alias("p8"),
                    in_window_half_open(x, START, END).alias("p9"),
                    active_on(x, y, END).alias("p10"), overlaps_window(x, y, START, END).alias("p11")).collect()
    s, e, e1 = _midnight(START), _midnight(END), _midnight(END + dt.timedelta(days=1))
    for r in got:
        xv, yv = r["x"], r["y"]
        assert r["p7"] == (START <= xv.date() <= END)
        assert r["p8"] == (s <= xv <= e)
        assert r["p9"] == (s <= xv < e1)
        assert r["p10"] == (xv <= e and (yv is None or yv > e))
        assert r["p11"] == (xv <= e and (yv is None or yv > s))
