"""Clustered layouts, census steps, binned ranges, selected percentiles and stored distinct days."""

import datetime as dt
import random
import statistics
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from careledger.operators.census import daily_census
from careledger.operators.ranges import count_in_ranges
from careledger.operators.selection import exact_median, exact_percentile
from careledger.params import test_params as fixture_params
from careledger.plans import kpis
from careledger.sources.clustered import materialize_clustered, open_or_closed_after, within
from careledger.sources.distinct_days import DistinctDays
from tests.conftest import d, ts

P = fixture_params()


def _rows(df):
    return sorted(map(str, df.collect()))


def _files_read(df):
    """Files that the scans of a query opened, by the table's folder."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    out, todo = {}, [plan]
    while todo:
        node = todo.pop()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            root = node.relation().location().rootPaths().head().getName()
            out[root] = out.get(root, 0) + node.metrics().get("numFiles").get().value()
    return out


@pytest.fixture(scope="module")
def clustered(spark, fixture_catalog, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return materialize_clustered(fixture_catalog, str(tmp_path_factory.mktemp("clustered")))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,parts", [
    ("k04_billing_holds_sla", ["li_servicedate__month"]), ("k26_revenue_by_branch", ["li_servicedate__month"]),
    ("k15_lupa_by_threshold", ["cev_visitdate__month", "pp_endDate__month"]), ("k28_ar_aging", ["i_postdate__month"]),
    ("k29_ar_over_90", ["i_postdate__month"]), ("k06_discharges_total", ["epi_DischargeDate__month"]),
    ("k13_los_active", ["epi_DischargeDate__month"]), ("k18_patient_days", ["epi_DischargeDate__month"]),
    ("k21_recert_share_of_episodes", ["epi_DischargeDate__month"]), ("k05_daily_census", ["epi_DischargeDate__month"]),
    ("k09_hce_by_branch", ["epi_DischargeDate__month"]), ("k12_los_discharged", ["epi_DischargeDate__month"])])
def test_windows_prune_partitions(clustered, name, parts):
    plan = _plan(kpis.KPI_REPORTS[name](clustered, P))
    filters = [line for line in plan.splitlines() if "PartitionFilters: [" in line and "PartitionFilters: []" not in line]
    for part in parts:
        assert any(part in line.split("PartitionFilters: [")[1].split("],")[0] for line in filters), plan


def test_files_of_a_window(clustered):
    """A window of 15 days reads the files of its months, open stays the ones closed since."""
    all_files = {t: len(getattr(clustered, t).inputFiles()) for t in ("line_items", "episodes", "visits_all")}
    assert min(all_files.values()) > 60
    assert _files_read(within(clustered.line_items, "li_servicedate", P.start, P.end))["line_items"] <= 2
    assert _files_read(within(clustered.visits_all, "cev_visitdate", P.start, P.end))["visits_all"] <= 2
    read = _files_read(open_or_closed_after(clustered.episodes, "epi_DischargeDate", P.as_of))["episodes"]
    months = {r[0] for r in clustered.episodes.select("epi_DischargeDate__month").distinct().collect()}
    assert read == len([m for m in months if m is None or m >= P.as_of.replace(day=1)]) < all_files["episodes"]


@pytest.mark.parametrize("name", [n for n in sorted(kpis.KPI_REPORTS) if n[:3] in (
    "k04", "k05", "k06", "k07", "k09", "k12", "k13", "k14", "k15", "k18", "k21", "k27", "k28", "k29")])
def test_reports_on_the_clustered_layout(clustered, fixture_catalog, name):
    assert _rows(kpis.KPI_REPORTS[name](clustered, P)) == _rows(kpis.KPI_REPORTS[name](fixture_catalog, P))


def test_edges_of_clusters(spark, make_catalog, tmp_path):
    """Null dates, the last instant of a month, stays closed on the day itself."""
    eps = [(k, k, 1, "B01", "CURRENT", "NEW ADMISSION", None, ts("1998-01-01 00:00:00"), dc, None, None, None, None)
           for k, dc in enumerate([None, ts("1998-05-31 23:59:59"), ts("1998-06-01 00:00:00"), ts("1998-06-15 00:00:00"),
                                   ts("1998-06-30 23:59:59"), ts("1998-07-01 00:00:00")])]
    cat = make_catalog(episodes=eps)
    for unit in ("month", "day"):
        c = materialize_clustered(cat, str(tmp_path / unit), unit, ["episodes"])
        ids = lambda df: sorted(r.epi_id for r in df.collect())
        assert ids(within(c.episodes, "epi_DischargeDate", d("1998-06-01"), d("1998-06-30"))) == [2, 3, 4]
        assert ids(within(c.episodes, "epi_DischargeDate", None, d("1998-05-31"))) == [1]
        assert ids(open_or_closed_after(c.episodes, "epi_DischargeDate", d("1998-07-01"))) == [0, 5]
        assert within(c.episodes, "epi_DischargeDate", None, None).columns == cat.episodes.columns
        assert _rows(kpis.k13_los_active(c, P)) == _rows(kpis.k13_los_active(cat, P))
    assert within(cat.episodes, "epi_DischargeDate", P.start, P.end) is cat.episodes
    with pytest.raises(ValueError):
        materialize_clustered(cat, str(tmp_path), "year")


# ---------------------------------------------------------------- J7
def test_census_steps_over_ten_years(spark):
    """Overlapping, adjacent, nested and repeated stays of the same persons, against a count by day."""
    rng, start, end = random.Random(7), dt.date(1990, 1, 1), dt.date(1999, 12, 31)
    rows = []
    for _ in range(400):
        soc = dt.datetime(1989, 6, 1) + dt.timedelta(hours=rng.randrange(11 * 365 * 24))
        dc = None if rng.random() < 0.1 else soc + dt.timedelta(hours=rng.choice([0, 24, 600, 24 * 90, -30]))
        rows.append((rng.choice(["a", "b", None]), rng.choice([*range(15), None]), None if rng.random() < 0.02 else soc, dc))
    rows += [("hot", 1, dt.datetime(1995, 1, 1) + dt.timedelta(days=k % 50), None) for k in range(2000)]
    want = defaultdict(set)
    for key, person, soc, dc in rows:
        if soc is None or person is None:
            continue
        day = max(start, soc.date() if soc.time() == dt.time() else soc.date() + dt.timedelta(days=1))
        while day <= end and (dc is None or dc > dt.datetime.combine(day, dt.time())):
            want[day, key].add(person)
            day += dt.timedelta(days=1)
    df = spark.createDataFrame(rows, "k string, person int, epi_SocDate timestamp_ntz, epi_DischargeDate timestamp_ntz")
    got = daily_census(df, ["k"], "person", start, end)
    assert {(r.CensusDate, r.k): r.DailyCensus for r in got.collect()} == {x: len(s) for x, s in want.items()}


def _made(df):
    """Rows out of the operators of a query that make rows, by name."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            out.append((node.nodeName(), metric.get().value()))
    return out


def test_census_rows_follow_stays_and_not_days(spark):
    stays = spark.range(3000).select(
        (F.col("id") % 1000).alias("person"), F.lit("x").alias("k"),
        F.timestamp_add("DAY", F.col("id").cast("int") % 30, F.lit("1990-01-01").cast("timestamp_ntz")).alias("epi_SocDate"),
        F.lit(None).cast("timestamp_ntz").alias("epi_DischargeDate"))
    made = _made(daily_census(stays, ["k"], "person", dt.date(1990, 1, 1), dt.date(1999, 12, 31)))
    assert max(n for _, n in made) <= 6000


# ---------------------------------------------------------------- J8
def test_counts_in_ranges(spark):
    rng = random.Random(3)
    day = lambda n: dt.date(1998, 1, 1) + dt.timedelta(days=n)
    points = [(rng.choice([1, 2, 3, None]), day(rng.randrange(-40, 400)) if rng.random() < 0.95 else None) for _ in range(500)]
    points += [(9, day(rng.randrange(120))) for _ in range(20_000)]
    ranges = [(k, rng.choice([1, 2, 3, 4, 9, None]), day(a := rng.randrange(-50, 350)), day(a + rng.choice([-3, 0, 1, 29, 200])))
              for k in range(60)] + [(60, 9, None, day(3))]
    want = {k: n for k, key, a, b in ranges if key is not None and a is not None
            if (n := sum(p == key and x is not None and a <= x <= b for p, x in points))}
    p = spark.createDataFrame(points, "key int, day date")
    r = spark.createDataFrame(ranges, "id int, key int, first date, last date")
    for width in (1, 7, 32, 1000):
        assert {x.id: x.n for x in count_in_ranges(p, r, width).collect()} == want
    with pytest.raises(ValueError):
        count_in_ranges(p, r, 0)


def test_a_hot_episode_is_spread_over_its_bins(spark):
    points = spark.range(200_000).select((F.col("id") % 1).alias("key"), F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") % 3000).cast("int")).alias("day"))
    ranges = spark.range(3000).select("id", (F.col("id") % 1).alias("key"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("first"))
    ranges = ranges.withColumn("last", F.date_add("first", 29))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = count_in_ranges(points, ranges)
        plan = _plan(counts)
        assert "Join [key" in plan and "bin" in next(line for line in plan.splitlines() if "Join [key" in line)
        # Days meet the periods of their bin, not all periods of the episode (3,000 x 3,000).
        assert max(n for _, n in _made(counts)) <= 200_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


def test_lupa_periods_join_by_bin(spark, clustered):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(kpis.k15_lupa_by_threshold(clustered, P))
        assert any("Join [key" in line and "bin#" in line for line in plan.splitlines()), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- A19, W1
@pytest.mark.parametrize("ranges", [1, 3, 17])
def test_exact_median_of_a_hot_group(spark, ranges):
    rng = random.Random(5)
    rows = [("hot", Decimal(rng.randrange(10**9)) / 100) for _ in range(3001)]
    rows += [(f"g{k % 40}", Decimal(rng.randrange(50))) for k in range(400)] + [(None, Decimal(7)), (None, None), ("none", None)]
    rows += [("ties", Decimal(5))] * 30 + [("two", Decimal("1.01")), ("two", Decimal("1.02"))]
    df = spark.createDataFrame(rows, "g string, v decimal(18,2)").repartition(4)
    values = defaultdict(list)
    for g, v in rows:
        values[g] += [] if v is None else [v]
    want = {g: statistics.median(v) if v else None for g, v in values.items()}
    got = {r.g: r["percentile"] for r in exact_percentile(df, ["g"], "v", 0.5, ranges=ranges).collect()}
    assert got == want
    assert [r[0] for r in exact_median(df, [], "v").collect()] == [statistics.median([v for x in values.values() for v in x])]


def test_exact_percentiles_of_doubles(spark):
    rng = random.Random(6)
    rows = [(k % 3, rng.random()) for k in range(2000)]
    df = spark.createDataFrame(rows, "g int, v double")
    for share in (0.0, 0.1, 0.25, 0.9, 1.0):
        got = {r.g: r.p for r in exact_percentile(df, ["g"], "v", share, "p").collect()}
        want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", share).alias("p")).collect()}
        assert got == pytest.approx(want)
    assert exact_median(df.limit(0), ["g"], "v").collect() == []
    with pytest.raises(ValueError):
        exact_percentile(df, ["g"], "v", 1.5)


def test_selection_keeps_no_value_list(spark):
    """No aggregate whose buffer grows with a group; windows run inside (group, range) or over one row a range."""
    df = spark.range(1000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    plan = exact_median(df, ["g"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower() and "collect" not in plan.lower()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("range" in line or "rows#" in line for line in windows)


# ---------------------------------------------------------------- A3, A4
def test_stored_distinct_days(spark, tmp_path):
    rng = random.Random(8)
    schema = "k string, person long"
    days = {dt.date(1998, 6, n): [(rng.choice(["a", "b", None]), rng.choice([None, -5, 7, 2**40, 40_000, *range(30)])) for _ in range(80)]
            for n in range(1, 6)}
    days[dt.date(1998, 6, 6)] = []
    store = DistinctDays(spark, str(tmp_path / "sets"), ("k",))
    assert store.days() == set()
    for day, rows in days.items():
        store.add(spark.createDataFrame([("gone", 1)], schema), day, "person")      # replaced by the next line
        store.add(spark.createDataFrame(rows, schema), day, "person")
    assert store.days() == set(days)
    start, end = dt.date(1998, 6, 2), dt.date(1998, 6, 6)
    by_day, over = defaultdict(set), defaultdict(set)
    for day, rows in days.items():
        for k, person in rows:
            if person is not None and start <= day <= end:
                by_day[day, k].add(person)
                over[k].add(person)
    assert {(r.day, r.k): r.n for r in store.by_day(start, end).collect()} == {k: len(v) for k, v in by_day.items()}
    assert {r.k: r.n for r in store.over(start, end).collect()} == {k: len(v) for k, v in over.items()}


def test_a_recurring_census_adds_its_new_days(spark, fixture_catalog, tmp_path, monkeypatch):
    store = DistinctDays(spark, str(tmp_path / "sets"), ("sl_desc", "branch_name"))
    added = []
    add = DistinctDays.add
    monkeypatch.setattr(DistinctDays, "add", lambda self, rows, day, person: (added.append(day), add(self, rows, day, person)))
    for as_of in (P.as_of - dt.timedelta(days=1), P.as_of):
        p = type(P).build(as_of=as_of)
        added.clear()
        got = kpis.stored_daily_census(fixture_catalog, p, store)
        columns = ["CensusDate", "sl_desc", "branch_name", "DailyCensus"]
        assert _rows(got.select(columns)) == _rows(kpis.k05_daily_census(fixture_catalog, p).select(columns))
    assert added == [P.as_of]
