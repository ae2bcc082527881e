"""Hand-made edge frames, one per trap of the blueprint (window edges,
midnights, hour boundaries, NULL buckets, fan-out, blanks, empty inputs,
ratio ties, wildcard maps, result stacking)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from careledger.functions.columns import hour_boundaries, ratio_pct
from careledger.functions.predicates import (
    active_on, in_window_by_date, in_window_half_open, in_window_raw,
)
from careledger.operators.census import daily_census, daily_census_rows, date_spine
from careledger.params import RunParams
from careledger.plans import kpis
from careledger.reports import placeholder_if_empty, stack_results
from tests.conftest import d, ts

P = RunParams.build(as_of=dt.date(1998, 6, 15))      # window 1998-06-01 .. 1998-06-15


def _episode(epi_id, soc, dc=None, status="CURRENT", slid=1, code="B01", nonadmit=None, referral=None,
             admit="NEW ADMISSION", recert=None, dc_code=None, nonadmit_code=None, paid=None):
    return (epi_id, paid if paid is not None else epi_id, slid, code, status, admit,
            ts(referral) if referral else None, ts(soc), ts(dc) if dc else None,
            ts(nonadmit) if nonadmit else None, nonadmit_code, recert, dc_code)


def _dim_rows():
    return [("HOME HEALTH", 1, "B01", "BRANCH ONE"), ("HOSPICE", 2, "B05", "BRANCH FIVE")]


def test_window_predicates_edges(spark):
    xs = ["1998-06-01 00:00:00", "1998-05-31 23:59:59", "1998-06-15 00:00:00", "1998-06-15 00:01:00",
          "1998-06-16 00:00:00"]
    df = spark.createDataFrame([(ts(x),) for x in xs], "x timestamp_ntz")
    x = F.col("x")

    def hits(cond):
        return sorted(str(r[0]) for r in df.filter(cond).collect())
    assert hits(in_window_by_date(x, P.start, P.end)) == [
        "1998-06-01 00:00:00", "1998-06-15 00:00:00", "1998-06-15 00:01:00"]
    assert hits(in_window_raw(x, P.start, P.end)) == ["1998-06-01 00:00:00", "1998-06-15 00:00:00"]
    assert hits(in_window_half_open(x, P.start, P.end)) == [
        "1998-06-01 00:00:00", "1998-06-15 00:00:00", "1998-06-15 00:01:00"]


def test_active_on_midnight_edges(spark):
    rows = [(1, ts("1998-06-10 00:00:00"), None), (2, ts("1998-06-10 00:01:00"), None),
            (3, ts("1998-06-01 00:00:00"), ts("1998-06-10 00:00:00")),
            (4, ts("1998-06-01 00:00:00"), ts("1998-06-10 00:01:00"))]
    df = spark.createDataFrame(rows, "id int, soc timestamp_ntz, dc timestamp_ntz")
    act = [r[0] for r in df.filter(active_on(F.col("soc"), F.col("dc"), d("1998-06-10"))).orderBy("id").collect()]
    assert act == [1, 4]


def test_census_expansion_equals_nested_loop(spark, make_catalog, fixture_catalog):
    eps = [_episode(1, "1998-06-10 00:00:00"), _episode(2, "1998-06-10 00:01:00"),
           _episode(3, "1998-05-01 00:00:00", "1998-06-10 00:00:00"),
           _episode(4, "1998-05-01 00:00:00", "1998-06-10 00:01:00"),
           _episode(5, "1998-06-15 00:00:00"), _episode(6, "1998-06-15 10:00:00"),
           _episode(7, "1998-06-20 00:00:00"), _episode(8, "1998-04-01 00:00:00", "1998-06-01 00:00:00")]
    cat = make_catalog(episodes=eps)
    for e in (cat.episodes, fixture_catalog.episodes):
        a = daily_census_rows(e, P.start, P.end).select("CensusDate", "epi_id")
        spine = F.broadcast(date_spine(spark, P.start, P.end))
        b = spine.join(e, active_on(F.col("epi_SocDate"), F.col("epi_DischargeDate"), F.col("CensusDate"))).select("CensusDate", "epi_id")
        assert sorted(a.collect()) == sorted(b.collect())
        counted = b.join(e, "epi_id").groupBy("CensusDate", "epi_slid").agg(F.countDistinct("epi_paid").alias("n"))
        steps = daily_census(e, ["epi_slid"], "epi_paid", P.start, P.end)
        assert sorted(map(tuple, steps.collect())) == sorted(map(tuple, counted.collect()))


def test_hour_boundaries_not_elapsed(spark):
    pairs = [("1998-06-01 00:59:00", "1998-06-01 01:01:00", 1),
             ("1998-06-01 00:00:00", "1998-06-03 00:00:00", 48),
             ("1998-06-01 00:59:00", "1998-06-03 00:01:00", 48),      # 47h02m elapsed
             ("1998-06-01 05:00:00", "1998-06-01 03:30:00", -2)]
    df = spark.createDataFrame([(ts(a), ts(b), n) for a, b, n in pairs], "a timestamp_ntz, b timestamp_ntz, n int")
    for r in df.select(hour_boundaries("a", "b").alias("h"), "n").collect():
        assert r["h"] == r["n"]


def test_bp1_status_on_hour_boundaries(make_catalog):
    eps = [_episode(1, "1998-06-02 00:59:00"), _episode(2, "1998-06-02 00:00:00"), _episode(3, "1998-06-03 00:00:00")]
    visits = [(10, 1, ts("1998-06-04 00:01:00"), 0, 1, "Y"),    # 48 boundaries -> Compliant
              (20, 2, ts("1998-06-04 01:00:00"), 0, 1, "Y"),    # 49 -> Late
              (30, 3, ts("1998-06-03 05:00:00"), 0, 1, "N")]    # not a SOC visit -> No BP1
    cat = make_catalog(episodes=eps, visits=visits, visits_all=visits)
    got = {r["epi_id"]: (r["hours_to_bp1"], r["bp1_status"]) for r in kpis.k17_bp1_detail(cat, P).collect()}
    assert got == {1: (48, "Compliant"), 2: (49, "Late"), 3: (None, "No BP1")}
    s = kpis.k16_bp1_summary(cat, P).first()
    assert (s["total_admissions"], s["bp1_compliant"], s["bp1_compliance_percent"]) == (3, 1, Decimal("33.33"))
    assert s["kpi_status"].endswith("Below KPI")


def test_empty_inputs_give_one_row(make_catalog):
    cat = make_catalog(dim_branch=_dim_rows(), dim_branch_17=_dim_rows())
    k10 = kpis.k10_hce_combined(cat, P).collect()
    assert len(k10) == 1 and k10[0]["raw_hh_pal_census"] is None and k10[0]["hce_value"] is None
    k11 = kpis.k11_hce_total(cat, P).collect()
    assert len(k11) == 1 and k11[0]["total_hce"] is None
    k16 = kpis.k16_bp1_summary(cat, P).collect()
    assert len(k16) == 1 and k16[0]["total_admissions"] == 0 and k16[0]["bp1_compliant"] is None
    assert k16[0]["bp1_compliance_percent"] is None and k16[0]["kpi_status"].endswith("Below KPI")
    assert kpis.k18_patient_days(cat, P).count() == 0


def test_null_buckets_stay_apart_in_full_outer_join(make_catalog):
    eps = [_episode(1, "1998-06-05 00:00:00", code="ZZZ"),                    # unmapped days
           _episode(2, "1998-06-05 00:00:00", status="DELETED", code="B01"),  # deleted: NULL bucket revenue
           _episode(3, "1998-06-01 00:00:00", code="B01")]
    line = (20, 2, None, 1, ts("1998-06-05 00:00:00"), Decimal("100.00"), 0, 0, 1, None)
    cat = make_catalog(episodes=eps, line_items=[line], dim_branch=_dim_rows(), dim_branch_17=_dim_rows())
    rows = kpis.k27_revenue_per_patient_day(cat, P).collect()
    unm = sorted((r["revenue"], r["patient_days"]) for r in rows if r["bucket"] == "(unmapped)")
    assert unm == [(Decimal("0.00"), 11), (Decimal("100.00"), 0)]
    one = [r for r in rows if r["bucket"] == "BRANCH ONE"][0]
    assert one["patient_days"] == 15 and one["revenue_per_patient_day"] == Decimal("0.00")


def test_qa_fanout_counts_joined_rows(make_catalog, fixture_catalog, spark):
    eps = [_episode(1, "1998-06-05 00:00:00", recert="Y"), _episode(2, "1998-06-05 00:00:00", recert=" r "),
           _episode(3, "1998-06-06 00:00:00", recert=None)]
    f2f = [(1, 1), (1, 0), (3, 1)]
    cert = [(1,), (1,), (3,)]
    rec = [(1,)]
    cat = make_catalog(episodes=eps, facetoface=f2f, admission_types=cert, recert_history=rec,
                       dim_branch=_dim_rows())
    r = kpis.k19_qa_compliance(cat, P).first()
    # episode 1: 2 f2f x 2 cert x 1 recert = 4 rows; episode 2: 1 row; episode 3: 1 row
    assert (r["total_episodes"], r["f2f_compliant"], r["cert_compliant"], r["recert_compliant"],
            r["compliant_episodes"]) == (6, 3, 5, 5, 3)
    # the count algebra equals the joined rows of the script on the fixture tables too
    for c in (cat, fixture_catalog):
        assert _qa_brute_force(c) == sorted(
            ((x["bucket"], x["total_episodes"], x["f2f_compliant"], x["cert_compliant"], x["recert_compliant"],
              x["compliant_episodes"]) for x in kpis.k19_qa_compliance(c, P).collect()), key=_nulls_first)


def _qa_brute_force(cat):
    from careledger.functions.columns import as_flag, flag_in
    from careledger.operators.branching import with_bucket
    C = F.col
    e = cat.episodes.filter((C("epi_status") != "DELETED") & C("epi_NonAdmitDate").isNull()
                            & in_window_by_date(C("epi_SocDate"), P.start, P.end))
    e = with_bucket(e, cat.dim_branch)
    j = (e.join(cat.facetoface, C("ceftf_f2fappliestoepiid") == C("epi_id"), "left")
         .join(cat.admission_types, C("ceat_epiid") == C("epi_id"), "left")
         .join(cat.recert_history, C("cerh_epiid") == C("epi_id"), "left"))
    yes = flag_in(C("epi_RecertFlag"), null_as_blank=True)
    f = as_flag(C("ceftf_f2fappliestoepiid").isNotNull() & (C("ceftf_active") == 1))
    c = as_flag(C("ceat_epiid").isNotNull())
    r = F.when(yes & C("cerh_epiid").isNotNull(), 1).when(~yes, 1).otherwise(0)
    j = j.select("bucket", f.alias("f"), c.alias("c"), r.alias("r"))
    g = j.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("f"), F.sum("c"), F.sum("r"),
                                F.sum(as_flag((C("f") == 1) & (C("c") == 1) & (C("r") == 1))))
    return sorted((tuple(x) for x in g.collect()), key=_nulls_first)


def _nulls_first(t):
    return tuple((v is not None, str(v)) for v in t)


def test_trailing_blanks_match_and_group_together(make_catalog):
    eps = [_episode(1, "1998-06-05 00:00:00", code="B01"), _episode(2, "1998-06-05 00:00:00", code="B01  ")]
    cat = make_catalog(episodes=eps, dim_branch=_dim_rows())
    rows = kpis.k01_admissions_by_branch(cat, P).collect()
    assert [(r["service_line"], r["admission_count"]) for r in rows] == [("BRANCH ONE", 2)]
    inv = [(1, "B01", "OPEN", Decimal("10.00"), ts("1998-06-01 00:00:00")),
           (2, "B01  ", "OPEN", Decimal("5.00"), ts("1998-06-01 00:00:00")),
           (3, "   ", "OPEN", Decimal("1.00"), ts("1998-06-01 00:00:00")),
           (4, None, "OPEN", Decimal("2.00"), ts("1998-06-01 00:00:00"))]
    cat = make_catalog(invoices=inv, dim_branch=_dim_rows())
    got = {(r["bucket"], r["branch_code"]): r["ar_total"] for r in kpis.k28_ar_aging(cat, P).collect()}
    assert got == {("BRANCH ONE", "B01"): Decimal("15.00"), ("(no branch)", ""): Decimal("1.00"),
                   ("(no branch)", None): Decimal("2.00")}


def test_wildcard_map_matches_every_branch_of_its_line(make_catalog, spark):
    eps = [_episode(1, "1998-06-05 00:00:00", slid=2, code="B07"), _episode(2, "1998-06-05 00:00:00", slid=2, code="B05")]
    dim = _dim_rows() + [("HOSPICE", 2, None, "ALL HOSPICE")]
    cat = make_catalog(episodes=eps, dim_branch=dim)
    got = sorted((r["service_line"], r["admission_count"]) for r in kpis.k01_admissions_by_branch(cat, P).collect())
    assert got == [("ALL HOSPICE", 2), ("BRANCH FIVE", 1)]


def test_ratio_guards_and_ties(spark):
    df = spark.createDataFrame([(1, 16), (0, 0), (1, 3)], "n long, m long")
    rows = df.select(ratio_pct(F.col("n"), F.col("m"), "decimal(5,1)").alias("a"),
                     ratio_pct(F.col("n"), F.col("m"), "decimal(5,1)", guard="positive").alias("b"),
                     ratio_pct(F.col("n"), F.col("m"), "decimal(6,2)", guard="zero").alias("c")).collect()
    assert rows[0]["a"] == Decimal("6.3") and rows[0]["c"] == Decimal("6.25")
    assert rows[1]["a"] is None and rows[1]["b"] is None and rows[1]["c"] == Decimal("0.00")
    assert rows[2]["a"] == Decimal("33.3")


def test_stacking_uses_first_non_empty_header(spark):
    empty = spark.createDataFrame([], "z string")
    ab = spark.createDataFrame([("a1", "b1")], "a string, b string")
    bc = spark.createDataFrame([("b2", "c2")], "b string, c string")
    out = stack_results([empty, ab, bc])
    assert out.columns == ["result_set", "a", "b"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a1", "b1"), (2, None, "b2")]


def test_placeholder_for_empty_result(spark):
    p = placeholder_if_empty(spark.createDataFrame([], "x int")).collect()
    assert [tuple(r) for r in p] == [("No rows returned",)]
    same = spark.createDataFrame([(1,)], "x int")
    assert placeholder_if_empty(same) is same


def test_run_params_defaults():
    p = RunParams.build(as_of=dt.date(2024, 3, 1))
    assert (p.start, p.end, p.sla_cutoff, p.days_in_window) == (dt.date(2024, 2, 16), dt.date(2024, 3, 1),
                                                                 dt.date(2024, 3, 4), 15)
    assert RunParams.build().end == dt.date.today()
    with pytest.raises(ValueError):
        RunParams.build(start=dt.date(2024, 3, 2), end=dt.date(2024, 3, 1))


def test_duplicate_reason_code_fans_out_unless_deduplicated(make_catalog):
    eps = [_episode(1, "1998-06-02 00:00:00", nonadmit="1998-06-03 00:00:00", nonadmit_code="N1"),
           _episode(2, "1998-06-02 00:00:00", nonadmit="1998-06-04 00:00:00", nonadmit_code="N9")]
    reasons = [("N1", "Not homebound", False), ("N1", "Does not meet criteria", True)]
    cat = make_catalog(episodes=eps, nonadmit_reasons=reasons, dim_branch=_dim_rows(), dim_branch_17=_dim_rows())
    raw = sorted((r["nonadmit_code"], r["nonadmit_reason"], r["refusal_of_service"], r["non_admit_count"])
                 for r in kpis.k25_nonadmit_reasons_raw(cat, P).collect())
    assert raw == [("N1", "Does not meet criteria", True, 1), ("N1", "Not homebound", False, 1),
                   ("N9", "(unknown reason)", None, 1)]
    dedup = sorted((r["nonadmit_code"], r["nonadmit_reason"], r["refusal_of_service"], r["non_admit_count"])
                   for r in kpis.k23_nonadmit_reasons_dedup(cat, P).collect())
    assert dedup == [("N1", "Does not meet criteria", True, 1), ("N9", "(unknown reason)", None, 1)]


def test_run_params_of_all_days_stay_in_spark(spark, tmp_path):
    """One row a day as ``RunParams.build`` has it, read from the table by the plan; a missing day has no dates."""
    from careledger.plans.operator_plans import _r1
    days = [dt.date(2024, 3, 1), dt.date(2024, 3, 1), dt.date(2023, 12, 30), None]
    spark.createDataFrame([(d,) for d in days], "o_orderdate date").write.parquet(str(tmp_path / "orders.parquet"))
    out = _r1(spark, str(tmp_path))
    runs = [RunParams.build(as_of=d) for d in set(days) if d]
    want = [(r.as_of, r.start, r.end, r.sla_cutoff, r.hce_factor) for r in runs] + [(None, None, None, None, runs[0].hce_factor)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert out.inputFiles()
