"""Binding of the driver's TPC-H-style parquet tables to the report tables.

The rules are the ones of FIXTURES.md section 3 (ok = o_orderkey,
od = o_orderdate, ck = o_custkey, nk = the customer's c_nationkey).  Every
table is a lazy projection of one or two scans, so a report that needs three
columns of ``episodes`` reads three columns of ``orders`` (plus the
customer key), and its filters run inside the same stage as the scan.
The only shuffle the binding adds is orders x customer for the nation key
(and orders for the invoice / visit bindings); both are hash joins on a
key, never a product.

Choices the fixture rules leave open, made here and in the oracle alike:
visits with line number > 2 carry SOC flag ``'N'``; ``branches`` codes carry
one trailing blank; certification primary flag is ``'N'`` when not ``'Y'``;
the non-admit reason texts are invented (codes N1 and N3 twice, N6 missing);
line amounts are computed in decimal (price and discount as decimal(15,2))
so that Spark and DuckDB round the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.sources.catalog import Catalog
from careledger.sources.dims import HOME_HEALTH, HOSPICE

# Fixed values of the fixture binding.
RECERT_FLAGS_BY_OK6 = ["Y", " r ", "recert", "N", None, ""]
DC_CODES_BY_CK11 = ["DTH", "EXP ", "REV", "TRH", "EXT", "NLT", "OOA", "DFC", "TXI", "ZZZ", None]
NONADMIT_REASON_ROWS = [
    ("N0", "Patient declined", False),
    ("N1", "Not homebound", False),
    ("N1", "Does not meet criteria", True),
    ("N2", "Out of service area", False),
    ("N3", "Refused service", True),
    ("N3", "Family refused", False),
    ("N4", "Admitted elsewhere", False),
    ("N5", "Physician declined", False),
]
HIPPS_CODES = 10          # H0 .. H9; threshold 2 + i % 4
BRANCH_DIM_MAX_KEY = 16   # nations with key < 16 are mapped
HOME_HEALTH_MAX_KEY = 4   # key < 4 -> HOME HEALTH
EXTRA_DIM_KEY = 16        # the 17-row variant adds this key as HOSPICE


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _branch_code(nk: Column) -> Column:
    return F.concat(F.lit("B"), F.lpad(nk.cast("string"), 2, "0"))


def _add_hours(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), n.cast("int"))


def _add_days(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(n.cast("int"))


def _pick(index: Column, values: list) -> Column:
    """CASE index WHEN 0 THEN values[0] ... END (NULL entries stay NULL)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def bind_driver_tables(spark: SparkSession, sf_dir: str) -> Catalog:
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer")
    lineitem = _read(spark, sf_dir, "lineitem")
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")

    ok, od, ck = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_custkey")
    nk = F.col("c_nationkey")

    # ---- episodes: orders joined to the customer's nation ------------------
    cust = customer.select(F.col("c_custkey"), nk)
    status = (F.when(F.col("o_orderstatus") == "O", "CURRENT")
              .when(F.col("o_orderstatus") == "F", "DISCHARGED")
              .when(F.col("o_orderstatus") == "P",
                    F.when(ok % 3 == 0, "DELETED").when(ok % 3 == 1, "RECERTIFIED")
                    .otherwise("CURRENT")))
    episodes = (
        orders.join(cust, ck == F.col("c_custkey"), "inner")
        .select(
            ok.alias("epi_id"),
            ck.alias("epi_paid"),
            F.when((nk < HOME_HEALTH_MAX_KEY) | (nk == EXTRA_DIM_KEY), 1).otherwise(2).alias("epi_slid"),
            F.concat(_branch_code(nk), F.when(ok % 4 == 0, F.lit("  ")).otherwise(F.lit("")))
            .alias("epi_branchcode"),
            status.alias("epi_status"),
            F.when(F.col("o_orderpriority") == "5-LOW", "READMISSION").otherwise("NEW ADMISSION")
            .alias("epi_AdmitType"),
            F.when(ok % 17 == 0, F.lit(None).cast("timestamp_ntz"))
            .when(ok % 23 == 0, _add_days(od, F.lit(2)))
            .otherwise(_add_days(od, -(ok % 8))).alias("epi_DateOfReferral"),
            _add_hours(od, ok % 24).alias("epi_SocDate"),
            F.when(ok % 5 != 0, _add_days(od, ok * 7 % 120)).alias("epi_DischargeDate"),
            F.when(ok % 11 == 0, _add_days(od, F.lit(1))).alias("epi_NonAdmitDate"),
            F.when(ok % 11 == 0, F.concat(F.lit("N"), (ck % 7).cast("string"))).alias("epi_NonAdmitCode"),
            _pick(ok % 6, RECERT_FLAGS_BY_OK6).alias("epi_RecertFlag"),
            _pick(ck % 11, DC_CODES_BY_CK11).alias("epi_DcCode"),
        )
    )

    # ---- dimensions from nation / region (25 and 5 rows by definition) ----
    n_key = F.col("n_nationkey")
    dim_cols = [
        F.when(n_key < HOME_HEALTH_MAX_KEY, HOME_HEALTH).otherwise(HOSPICE).alias("service_line"),
        F.when(n_key < HOME_HEALTH_MAX_KEY, 1).otherwise(2).alias("epi_slid"),
        _branch_code(n_key).alias("epi_branchcode"),
        F.concat(F.lit("BRANCH "), F.col("n_name")).alias("branch_name"),
    ]
    dim_branch = nation.filter(n_key < BRANCH_DIM_MAX_KEY).select(*dim_cols)
    dim_branch_17 = nation.filter(n_key <= EXTRA_DIM_KEY).select(*dim_cols)
    service_lines = spark.createDataFrame([(1, HOME_HEALTH), (2, HOSPICE)], "sl_id int, sl_desc string")
    branches = nation.select(F.concat(_branch_code(n_key), F.lit(" ")).alias("branch_code"),
                             F.concat(F.lit("BRANCH "), F.col("n_name")).alias("branch_name"))
    care_types = region.filter(F.col("r_regionkey") < 4).select(
        F.col("r_regionkey").cast("int").alias("ctype_id"), F.col("r_name").alias("ctype_description"))
    episode_care_types = orders.select(
        ok.alias("cect_epiid"),
        F.when(ok % 4 == 0, "N").otherwise("Y").alias("cect_primary"),
        (ck % 5).cast("int").alias("cect_ctypeid"))

    # ---- billing -----------------------------------------------------------
    lok = F.col("l_orderkey")
    line_items = lineitem.select(
        (lok * 10 + F.col("l_linenumber")).alias("li_id"),
        lok.alias("li_epiid"),
        F.when(F.col("l_returnflag") != "N", lok).alias("li_iid"),
        F.when(F.col("l_suppkey") % 10 == 0, 1).otherwise(2).alias("li_slid"),
        F.col("l_shipdate").alias("li_servicedate"),
        (F.col("l_extendedprice").cast("decimal(15,2)")
         * (F.lit(1) - F.col("l_discount").cast("decimal(15,2)"))).cast("decimal(18,2)")
        .alias("li_calculatedamount"),
        F.when(F.col("l_tax") > 0.07, 1).otherwise(0).alias("li_deleted"),
        F.when(F.col("l_quantity") == 1, 1).otherwise(0).alias("li_void"),
        F.when(F.col("l_linenumber") == 7, 0).otherwise(1).alias("li_includeonclaim"),
        F.when(F.col("l_linestatus") != "O", _add_days(F.col("l_shipdate"), lok % 30))
        .alias("li_ediexportdate"),
    )
    epi_codes = episodes.select(F.col("epi_id"), F.col("epi_branchcode"))
    invoices = orders.join(epi_codes, ok == F.col("epi_id"), "inner").select(
        ok.alias("i_id"),
        F.when(ok % 19 == 0, F.lit(None).cast("string")).when(ok % 29 == 0, F.lit("   "))
        .otherwise(F.col("epi_branchcode")).alias("i_branchcode"),
        F.when(F.col("o_orderstatus") == "P", "HOLD").when(ok % 9 == 0, "HELD").otherwise("OPEN")
        .alias("i_status"),
        F.when((F.col("o_orderstatus") == "F") & (ok % 2 == 0), F.lit(0).cast("decimal(18,2)"))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)")).alias("i_balance"),
        F.when(ok % 31 != 0, od).alias("i_postdate"),
    )

    # ---- periods and visits -------------------------------------------------
    episode_fs = orders.select((ok + 1_000_000).alias("cefs_id"), ok.alias("cefs_epiid"))
    pdgm_period = orders.select(
        ok.alias("pp_id"),
        (ok + 1_000_000).alias("pp_cefsId"),
        F.to_date(od).alias("pp_startDate"),
        F.date_add(F.to_date(od), 29).alias("pp_endDate"),
        F.when(ok % 5 == 0, " LUPA").when(ok % 5 == 1, "L ").otherwise("FULL").alias("pp_reimbursementType"),
        F.concat(F.lit("H"), (ck % 12).cast("string"), F.lit(" ")).alias("pp_currentHipps"),
        F.when(ok % 13 == 0, 1).otherwise(0).alias("pp_deleted"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("pp_periodEnded"),
    )
    pdgm_hipps = spark.range(HIPPS_CODES).select(
        F.concat(F.lit("H"), F.col("id").cast("string")).alias("ph_hipps"),
        (F.lit(2) + F.col("id") % 4).cast("int").alias("ph_lupaThreshold"))
    order_dates = orders.select(F.col("o_orderkey"), od)
    visits_all = lineitem.join(order_dates, lok == ok, "inner").select(
        (lok * 10 + F.col("l_linenumber")).alias("cev_id"),
        lok.alias("cev_epiid"),
        _add_hours(od, F.col("l_linenumber") * 13 + lok % 40).alias("cev_visitdate"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("cev_deleted"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("cev_billable"),
        F.when(F.col("l_linenumber") <= 2, "Y").otherwise("N").alias("cev_setsocdateflag"),
    )

    # ---- QA compliance and non-admit reasons ------------------------------
    facetoface = lineitem.filter(F.col("l_linenumber") <= 2).select(
        lok.alias("ceftf_f2fappliestoepiid"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("ceftf_active"))
    admission_types = orders.filter(ok % 10 != 0).select(ok.alias("ceat_epiid"))
    recert_history = lineitem.filter(F.col("l_linenumber") == 3).select(lok.alias("cerh_epiid"))
    nonadmit_reasons = spark.createDataFrame(
        NONADMIT_REASON_ROWS, "nac_code string, nac_desc string, nac_refusalofservice boolean")

    return Catalog(
        spark=spark, episodes=episodes, service_lines=service_lines, branches=branches,
        episode_care_types=episode_care_types, care_types=care_types, line_items=line_items,
        invoices=invoices, pdgm_period=pdgm_period, episode_fs=episode_fs,
        visits_all=visits_all, visits=visits_all, pdgm_hipps=pdgm_hipps,
        nonadmit_reasons=nonadmit_reasons, facetoface=facetoface,
        admission_types=admission_types, recert_history=recert_history,
        dim_branch=dim_branch, dim_branch_17=dim_branch_17,
    )
