"""The fixture binding written as plain SQL CTEs (DuckDB dialect).

This is an independent statement of the rules in
``careledger.sources.driver_tables``: the oracle queries are written
against these CTEs the way the original scripts are written against their
tables, so a Spark result and its oracle share no code.
"""

from __future__ import annotations

TABLE_SQL = {
    "episodes": """
  SELECT o.o_orderkey AS epi_id,
         o.o_custkey AS epi_paid,
         CASE WHEN c.c_nationkey < 4 OR c.c_nationkey = 16 THEN 1 ELSE 2 END AS epi_slid,
         'B' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')
             || CASE WHEN o.o_orderkey % 4 = 0 THEN '  ' ELSE '' END AS epi_branchcode,
         CASE o.o_orderstatus WHEN 'O' THEN 'CURRENT' WHEN 'F' THEN 'DISCHARGED'
              WHEN 'P' THEN CASE o.o_orderkey % 3 WHEN 0 THEN 'DELETED' WHEN 1 THEN 'RECERTIFIED'
                                 ELSE 'CURRENT' END END AS epi_status,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 'READMISSION' ELSE 'NEW ADMISSION' END AS epi_AdmitType,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL
              WHEN o.o_orderkey % 23 = 0 THEN o.o_orderdate + INTERVAL 2 DAY
              ELSE o.o_orderdate - to_days(CAST(o.o_orderkey % 8 AS INTEGER)) END AS epi_DateOfReferral,
         o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS BIGINT)) AS epi_SocDate,
         CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
              ELSE o.o_orderdate + to_days(CAST(o.o_orderkey * 7 % 120 AS INTEGER)) END AS epi_DischargeDate,
         CASE WHEN o.o_orderkey % 11 = 0 THEN o.o_orderdate + INTERVAL 1 DAY END AS epi_NonAdmitDate,
         CASE WHEN o.o_orderkey % 11 = 0 THEN 'N' || CAST(o.o_custkey % 7 AS VARCHAR) END AS epi_NonAdmitCode,
         CASE o.o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN ' r ' WHEN 2 THEN 'recert' WHEN 3 THEN 'N'
              WHEN 4 THEN NULL ELSE '' END AS epi_RecertFlag,
         CASE o.o_custkey % 11 WHEN 0 THEN 'DTH' WHEN 1 THEN 'EXP ' WHEN 2 THEN 'REV' WHEN 3 THEN 'TRH'
              WHEN 4 THEN 'EXT' WHEN 5 THEN 'NLT' WHEN 6 THEN 'OOA' WHEN 7 THEN 'DFC' WHEN 8 THEN 'TXI'
              WHEN 9 THEN 'ZZZ' ELSE NULL END AS epi_DcCode
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "dim_branch": """
  SELECT CASE WHEN n_nationkey < 4 THEN 'HOME HEALTH' ELSE 'HOSPICE' END AS service_line,
         CASE WHEN n_nationkey < 4 THEN 1 ELSE 2 END AS epi_slid,
         'B' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS epi_branchcode,
         'BRANCH ' || n_name AS branch_name
  FROM nation WHERE n_nationkey < 16""",
    "dim_branch_17": """
  SELECT CASE WHEN n_nationkey < 4 THEN 'HOME HEALTH' ELSE 'HOSPICE' END AS service_line,
         CASE WHEN n_nationkey < 4 THEN 1 ELSE 2 END AS epi_slid,
         'B' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS epi_branchcode,
         'BRANCH ' || n_name AS branch_name
  FROM nation WHERE n_nationkey <= 16""",
    "service_lines": """
  SELECT * FROM (VALUES (1, 'HOME HEALTH'), (2, 'HOSPICE')) AS t(sl_id, sl_desc)""",
    "branches": """
  SELECT 'B' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ' ' AS branch_code,
         'BRANCH ' || n_name AS branch_name
  FROM nation""",
    "care_types": """
  SELECT CAST(r_regionkey AS INTEGER) AS ctype_id, r_name AS ctype_description
  FROM region WHERE r_regionkey < 4""",
    "episode_care_types": """
  SELECT o_orderkey AS cect_epiid, CASE WHEN o_orderkey % 4 = 0 THEN 'N' ELSE 'Y' END AS cect_primary,
         CAST(o_custkey % 5 AS INTEGER) AS cect_ctypeid
  FROM orders""",
    "line_items": """
  SELECT l_orderkey * 10 + l_linenumber AS li_id,
         l_orderkey AS li_epiid,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END AS li_iid,
         CASE WHEN l_suppkey % 10 = 0 THEN 1 ELSE 2 END AS li_slid,
         l_shipdate AS li_servicedate,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))
              AS DECIMAL(18,2)) AS li_calculatedamount,
         CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END AS li_deleted,
         CASE WHEN l_quantity = 1 THEN 1 ELSE 0 END AS li_void,
         CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END AS li_includeonclaim,
         CASE WHEN l_linestatus = 'O' THEN NULL
              ELSE l_shipdate + to_days(CAST(l_orderkey % 30 AS INTEGER)) END AS li_ediexportdate
  FROM lineitem""",
    "invoices": """
  SELECT o.o_orderkey AS i_id,
         CASE WHEN o.o_orderkey % 19 = 0 THEN NULL WHEN o.o_orderkey % 29 = 0 THEN '   '
              ELSE e.epi_branchcode END AS i_branchcode,
         CASE WHEN o.o_orderstatus = 'P' THEN 'HOLD' WHEN o.o_orderkey % 9 = 0 THEN 'HELD'
              ELSE 'OPEN' END AS i_status,
         CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 2 = 0 THEN CAST(0 AS DECIMAL(18,2))
              ELSE CAST(o.o_totalprice AS DECIMAL(18,2)) END AS i_balance,
         CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE o.o_orderdate END AS i_postdate
  FROM orders o JOIN episodes e ON e.epi_id = o.o_orderkey""",
    "episode_fs": """
  SELECT o_orderkey + 1000000 AS cefs_id, o_orderkey AS cefs_epiid FROM orders""",
    "pdgm_period": """
  SELECT o_orderkey AS pp_id, o_orderkey + 1000000 AS pp_cefsId,
         CAST(o_orderdate AS DATE) AS pp_startDate,
         CAST(o_orderdate AS DATE) + 29 AS pp_endDate,
         CASE o_orderkey % 5 WHEN 0 THEN ' LUPA' WHEN 1 THEN 'L ' ELSE 'FULL' END AS pp_reimbursementType,
         'H' || CAST(o_custkey % 12 AS VARCHAR) || ' ' AS pp_currentHipps,
         CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS pp_deleted,
         CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS pp_periodEnded
  FROM orders""",
    "pdgm_hipps": """
  SELECT 'H' || CAST(i AS VARCHAR) AS ph_hipps, CAST(2 + i % 4 AS INTEGER) AS ph_lupaThreshold
  FROM range(10) t(i)""",
    "visits": """
  SELECT l.l_orderkey * 10 + l.l_linenumber AS cev_id,
         l.l_orderkey AS cev_epiid,
         o.o_orderdate + to_hours(CAST(l.l_linenumber * 13 + l.l_orderkey % 40 AS BIGINT)) AS cev_visitdate,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS cev_deleted,
         CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS cev_billable,
         CASE WHEN l.l_linenumber <= 2 THEN 'Y' ELSE 'N' END AS cev_setsocdateflag
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "facetoface": """
  SELECT l_orderkey AS ceftf_f2fappliestoepiid, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS ceftf_active
  FROM lineitem WHERE l_linenumber <= 2""",
    "admission_types": """
  SELECT o_orderkey AS ceat_epiid FROM orders WHERE o_orderkey % 10 <> 0""",
    "recert_history": """
  SELECT l_orderkey AS cerh_epiid FROM lineitem WHERE l_linenumber = 3""",
    "nonadmit_reasons": """
  SELECT * FROM (VALUES
    ('N0', 'Patient declined', false),
    ('N1', 'Not homebound', false),
    ('N1', 'Does not meet criteria', true),
    ('N2', 'Out of service area', false),
    ('N3', 'Refused service', true),
    ('N3', 'Family refused', false),
    ('N4', 'Admitted elsewhere', false),
    ('N5', 'Physician declined', false)
  ) AS t(nac_code, nac_desc, nac_refusalofservice)""",
    "dc_class": """
  SELECT * FROM (VALUES
    ('DTH','Death'),('EXP','Death'),
    ('REV','LiveDC-PatientInitiated'),('TRH','LiveDC-PatientInitiated'),
    ('EXT','LiveDC-HospiceInitiated'),('NLT','LiveDC-HospiceInitiated'),
    ('OOA','LiveDC-HospiceInitiated'),('DFC','LiveDC-HospiceInitiated'),
    ('TXI','Other')
  ) AS c(dr_code, dc_class)""",
    "lupa_codes": """
  SELECT * FROM (VALUES ('LUPA'), ('L')) AS c(code)""",
}
TABLE_SQL["visits_all"] = TABLE_SQL["visits"]

DEPENDS = {"invoices": ["episodes"]}


def with_tables(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named tables (dependencies first)."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({TABLE_SQL[n]}\n)" for n in order)
    body = body.strip()
    head = body.upper()
    if head.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if head.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
