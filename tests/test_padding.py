"""T-SQL ``=`` ignores trailing blanks: blank-padded codes, statuses and flags change no report."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from careledger.params import test_params as fixture_params
from careledger.params import test_params_90 as wide_params
from careledger.plans import kpis
from careledger.plans.operator_plans import _SPARK

PADDED = {
    "episodes": ["epi_status", "epi_AdmitType", "epi_NonAdmitCode", "epi_DcCode", "epi_RecertFlag", "epi_branchcode"],
    "invoices": ["i_status", "i_branchcode"], "pdgm_period": ["pp_reimbursementType", "pp_currentHipps"],
    "pdgm_hipps": ["ph_hipps"], "nonadmit_reasons": ["nac_code"], "visits": ["cev_setsocdateflag"],
    "visits_all": ["cev_setsocdateflag"], "episode_care_types": ["cect_primary"], "branches": ["branch_code"],
    "dim_branch": ["epi_branchcode", "service_line"], "dim_branch_17": ["epi_branchcode", "service_line"],
}


@pytest.fixture(scope="module")
def padded(fixture_catalog):
    """Every other row carries trailing blanks (by a hash of the row)."""
    def pad(df, names):
        odd = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 1
        return df.withColumns({n: F.when(odd, F.concat(F.rtrim(n), F.lit("   "))).otherwise(F.col(n)) for n in names})
    return dataclasses.replace(fixture_catalog, **{t: pad(getattr(fixture_catalog, t), names) for t, names in PADDED.items()})


def rows(df):
    return sorted((tuple(x.rstrip() if isinstance(x, str) else x for x in r) for r in df.collect()), key=str)


REPORTS = ["k01_admissions_by_branch", "k04_billing_holds_sla", "k06_discharges_total", "k07_discharges_by_class",
           "k15_lupa_by_threshold", "k16_bp1_summary", "k23_nonadmit_reasons_dedup", "k25_nonadmit_reasons_raw", "k28_ar_aging"]


@pytest.mark.parametrize("name", REPORTS)
def test_report_is_the_same_on_padded_values(fixture_catalog, padded, name):
    p = wide_params() if name in kpis.WIDE_WINDOW else fixture_params()
    assert rows(kpis.KPI_REPORTS[name](padded, p)) == rows(kpis.KPI_REPORTS[name](fixture_catalog, p))


@pytest.mark.parametrize("name", ["p4_eq_neq_filter", "p6_in_list", "p15_hold_predicate", "j2_left_join_code_only", "j3_wildcard_join"])
def test_operator_is_the_same_on_padded_values(fixture_catalog, padded, name):
    assert rows(_SPARK[name](padded, fixture_params())) == rows(_SPARK[name](fixture_catalog, fixture_params()))
