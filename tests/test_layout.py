"""The bucketed layout gives the same results with fewer shuffles."""

from careledger.params import test_params as fixture_params
from careledger.plans import kpis
from careledger.sources.layout import materialize_bucketed

P = fixture_params()


def _key(t):
    return tuple((v is not None, str(v)) for v in t)


def test_bucketed_layout_same_results_fewer_exchanges(fixture_catalog, tmp_path):
    bc = materialize_bucketed(fixture_catalog, str(tmp_path / "wh"), database="careledger_test", buckets=4)
    for name in ("k26_revenue_by_branch", "k19_qa_compliance", "k16_bp1_summary", "k04_billing_holds_sla"):
        f = kpis.KPI_REPORTS[name]
        a = sorted(map(tuple, f(fixture_catalog, P).collect()), key=_key)
        b = sorted(map(tuple, f(bc, P).collect()), key=_key)
        assert a == b, name
        plain = f(fixture_catalog, P)._jdf.queryExecution().executedPlan().toString()
        bucketed = f(bc, P)._jdf.queryExecution().executedPlan().toString()
        assert bucketed.count("Exchange hashpartitioning") < plain.count("Exchange hashpartitioning"), name
