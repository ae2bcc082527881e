"""careledger: recurring home-health / hospice KPI reports as Spark jobs.

Every report is a function ``(Catalog, RunParams) -> DataFrame`` built from
DataFrame / SQL built-ins only, so Catalyst plans it and executors run it.
"""

from careledger.params import RunParams

__all__ = ["RunParams"]
