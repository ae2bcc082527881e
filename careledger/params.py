"""Run parameters (R1): the dates and constants every report is bound to."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

# Fixed values taken from the KPI scripts (business constants).
WINDOW_DAYS_BACK = 14          # window = end - 14 days .. end, both inclusive
SLA_DAYS_AFTER_END = 3         # billing-hold SLA cutoff = end + 3 days
HCE_FACTOR = Decimal("0.400")  # home-health census factor, decimal(5,3)
MEDIAN_LOS_BENCHMARK = 100     # median length-of-stay benchmark, days
FAST_ADMIT_DAYS = 2            # admitted within 2 days of referral
BP1_HOURS = 48                 # first visit within 48 hour boundaries
BP1_TARGET_PCT = 80            # KPI target share, percent

# Dates used by tests, the oracle and the benchmark.
TEST_END = dt.date(1998, 6, 15)


@dataclass(frozen=True)
class RunParams:
    """Immutable parameter set of one report run.

    ``as_of`` and ``end`` default to today, ``start`` to end - 14 days;
    ``sla_cutoff`` and ``hce_factor`` are run parameters too (the scripts
    declare them locally, the runner would leave them unbound).
    """

    as_of: dt.date
    start: dt.date
    end: dt.date
    sla_cutoff: dt.date
    hce_factor: Decimal = field(default=HCE_FACTOR)

    @classmethod
    def build(cls, as_of=None, start=None, end=None, sla_cutoff=None,
              hce_factor=HCE_FACTOR) -> "RunParams":
        as_of, start, end, sla_cutoff = run_days(
            _as_date(as_of) or dt.date.today(), lambda day, n: day + dt.timedelta(days=n),
            _as_date(start), _as_date(end), _as_date(sla_cutoff))
        if start > end:
            raise ValueError(f"start {start} is after end {end}")
        return cls(as_of, start, end, sla_cutoff, Decimal(hce_factor))

    @property
    def days_in_window(self) -> int:
        return (self.end - self.start).days + 1

    def sql_args(self) -> dict:
        """Named arguments for ``spark.sql(text, args=...)``."""
        return {"as_of": self.as_of, "start": self.start, "end": self.end,
                "sla_cutoff": self.sla_cutoff, "hce_factor": self.hce_factor}


def run_days(as_of, plus, start=None, end=None, sla_cutoff=None):
    """(as_of, start, end, sla_cutoff) with the defaults of a run on ``as_of``.

    Days are dates or Spark columns; ``plus(day, n)`` adds n days to one."""
    end = as_of if end is None else end
    start = plus(end, -WINDOW_DAYS_BACK) if start is None else start
    sla_cutoff = plus(end, SLA_DAYS_AFTER_END) if sla_cutoff is None else sla_cutoff
    return as_of, start, end, sla_cutoff


def _as_date(value):
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def test_params() -> RunParams:
    """15-day window ending 1998-06-15 (the fixture run date)."""
    return RunParams.build(as_of=TEST_END)


def test_params_90() -> RunParams:
    """Wider window for thin reports (K02): 1998-03-17 .. 1998-06-15."""
    return RunParams.build(as_of=TEST_END, start=dt.date(1998, 3, 17))
