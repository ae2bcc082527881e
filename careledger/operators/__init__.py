"""Relational building blocks shared by the reports: branch joins and
bucketing (J1-J4, A1, A10), census spine (S4, J7), per-key pre-aggregation
(J9, J10), result stacking (R3, R4) and script-text jobs (T1-T5)."""
