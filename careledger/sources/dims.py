"""Inline code maps.

These are literal tables of a handful of rows; Spark plans them as a
``LocalRelation`` whose size is known at planning time, so joining them is
always a broadcast hash join without any hint or size guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Discharge reason code -> discharge class (9 rows).
DC_CLASS_ROWS = [
    ("DTH", "Death"),
    ("EXP", "Death"),
    ("REV", "LiveDC-PatientInitiated"),
    ("TRH", "LiveDC-PatientInitiated"),
    ("EXT", "LiveDC-HospiceInitiated"),
    ("NLT", "LiveDC-HospiceInitiated"),
    ("OOA", "LiveDC-HospiceInitiated"),
    ("DFC", "LiveDC-HospiceInitiated"),
    ("TXI", "Other"),
]

# Reimbursement types that mark a low-utilisation period.
LUPA_CODES = ["LUPA", "L"]

# Service line names and their sort rank (unmatched rank 99).
HOME_HEALTH = "HOME HEALTH"
HOSPICE = "HOSPICE"
UNMATCHED_RANK = 99

BRANCH_DIM_SCHEMA = "service_line string, epi_slid int, epi_branchcode string, branch_name string"


def dc_class(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DC_CLASS_ROWS, "dr_code string, dc_class string")


def lupa_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in LUPA_CODES], "code string")


def branch_dim(spark: SparkSession, rows) -> DataFrame:
    """A site's branch dimension from literal rows
    ``(service_line, epi_slid, epi_branchcode, branch_name)``."""
    return spark.createDataFrame(list(rows), BRANCH_DIM_SCHEMA)
