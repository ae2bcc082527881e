"""The logical tables every report reads.

A ``Catalog`` is a bag of lazy DataFrames.  Nothing is read until a report
runs an action; Catalyst prunes columns and pushes filters into each scan.
Production code builds one from real tables (``Catalog.from_tables``);
tests and the benchmark build one from the driver's parquet files
(``careledger.sources.driver_tables``).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from careledger.sources import dims


@dataclass(frozen=True)
class Catalog:
    spark: SparkSession
    episodes: DataFrame            # CLIENT_EPISODES_ALL
    service_lines: DataFrame       # SERVICE_LINES
    branches: DataFrame            # BRANCHES
    episode_care_types: DataFrame  # CLIENT_EPISODE_CARE_TYPES
    care_types: DataFrame          # CARE_TYPES
    line_items: DataFrame          # Billing.LINE_ITEMS
    invoices: DataFrame            # Billing.INVOICES
    pdgm_period: DataFrame         # PDGM.PDGM_PERIOD
    episode_fs: DataFrame          # CLIENT_EPISODE_FS
    visits_all: DataFrame          # CLIENT_EPISODE_VISITS_ALL
    visits: DataFrame              # CLIENT_EPISODE_VISITS
    pdgm_hipps: DataFrame          # PDGM_HIPPS
    nonadmit_reasons: DataFrame    # NONADMIT_REASONS
    facetoface: DataFrame          # CLIENT_EPISODE_FACETOFACE
    admission_types: DataFrame     # CLIENT_EPISODE_ADMISSION_TYPES
    recert_history: DataFrame      # CLIENT_EPISODE_RECERT_HISTORY
    dim_branch: DataFrame          # site branch dimension (service_line, epi_slid, epi_branchcode, branch_name)
    dim_branch_17: DataFrame       # the variant with one extra code

    @property
    def dc_class(self) -> DataFrame:
        return dims.dc_class(self.spark)

    @property
    def lupa_codes(self) -> DataFrame:
        return dims.lupa_codes(self.spark)

    def register_views(self) -> None:
        """Expose every table as a temp view (for ``spark.sql`` reports)."""
        for f in fields(self):
            if f.name != "spark":
                getattr(self, f.name).createOrReplaceTempView(f.name)
        self.dc_class.createOrReplaceTempView("dc_class")
        self.lupa_codes.createOrReplaceTempView("lupa_codes")

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, dim_branch: DataFrame,
                     dim_branch_17: DataFrame | None = None) -> "Catalog":
        """Bind to one parquet folder per table under ``root`` (``root/episodes``, ...)."""
        names = [f.name for f in fields(cls) if f.name not in ("spark", "dim_branch", "dim_branch_17")]
        kw = {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}
        return cls(spark=spark, dim_branch=dim_branch,
                   dim_branch_17=dim_branch_17 if dim_branch_17 is not None else dim_branch, **kw)

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, tables: dict[str, str], dim_branch: DataFrame,
                  dim_branch_17: DataFrame | None = None, properties: dict | None = None,
                  partitioning: dict[str, tuple[str, int, int, int]] | None = None) -> "Catalog":
        """Bind to database tables (``{logical name: "schema.table"}``) over JDBC.

        Large tables should be read in parallel: ``partitioning`` maps a
        logical name to ``(column, lower, upper, num_partitions)`` on a
        numeric key (e.g. the episode id), giving that many range queries
        instead of one.  Timestamps are read as TIMESTAMP_NTZ, matching the
        database's zone-less ``datetime``.  Window filters of the reports are
        pushed into the generated SQL by the JDBC source.  (Not exercised in
        this repository's tests, which start no database.)"""
        props = {"preferTimestampNTZ": "true", **(properties or {})}
        kw = {}
        for name, table in tables.items():
            reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**props)
            spec = (partitioning or {}).get(name)
            if spec is not None:
                col, lower, upper, num = spec
                reader = (reader.option("partitionColumn", col).option("lowerBound", str(lower))
                          .option("upperBound", str(upper)).option("numPartitions", str(num)))
            kw[name] = reader.load()
        if "visits" not in kw and "visits_all" in kw:
            kw["visits"] = kw["visits_all"]
        return cls(spark=spark, dim_branch=dim_branch,
                   dim_branch_17=dim_branch_17 if dim_branch_17 is not None else dim_branch, **kw)

    @classmethod
    def from_tables(cls, spark: SparkSession, names: dict[str, str],
                    dim_branch: DataFrame, dim_branch_17: DataFrame | None = None) -> "Catalog":
        """Bind to tables of a metastore or JDBC-registered views by name."""
        kw = {k: spark.table(v) for k, v in names.items()}
        return cls(spark=spark, dim_branch=dim_branch,
                   dim_branch_17=dim_branch_17 if dim_branch_17 is not None else dim_branch, **kw)
