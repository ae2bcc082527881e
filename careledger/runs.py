"""Runs that readers see whole or not at all.

Under ``<out>/<stamp>``:

* ``run-<id>/<output>``: what one run writes.  Nobody reads it before it is published,
  so reports may be written in any order, replaced by a placeholder, or fail.
* ``_published/<number>.json``: a manifest with the outputs and row counts of a
  whole run.  Creating that one new file publishes the run; the highest number is
  the current run.  Files are never overwritten, so this holds on object stores too,
  and a run that fails leaves the earlier one as it was.

``published`` reads the current manifest; ``retire`` deletes runs that later ones
have replaced.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from careledger.sources import files

MANIFESTS = "_published"


@dataclass(frozen=True)
class Output:
    """One report of a published run; ``rows`` without the placeholder of an empty one."""
    report: str
    output: str
    rows: int
    placeholder: bool
    path: str
    format: str = "parquet"


class Run:
    """A run that is being written."""

    def __init__(self, spark: SparkSession, out_dir: str, stamp: str):
        self.spark, self.root = spark, f"{out_dir.rstrip('/')}/{stamp}"
        self.id = f"run-{uuid.uuid4().hex}"
        self.outputs: list[Output] = []

    def path(self, output: str) -> str:
        return f"{self.root}/{self.id}/{output}"

    def part(self, number: int) -> str:
        """Where a result set that is not a report by itself is kept until the run is published."""
        return f"{self.root}/{self.id}/_parts/{number}"

    def add(self, report: str, output: str, rows: int, placeholder: bool) -> None:
        self.outputs.append(Output(report, output, rows, placeholder, self.path(output)))

    def publish(self, fmt: str) -> None:
        files.remove(self.spark, f"{self.root}/{self.id}/_parts")
        reports = [{k: v for k, v in asdict(o).items() if k not in ("path", "format")} for o in self.outputs]
        text = json.dumps({"run": self.id, "format": fmt, "reports": reports}, ensure_ascii=False)
        number = max(_numbers(self.spark, self.root), default=0) + 1
        while not files.create_once(self.spark, f"{self.root}/{MANIFESTS}/{number:09d}.json", text):
            number += 1                                     # another run was published meanwhile

    def discard(self) -> None:
        files.remove(self.spark, f"{self.root}/{self.id}")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = [n[:-5] for n in files.names_in(spark, f"{root}/{MANIFESTS}") if n.endswith(".json")]
    return [int(n) for n in names if n.isdigit()]


def _manifest(spark: SparkSession, root: str, number: int) -> dict | None:
    try:
        return json.loads(files.read_text(spark, f"{root}/{MANIFESTS}/{number:09d}.json"))
    except ValueError:
        return None                                         # its writer was lost: the run was never published


def published(spark: SparkSession, out_dir: str, stamp: str) -> dict[str, Output]:
    """The outputs of the current run by report name; empty where none is published."""
    root = f"{out_dir.rstrip('/')}/{stamp}"
    for number in sorted(_numbers(spark, root), reverse=True):
        found = _manifest(spark, root, number)
        if found is not None:
            return {r["report"]: Output(**r, path=f"{root}/{found['run']}/{r['output']}", format=found["format"])
                    for r in found["reports"]}
    return {}


def read_report(spark: SparkSession, out_dir: str, stamp: str, report: str) -> DataFrame:
    """One report of the current run."""
    found = published(spark, out_dir, stamp)[report]
    return spark.read.format(found.format).load(found.path)


def retire(spark: SparkSession, out_dir: str, stamp: str, keep: int = 2) -> list[str]:
    """Delete all published runs but the last ``keep``; runs that are being written stay.  Returns what went."""
    if keep < 1:
        raise ValueError("the current run stays")
    root, gone = f"{out_dir.rstrip('/')}/{stamp}", []
    whole = [(n, m["run"]) for n in sorted(_numbers(spark, root)) if (m := _manifest(spark, root, n)) is not None]
    for number, run in whole[:-keep]:
        files.remove(spark, f"{root}/{MANIFESTS}/{number:09d}.json")        # first what points to it
        files.remove(spark, f"{root}/{run}")
        gone.append(run)
    return gone
