"""Small files and folder listings by the file system that Spark itself uses for a path.

For catalog-sized things only (a run's manifest, whether a folder exists); data
is read and written by executors."""

from __future__ import annotations

from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _on(spark, path)
    return fs.exists(place) and fs.getFileStatus(place).isDirectory()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where it does not exist."""
    if not folder_exists(spark, folder):
        return []
    fs, place = _on(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False where another writer had it first."""
    fs, place = _on(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError:
        if fs.exists(place):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _on(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _on(spark, path)
    fs.delete(place, True)
