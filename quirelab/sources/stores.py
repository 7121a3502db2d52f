"""Stores between runs: the register in its current version, the geocode cache, linked mentions with their report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Version of the stored register; stores of another version are built anew.
VERSION = 2


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stored_register(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The register from <path>/version=<VERSION>, built and written first if there is none; a half-written store has no _SUCCESS and is written again."""
    at = f"{path}/version={VERSION}"
    if not _exists(spark, f"{at}/_SUCCESS"):
        build().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


def index_folder(spark: SparkSession, root: str) -> str:
    """The folder with the register's files: <root>/data/index, <root>/index, <root> itself, or data/index one folder down; else the first of these."""
    for at in (f"{root}/data/index", f"{root}/index", root):
        if _exists(spark, f"{at}/person") or _exists(spark, f"{at}/plants"):
            return at
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    below = sorted(str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []
    return next((f"{b}/data/index" for b in below if _exists(spark, f"{b}/data/index/person")), f"{root}/data/index")


def write_geocodes(cache: DataFrame, path: str) -> bool:
    """Write names and what was found for them, misses included; nothing is written for an empty cache."""
    if cache.isEmpty():
        return False
    cache.write.mode("overwrite").parquet(path)
    return True


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    """The cache, or an empty one where none was written."""
    if _exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], "name string, lat double, lon double, source string, found boolean")


def write_linked(linked: DataFrame, issues: DataFrame, coverage: DataFrame, path: str) -> None:
    """Linked mentions as JSON lines, and beside them the consistency report: coverage, issues, and counts of issues."""
    linked.write.mode("overwrite").json(f"{path}/linked")
    coverage.write.mode("overwrite").json(f"{path}/report/coverage")
    issues.write.mode("overwrite").json(f"{path}/report/issues")
    issues.groupBy("severity", "issue_type").agg(F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/report/summary")


def accuracy_report(scores: DataFrame, title: str) -> str:
    """A table of run scores (run_id, matched_cer, ..., one row a run) as Markdown."""
    names = [c for c in scores.columns]
    shown = lambda v: "" if v is None else f"{100 * v:.2f} %" if isinstance(v, float) else str(v)
    lines = [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
    return "\n".join(lines + ["| " + " | ".join(shown(r[c]) for c in names) + " |" for r in scores.orderBy(names[0]).toLocalIterator()]) + "\n"
