"""The run store: rows of runs, new frames for updates (a plain table has none)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ("pending", "running", "done", "failed")


def new_run(runs: DataFrame, row: dict) -> DataFrame:
    """K7: runs with one more, pending."""
    return runs.unionByName(runs.sparkSession.createDataFrame([row | {"status": "pending"}], runs.schema))


def run_of(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.where(F.col("run_id") == run_id)


def active(runs: DataFrame) -> DataFrame:
    """One run that is pending or running, if there is any; the oldest."""
    return runs.where(F.col("status").isin("pending", "running")).orderBy("created_at", "run_id").limit(1)


def recent(runs: DataFrame, n: int) -> DataFrame:
    """The latest runs."""
    return runs.orderBy(F.col("created_at").desc(), "run_id").limit(n)


def updated(runs: DataFrame, run_id: str, **values: object) -> DataFrame:
    """Point update by key."""
    return runs.select(*(F.when(F.col("run_id") == run_id, F.lit(values[c]).cast(runs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in runs.columns))


def orphans_failed(runs: DataFrame, why: str, at: str) -> DataFrame:
    """All pending and running runs become failed."""
    orphan = F.col("status").isin("pending", "running")
    put = {"status": "failed", "error_msg": why, "finished_at": at}
    return runs.select(*(F.when(orphan, F.lit(put[c])).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in runs.columns))
