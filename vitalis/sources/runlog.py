"""Append-only log of runs: parameters, metrics and artifacts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "experiment string, run_id string, kind string, key string, value string, logged_at timestamp"
KINDS = ("param", "metric", "artifact", "status")


class RunLog:
    """Long Parquet table (experiment, run_id, kind, key, value, logged_at); entries are only added."""

    def __init__(self, spark: SparkSession, path: str, experiment: str) -> None:
        self.spark, self.path, self.experiment = spark, path, experiment

    def log_frame(self, entries: DataFrame) -> None:
        """Append many entries (run_id, kind, key, value) at once."""
        entries.select(
            F.lit(self.experiment).alias("experiment"),
            F.col("run_id").cast("string").alias("run_id"),
            "kind",
            "key",
            F.col("value").cast("string").alias("value"),
            F.current_timestamp().alias("logged_at"),
        ).write.mode("append").parquet(self.path)

    def log(self, run_id: str, kind: str, values: Mapping[str, object]) -> None:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        rows = [(run_id, kind, k, str(v)) for k, v in values.items()]
        self.log_frame(self.spark.createDataFrame(rows, "run_id string, kind string, key string, value string"))

    def end(self, run_id: str) -> None:
        self.log(run_id, "status", {"ended": "true"})

    def entries(self) -> DataFrame:
        """The newest entry per run, kind and key of this experiment."""
        log = self.spark.read.schema(SCHEMA).parquet(self.path).filter(F.col("experiment") == self.experiment)
        return log.groupBy("run_id", "kind", "key").agg(F.max_by("value", "logged_at").alias("value"))

    def runs(self, params: tuple[str, ...] = (), metrics: tuple[str, ...] = ()) -> DataFrame:
        """One row per run with the named parameters (text) and metrics (numbers)."""

        def last(kind: str, key: str):
            return F.max(F.when((F.col("kind") == kind) & (F.col("key") == key), F.col("value")))

        return self.entries().groupBy("run_id").agg(
            *[last("param", p).alias(p) for p in params],
            *[last("metric", m).cast("double").alias(m) for m in metrics],
            F.coalesce(last("status", "ended") == "true", F.lit(False)).alias("ended"),
        )

    def best(self, metric: str) -> DataFrame:
        """The run with the largest value of a metric; the first by name on a tie."""
        return self.runs(metrics=(metric,)).orderBy(F.desc(metric), "run_id").limit(1)
