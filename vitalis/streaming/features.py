"""Window features over a stream of sensor samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.functions.stats import pearson


def window_features_stream(
    samples: DataFrame, key: Sequence[str], ts: str, x: str, y: str, length: str, watermark: str
) -> DataFrame:
    """Time features per entity and tumbling time window, emitted once the watermark passes the window.

    The state of a window is a handful of running sums and, for the 5th percentile, a count of each
    distinct value. The same function runs
    on a batch frame, where the watermark has no effect.
    """
    bounds = F.window(F.col(ts), length)
    return (
        samples.withWatermark(ts, watermark)
        .groupBy(*key, bounds.alias("w"))
        .agg(
            F.count(x).alias("n"),
            F.avg(x).alias("mean_x"),
            F.stddev_pop(x).alias("std_x"),
            F.percentile(x, 0.05).alias("p05_x"),
            pearson(x, y).alias("corr_xy"),
            (F.var_pop(x) * F.count(x)).alias("energy_x"),
        )
        .select(*key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mean_x", "std_x", "p05_x", "corr_xy", "energy_x")
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that has arrived, append the closed windows to Parquet, and stop."""
    (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
