"""Heartbeat rows that keep a watermark moving when the source is silent.

In append mode a window is emitted once the watermark passes its end, and
the watermark only moves when rows arrive. A ``rate`` stream unioned in
before ``withWatermark`` supplies a steady clock; its rows carry
``is_post = false``. They reach the aggregate, so that they move the watermark,
but are not counted there, and groups of heartbeats alone are dropped after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def heartbeat(spark: SparkSession, time_col: str = "proc_time",
              rows_per_second: int = 1) -> DataFrame:
    return (spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
            .select(F.current_timestamp().alias(time_col) if time_col == "proc_time"
                    else F.col("timestamp").alias(time_col),
                    F.lit(False).alias("is_post")))
