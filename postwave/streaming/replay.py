"""Replay helpers: run a streaming job over records written as files.

Used by tests and by the stream-parity queries: records derived from the
input tables are written to the shared folder, a streaming query consumes
them, and a control record far in the future advances the event-time
watermark so append-mode windows are emitted (a live job gets the same from
new data or a heartbeat).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sinks.writers import RECORD_FILES

# Fixed value: control record that closes every real window, filtered out of
# results by its window start.
FLUSH_CREATED_AT = "2100-01-01T00:00:00+00:00"
FLUSH_RECORD = '{"id": null, "created_at": "%s"}' % FLUSH_CREATED_AT
FLUSH_BEFORE = "2099-01-01"


def write_replay(df: DataFrame, path: str, value_col: str = "value") -> None:
    """Records as text lines (one JSON value per line)."""
    df.select(value_col).write.mode("append").options(**RECORD_FILES).text(path)


def flush(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(FLUSH_RECORD,)], "value string").write.mode("append").text(path)


def drain(q: StreamingQuery, spark: SparkSession | None = None, path: str | None = None,
          flushes: int = 0) -> None:
    """Process everything available; optionally append flush records, one per
    round, so watermark-driven windows are emitted; then stop."""
    try:
        q.processAllAvailable()
        for _ in range(flushes):
            flush(spark, path)
            q.processAllAvailable()
    finally:
        q.stop()
    if q.exception() is not None:
        raise q.exception()
