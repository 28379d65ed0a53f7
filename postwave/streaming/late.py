"""Windowed analyses that account for every row: counted, or late with a reason.

Spark's own windowed streams drop rows behind the watermark without a trace.
Here each micro-batch is split by the watermark as it stood before the batch
(the latest event time seen, less the allowed delay, kept in the manifest):

* rows of windows that are closed already, or without a time, go to the side
  table ``late`` with a reason and their window;
* the others wait in the table ``open``, as the few columns that the analyses
  read; the windows that the batch's own rows close are then analysed, by the
  same functions as in batch, and added to ``windows``.

The three tables and the new watermark are one committed change, so every row is
counted or told as late exactly once across failures and restarts. A file of
``open`` is named with its range of window ends: closing windows opens only files
that reach into them, and files that were used up are retired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import source_table
from ..operators import windows as W
from .keyed import _read, each_batch_once, read_rows, retire, write_part
from .manifest import ManifestLog

# Reasons, and window sizes of the analyses that have one of their own.
BEHIND, NO_TIME = "behind_watermark", "no_event_time"
OWN_SIZE = {"dashboard": "1 minute", "count": "10 seconds"}
DEFAULT_MINUTES = {"language": 5, "users": 10, "engagement": 5}
READ = ("account", "language", "favourites_count", "reblogs_count")


def _analysis(name: str, minutes: int | None):
    """The batch function of an analysis, and its window size."""
    if name in OWN_SIZE:
        fn = {"dashboard": W.dashboard_volume, "count": lambda p, t: W.simple_count(p, t, keep_end="window_end_at")}[name]
        return fn, OWN_SIZE[name]
    minutes = minutes or DEFAULT_MINUTES[name]
    fn = {"language": W.language_distribution, "users": W.top_users, "engagement": W.engagement_metrics}[name]
    return lambda p, t: fn(p, t, minutes), f"{minutes} minutes"


def _micros(c: Column) -> Column:
    return F.unix_micros(c)


def _closed(spark: SparkSession, root: str, open_files: list[dict], schema, after: int | None,
            upto: int) -> DataFrame | None:
    """Waiting rows of the windows that end in (after, upto]; None without a
    file that reaches into them."""
    found = [f for f in open_files if f["low"] <= upto]
    if not found:
        return None
    end = F.col("window_end_us")
    return _read(spark, root, found, schema).where(
        (end <= upto) & (end > after if after is not None else F.lit(True)))


def accounted_windows_job(raw: DataFrame, analysis: str, root: str, checkpoint: str, *,
                          window_minutes: int | None = None, delay_seconds: float = 0,
                          trigger: dict | None = None, value_col: str = "value") -> StreamingQuery:
    """Runs ``analysis`` (``language``, ``users``, ``engagement``, ``dashboard``
    or ``count``) over event time; read the results with ``read_windows`` and
    ``read_late``. A window is written once, when the latest event time is its
    end plus ``delay_seconds`` or later."""
    fn, size = _analysis(analysis, window_minutes)
    delay = int(delay_seconds * 1_000_000)

    def job(batch: DataFrame, state: dict, part: str) -> dict:
        spark, tables = batch.sparkSession, state["tables"]
        before = state["marks"].get("closed")
        posts = source_table(batch, value_col, with_proc_time=False).select("id", "event_time", *READ).persist()
        # F.window drops rows without a time; they are told apart
        rows = posts.select("*", F.window("event_time", size).alias("w")).withColumn("window_end_us", _micros(F.col("w.end")))
        timeless = posts.where("event_time is null").select(
            "id", "event_time", F.lit(None).cast("timestamp").alias("window_start"),
            F.lit(None).cast("timestamp").alias("window_end"), F.lit(NO_TIME).alias("reason"))
        try:
            behind = F.col("window_end_us") <= before if before is not None else F.lit(False)
            late = rows.where(behind).select("id", "event_time", F.col("w.start").alias("window_start"),
                                             F.col("w.end").alias("window_end"), F.lit(BEHIND).alias("reason"))
            waiting = rows.where(~behind).select("event_time", *READ, "window_end_us")
            newest = rows.agg(F.max(_micros(F.col("event_time")))).first()[0]
            told = {"late": write_part(spark, root, "late", part, late.unionByName(timeless), None, tables.get("late")),
                    "open": write_part(spark, root, "open", part, waiting, "window_end_us", tables.get("open"))}
        finally:
            posts.unpersist()
        known = [x for x in (newest, state["marks"].get("newest")) if x is not None]
        closed = [max(known) - delay] if known else []
        # never back, also if the delay was shorter before
        marks = {"newest": max(known), "closed": max(closed + [before] * (before is not None))} if known else {}
        return _with_closed(spark, root, part, fn, state, told, before, marks)

    def after(log: ManifestLog, batch_id: int) -> None:
        retire(raw.sparkSession, root, log=log)

    job.after = after
    return each_batch_once(raw, root, checkpoint, job, trigger)


def _with_closed(spark: SparkSession, root: str, part: str, fn, state: dict, told: dict, before: int | None,
                 marks: dict) -> dict:
    """Adds the windows that close now to the change, and drops the files of
    ``open`` that hold nothing else."""
    known = state["tables"].get("open", {"files": []})["files"] + told.get("open", {}).get("add", [])
    schema = told.get("open", state["tables"].get("open"))["schema"]
    upto = marks.get("closed")
    closed = _closed(spark, root, known, schema, before, upto) if upto is not None else None
    if closed is not None:
        told["windows"] = write_part(spark, root, "windows", part, fn(closed, "event_time"), None,
                                     state["tables"].get("windows"))
        told.setdefault("open", {})["drop"] = [f["path"] for f in known if f["high"] <= upto]
    return {"tables": told, "marks": marks}


def finish(spark: SparkSession, root: str, analysis: str, window_minutes: int | None = None) -> None:
    """Closes all windows that still wait, as at the end of a replay."""
    log, (fn, _) = ManifestLog(spark, root), _analysis(analysis, window_minutes)
    state = log.state()
    files = state["tables"].get("open", {"files": []})["files"]
    if files:
        upto = max(f["high"] for f in files)
        change = _with_closed(spark, root, f"finish-{state['version'] + 1:012d}", fn, state, {},
                              state["marks"].get("closed"), {"closed": upto})
        log.commit(lambda s: change)


def read_windows(spark: SparkSession, root: str) -> DataFrame:
    """The analysis of every closed window."""
    return read_rows(spark, root, "windows")


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """id, event_time, window_start, window_end and reason of every row that no
    window counts."""
    return read_rows(spark, root, "late")
