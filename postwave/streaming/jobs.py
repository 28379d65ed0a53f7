"""Structured Streaming jobs: the pipelines with sources and sinks attached.

Every job is ``readStream`` -> the same DataFrame functions the batch path
uses -> ``writeStream`` with a checkpoint location (offsets, state and sink
commits live there, so a restarted or re-tried job resumes exactly where it
stopped and executor loss only re-runs tasks).

* J1/J2/J3: one transform chain, one sink.
* J4: parse once per micro-batch inside ``foreachBatch``, persist the parsed
  batch and write both branches (two ``writeStream``s would read and parse
  the source twice).
* J5: raw archive of the records' own text with the exactly-once file sink.
* J6: multi-topic index job: route by topic, append each batch to a keyed
  log (``streaming.keyed``) whose read view keeps the latest version.
* Windowed SQL analyses (A1-A5) on processing time or event time with a
  watermark, in append mode, optionally kept moving by a heartbeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.parse import Decoder, accepted, is_record, parse_posts, record, refused, source_table, split_records
from ..operators import windows as W
from ..operators.transforms import engagement_score, extract_hashtags, scored_view
from ..plans.pipelines import engagement_pipeline, filtered_pipeline, hashtag_pipeline
from ..sinks.writers import JSON_OPTS, RECORD_FILES, kafka_value_frame, typed_frame
from .keyed import META, checkpoint_name, each_batch_once, part_name, write_split

WINDOW_ANALYSES: dict[str, Callable[..., DataFrame]] = {
    "language": W.language_distribution,
    "users": W.top_users,
    "engagement": W.engagement_metrics,
    "dashboard": W.dashboard_volume,
    "count": W.simple_count,
}


def write_stream(df: DataFrame, fmt: str, checkpoint: str, *, path: str | None = None,
                 topic: str | None = None, bootstrap: str | None = None,
                 output_mode: str = "append", trigger: dict | None = None,
                 query_name: str | None = None, rows: int | None = None,
                 schema: StructType | None = None, options: dict | None = None) -> StreamingQuery:
    """Attach a sink. ``fmt``: kafka | json | parquet | text | memory | console.
    With ``schema`` the sink is a declared table: other columns or types are
    refused before the job starts. ``options`` go to a file sink's writer.
    The console shows ``rows`` rows of each batch, which must be named: it is
    the one sink that does not hold every row."""
    if fmt == "console" and not rows:
        raise ValueError("the console sink needs rows, the number of rows it shows of each batch")
    out = df = df if schema is None else typed_frame(df, schema)
    if fmt == "kafka":
        out = kafka_value_frame(df)
    w = out.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "kafka":
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        return w.start()
    if fmt in ("json", "parquet", "text"):
        if not path:
            raise ValueError(f"the {fmt} sink needs a path")
        w = w.format(fmt)
        if fmt == "json":
            w = w.option("ignoreNullFields", "false")
        return w.options(**(options or {})).start(path)
    if fmt == "console":
        w = w.option("numRows", str(rows)).option("truncate", "false")
    return w.format(fmt).start()


def engagement_job(raw: DataFrame, fmt: str, checkpoint: str, **sink) -> StreamingQuery:
    """J1: parse -> score -> sink (default topic ``mastodon-engagement``)."""
    return write_stream(engagement_pipeline(raw), fmt, checkpoint, **sink)


def filter_job(raw: DataFrame, fmt: str, checkpoint: str, languages=None, **sink) -> StreamingQuery:
    """J2: parse -> language filter -> sink."""
    return write_stream(filtered_pipeline(raw, languages), fmt, checkpoint, **sink)


def hashtag_job(raw: DataFrame, fmt: str, checkpoint: str, **sink) -> StreamingQuery:
    """J3: hashtag records straight from the raw records -> sink."""
    return write_stream(hashtag_pipeline(raw), fmt, checkpoint, **sink)


def _write_batch(df: DataFrame, fmt: str, part: str, path: str | None = None,
                 topic: str | None = None, bootstrap: str | None = None, rows: int | None = None) -> None:
    """Idempotent per-batch write: a retried batch overwrites its own folder.
    Topics and the console get a retried batch again."""
    if fmt == "kafka":
        (kafka_value_frame(df).write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
    elif fmt == "json":
        df.write.mode("overwrite").options(**JSON_OPTS).json(f"{path}/part={part}")
    elif fmt == "console":
        df.show(rows, truncate=False)
    else:
        df.write.mode("overwrite").parquet(f"{path}/part={part}")


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Mark ``path`` as written under ``checkpoint``. A job that appends would
    repeat records there under another one, so that is refused."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mine = f"_written_under-{checkpoint_name(checkpoint)}"
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("_written_under-") and name != mine:
                raise ValueError(f"{path} was written under another checkpoint than {checkpoint}; "
                                 "go on with that one or choose another folder")
    fs.mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{mine}"))


def full_pipeline_job(raw: DataFrame, checkpoint: str, engagement_sink: dict,
                      hashtag_sink: dict, trigger: dict | None = None) -> StreamingQuery:
    """J4: one parse per micro-batch, two outputs. A restart with the same
    checkpoint goes on where the job stopped; folders written under another
    checkpoint are refused."""
    for sink in (engagement_sink, hashtag_sink):
        if sink["fmt"] == "console" and not sink.get("rows"):
            raise ValueError("the console sink needs rows, the number of rows it shows of each batch")
        if sink["fmt"] == "kafka" and not (sink.get("topic") and sink.get("bootstrap")):
            raise ValueError("the kafka sink needs a topic and bootstrap servers")
        if sink["fmt"] in ("json", "parquet"):
            if not sink.get("path"):
                raise ValueError(f"the {sink['fmt']} sink needs a path")
            claim(raw.sparkSession, sink["path"], checkpoint)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        part = part_name(checkpoint, batch_id)
        parsed = parse_posts(batch).persist()
        try:
            _write_batch(scored_view(engagement_score(parsed)), part=part, **engagement_sink)
            _write_batch(extract_hashtags(parsed), part=part, **hashtag_sink)
        finally:
            parsed.unpersist()
    w = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def decode_job(raw: DataFrame, decoder: Decoder, root: str, checkpoint: str,
               trigger: dict | None = None, value_col: str = "value") -> StreamingQuery:
    """Decodes every record once and writes both sides of it: decoded rows as
    the table ``decoded`` (``keyed.read_rows``) and refused records with their
    reason as its rejects (``keyed.read_rejects``), each batch as one change."""
    def job(batch: DataFrame, state: dict, part: str) -> dict:
        spark, before = batch.sparkSession, state["tables"].get("decoded")
        meta = [c for c in META if c in batch.columns]
        split = split_records(batch, decoder, value_col, keep=meta).persist()
        try:
            return {"tables": {"decoded": write_split(spark, root, part, "decoded", accepted(split, meta), refused(split),
                                                      None, before)}}
        finally:
            split.unpersist()
    return each_batch_once(raw, root, checkpoint, job, trigger)


def archive_job(raw: DataFrame, path: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """J5: append every raw record that is one JSON object to a JSON-lines
    archive, as it came: unknown and ill-typed fields, missing and null keys
    stay what they were. Line breaks between its tokens become blanks, so that
    a record is one line (exactly-once file sink, gzipped files; the archive
    re-reads with ``sinks.writers.read_jsonl``)."""
    recs = raw.where(is_record(record(F.col("value")))).select(
        F.regexp_replace("value", "[\\r\\n]+", " ").alias("value"))
    return write_stream(recs, "text", checkpoint, path=path, trigger=trigger, options=RECORD_FILES)


def run_with_callback(raw: DataFrame, callback: Callable[[DataFrame, int], None],
                      checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Consumer hook: ``callback(batch_df, batch_id)`` per micro-batch of
    decoded posts (the per-message callback, batched)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        callback(source_table(batch, with_proc_time=False), batch_id)
    w = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def window_stream(raw: DataFrame, analysis: str, *, time: str = "processing",
                  window_minutes: int | None = None, delay: str = "0 seconds",
                  heartbeat: DataFrame | None = None,
                  keep_window_end: bool = False) -> DataFrame:
    """Windowed analysis over a raw post stream, ready for append mode.

    ``time="processing"`` stamps ``proc_time`` per micro-batch; ``"event"``
    uses ``created_at``. A heartbeat stream (see ``streaming.heartbeat``)
    keeps the watermark moving on a silent source; its rows reach the
    aggregation (so they advance the watermark) but are not counted, and
    heartbeat-only groups are dropped after it. ``keep_window_end`` adds the
    full window-end timestamp ``_w_end`` to the 10-second counts.
    """
    posts = source_table(raw, with_proc_time=(time == "processing"))
    tcol = "proc_time" if time == "processing" else "event_time"
    kw = {"time_col": tcol}
    if heartbeat is not None:
        posts = posts.withColumn("is_post", F.lit(True)).unionByName(
            heartbeat, allowMissingColumns=True)
        kw["post_flag"] = "is_post"
    posts = posts.withWatermark(tcol, delay)
    fn = WINDOW_ANALYSES[analysis]
    if window_minutes is not None and analysis in ("language", "users", "engagement"):
        kw["window_minutes"] = window_minutes
    if keep_window_end and analysis == "count":
        kw["keep_end"] = "_w_end"
    return fn(posts, **kw)


def observe_ingest(raw: DataFrame, name: str = "ingest", value_col: str = "value") -> DataFrame:
    """Live ingest counters (records / indexed / errors) attached to a stream.

    ``Dataset.observe`` computes them inside the micro-batch (no extra job);
    they arrive in ``StreamingQueryProgress.observedMetrics`` — read them
    with ``IngestListener`` or ``query.lastProgress``.
    """
    staged = raw.withColumn("_w", record(F.col(value_col)))
    ok = F.coalesce(is_record(F.col("_w")), F.lit(False))
    return staged.observe(name, F.count(F.lit(1)).alias("records"),
                          F.count_if(ok).alias("indexed"),
                          F.count_if(~ok).alias("errors")).drop("_w")


class IngestListener:
    """Accumulates observed ingest counters across micro-batches.

    Register with ``spark.streams.addListener(IngestListener.create(name))``.
    """

    @staticmethod
    def create(name: str = "ingest"):
        from pyspark.sql.streaming import StreamingQueryListener

        class _L(StreamingQueryListener):
            totals = {"records": 0, "indexed": 0, "errors": 0}

            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                row = event.progress.observedMetrics.get(name)
                if row is not None:
                    for k in self.totals:
                        self.totals[k] += row[k] or 0

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        return _L()
