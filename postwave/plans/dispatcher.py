"""Job dispatcher and ``spark-submit`` entry point.

``run_analysis`` picks one analysis for a raw post frame (batch or
streaming): ``mode="stream"`` runs the record pipelines, ``mode="sql"`` the
windowed SQL analyses or a custom query. A mode/analysis mismatch or a
custom analysis without a query raises ``ValueError`` (the reference
silently did nothing).

    spark-submit -m postwave.plans.dispatcher --mode sql --analysis language \
        --source files --input /data/posts --output /data/out --checkpoint /ckpt/x

Two more modes run the consumer jobs: ``--mode archive`` appends every raw
post to a JSON-lines archive at ``--output`` (exactly-once file sink), and
``--mode index`` keeps the engagement and hashtag topics (``--topics``) as
keyed tables under ``--output`` where the latest version of a post wins
(``--compact-every N`` folds the log into snapshots). With the files source,
index input is JSON lines of Kafka-shaped records (``topic``, ``value``,
``seq``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..functions.parse import register_source_table
from ..schemas import (ENGAGEMENT_TABLE, HASHTAG_TABLE, TOPIC_ENGAGEMENT, TOPIC_HASHTAGS,
                       TOPIC_POSTS)
from . import pipelines
from .sql import custom_sql

# ``language`` is another name of ``filter``
STREAM_ANALYSES = ("engagement", "filter", "language", "hashtags", "full")
# index topics: short name -> (topic, table schema, table name, document key)
INDEX_TOPICS = {
    "engagement": (TOPIC_ENGAGEMENT, ENGAGEMENT_TABLE, "engagement", "id"),
    "hashtags": (TOPIC_HASHTAGS, HASHTAG_TABLE, "hashtags", "post_id"),
}
SQL_ANALYSES = ("language", "users", "engagement", "dashboard", "count", "custom")


def run_analysis(spark: SparkSession, raw: DataFrame, mode: str, analysis: str, *,
                 window: int = 5, languages: list[str] | None = None,
                 query: str | None = None, time: str = "processing",
                 delay: str = "0 seconds", heartbeat: bool = False,
                 timers: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Return the result frame(s) of one analysis over ``raw`` (``value``).
    On a stream over processing time, windows close by ``timers`` or, with
    ``heartbeat``, by a clock of its own rows."""
    if mode == "stream":
        if analysis not in STREAM_ANALYSES:
            raise ValueError(f"analysis {analysis!r} is not a stream analysis {STREAM_ANALYSES}")
        if analysis == "engagement":
            return pipelines.engagement_pipeline(raw)
        if analysis in ("filter", "language"):
            return pipelines.filtered_pipeline(raw, languages)
        if analysis == "hashtags":
            return pipelines.hashtag_pipeline(raw)
        return pipelines.full_pipeline(raw)
    if mode == "sql":
        if analysis not in SQL_ANALYSES:
            raise ValueError(f"analysis {analysis!r} is not a SQL analysis {SQL_ANALYSES}")
        if analysis == "custom":
            if not query:
                raise ValueError("custom analysis needs a query")
            register_source_table(raw)
            return custom_sql(spark, query)
        from ..streaming.jobs import window_stream
        if raw.isStreaming and timers and time == "processing":
            from ..streaming.timers import timed_windows
            return timed_windows(raw, analysis, window)
        if raw.isStreaming:
            from ..streaming.heartbeat import heartbeat as beat
            clock = beat(spark, "proc_time") if heartbeat and time == "processing" else None
            return window_stream(raw, analysis, time=time, window_minutes=window, delay=delay,
                                 heartbeat=clock)
        from ..streaming.jobs import WINDOW_ANALYSES
        from ..functions.parse import source_table
        posts = source_table(raw, with_proc_time=(time == "processing"))
        tcol = "proc_time" if time == "processing" else "event_time"
        kw = {"time_col": tcol}
        if analysis in ("language", "users", "engagement"):
            kw["window_minutes"] = window
        return WINDOW_ANALYSES[analysis](posts, **kw)
    raise ValueError(f"mode must be 'stream' or 'sql', not {mode!r}")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="post stream analytics on Spark")
    p.add_argument("--mode", choices=["stream", "sql", "archive", "index"], required=True)
    p.add_argument("--analysis", help="required for --mode stream / sql")
    p.add_argument("--topics", nargs="+", choices=sorted(INDEX_TOPICS), default=sorted(INDEX_TOPICS),
                   help="topics kept by --mode index")
    p.add_argument("--compact-every", type=int, default=None,
                   help="--mode index: fold the log into a snapshot every N batches")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--bootstrap-servers", default="localhost:9092")
    p.add_argument("--input-topic", default=TOPIC_POSTS)
    p.add_argument("--input", help="folder of JSON-lines files (files source)")
    p.add_argument("--starting-offsets", default=None)
    p.add_argument("--window", type=int, default=5)
    p.add_argument("--languages", nargs="*", default=None)
    p.add_argument("--query", default=None)
    p.add_argument("--time", choices=["processing", "event"], default="processing")
    p.add_argument("--delay", default="0 seconds")
    p.add_argument("--max-offsets-per-trigger", type=int, default=5_000_000,
                   help="records taken from Kafka per micro-batch")
    p.add_argument("--max-files-per-trigger", type=int, default=1000,
                   help="files taken per micro-batch (files source)")
    p.add_argument("--no-heartbeat", action="store_true",
                   help="let processing-time windows wait for the next post to close")
    p.add_argument("--timers", action="store_true",
                   help="close processing-time windows by timers instead of heartbeat rows")
    p.add_argument("--changes", action="store_true",
                   help="--analysis custom: write the changes of the answer (+I, -U, +U, -D) under --output")
    p.add_argument("--account-late", action="store_true",
                   help="windowed analyses over event time: write windows and late rows with a reason under --output")
    p.add_argument("--sink", choices=["kafka", "json", "parquet", "console"], default="parquet")
    p.add_argument("--console-rows", type=int, default=None,
                   help="rows shown of each batch; required for the console sink")
    p.add_argument("--output", help="topic (kafka) or folder (json/parquet)")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--available-now", action="store_true",
                   help="process what is available, then stop (scheduled runs)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    from ..session import get_session
    from ..sources.kafka import read_replay, read_topic
    from ..streaming.jobs import full_pipeline_job, write_stream
    args = _parser().parse_args(argv)
    spark = spark or get_session()
    trigger = {"availableNow": True} if args.available_now else None
    if args.mode in ("archive", "index"):
        _consumer(spark, args, trigger).awaitTermination()
        return
    if not args.analysis:
        raise ValueError(f"--mode {args.mode} needs --analysis")
    if args.source == "kafka":
        start = args.starting_offsets or ("earliest" if args.mode == "stream" else "latest")
        raw = read_topic(spark, args.input_topic, args.bootstrap_servers, start,
                         max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        raw = read_replay(spark, args.input, max_files_per_trigger=args.max_files_per_trigger)
    if args.timers and args.available_now:
        raise ValueError("--timers needs a job that goes on, not --available-now")
    if args.sink == "console" and not args.console_rows:
        raise ValueError("--sink console needs --console-rows")
    if args.mode == "stream" and args.analysis == "full":
        full_pipeline_job(raw, args.checkpoint, *_full_sinks(args), trigger=trigger).awaitTermination()
        return
    if (args.sink != "console" or args.changes or args.account_late) and not args.output:
        raise ValueError(f"--sink {args.sink} needs --output")
    if args.account_late:
        _accounted(spark, raw, args, trigger).awaitTermination()
        return
    out = run_analysis(spark, raw, args.mode, args.analysis, window=args.window,
                       languages=args.languages, query=args.query, time=args.time,
                       delay=args.delay,
                       heartbeat=not (args.no_heartbeat or args.available_now), timers=args.timers)
    if args.changes:
        if args.analysis != "custom":
            raise ValueError("--changes needs --analysis custom")
        from ..streaming.changelog import changelog_job
        changelog_job(out, args.output, args.checkpoint, trigger=trigger).awaitTermination()
        return
    sink = {"bootstrap": args.bootstrap_servers, "trigger": trigger}
    if args.sink == "kafka":
        sink["topic"] = args.output
    elif args.sink in ("json", "parquet"):
        sink["path"] = args.output
    else:
        sink["rows"] = args.console_rows
    mode = "append"
    if args.analysis == "custom":
        from .sql import default_output_mode
        mode = default_output_mode(out)
    write_stream(out, args.sink, args.checkpoint, output_mode=mode, **sink).awaitTermination()


def _accounted(spark: SparkSession, raw: DataFrame, args, trigger: dict | None):
    """A windowed analysis that sets late rows aside (``streaming.late``)."""
    from ..streaming.late import accounted_windows_job
    if args.mode != "sql" or args.analysis == "custom" or args.time != "event":
        raise ValueError("--account-late needs --mode sql, a windowed analysis and --time event")
    seconds = spark.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {args.delay}) / 1000").first()[0]
    return accounted_windows_job(raw, args.analysis, args.output, args.checkpoint, window_minutes=args.window,
                                 delay_seconds=float(seconds), trigger=trigger)


def _full_sinks(args) -> tuple[dict, dict]:
    """The two outputs of the full pipeline: its topics, two folders under
    ``--output``, or the console."""
    if args.sink == "kafka":
        return tuple({"fmt": "kafka", "topic": t, "bootstrap": args.bootstrap_servers}
                     for t in (TOPIC_ENGAGEMENT, TOPIC_HASHTAGS))
    if args.sink == "console":
        return ({"fmt": "console", "rows": args.console_rows},) * 2
    if not args.output:
        raise ValueError(f"--sink {args.sink} needs --output")
    return tuple({"fmt": args.sink, "path": f"{args.output}/{n}"} for n in ("engagement", "hashtags"))


def _consumer(spark: SparkSession, args, trigger: dict | None):
    """The archive (raw posts -> JSON lines) and index (result topics ->
    keyed tables) jobs. Consumers start from the latest offsets."""
    from ..sources.kafka import read_replay, read_topic
    from ..streaming.jobs import archive_job
    from ..streaming.keyed import upsert_job
    if not args.output:
        raise ValueError(f"--mode {args.mode} needs --output")
    start = args.starting_offsets or "latest"
    if args.mode == "archive":
        raw = (read_topic(spark, args.input_topic, args.bootstrap_servers, start,
                          max_offsets_per_trigger=args.max_offsets_per_trigger)
               if args.source == "kafka" else
               read_replay(spark, args.input, max_files_per_trigger=args.max_files_per_trigger))
        return archive_job(raw, args.output, args.checkpoint, trigger=trigger)
    chosen = [INDEX_TOPICS[t] for t in args.topics]
    if args.source == "kafka":
        raw = read_topic(spark, [t[0] for t in chosen], args.bootstrap_servers, start,
                         max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        raw = (spark.readStream.schema("topic string, value string, seq bigint")
               .option("maxFilesPerTrigger", str(args.max_files_per_trigger)).json(args.input))
    return upsert_job(raw, args.output, args.checkpoint,
                      {topic: (schema, name, key) for topic, schema, name, key in chosen},
                      trigger=trigger, compact_every=args.compact_every)


if __name__ == "__main__":
    main()
