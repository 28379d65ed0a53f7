"""Analyzer objects with the method names of the original jobs.

``StreamAnalyzer`` runs the record pipelines (engagement, language filter,
hashtags, full fan-out); ``SQLAnalyzer`` runs the windowed analyses and
custom queries. Each method starts one Structured Streaming query and
returns its ``StreamingQuery``. The work is done by the library's DataFrame
functions, so every method has a batch twin that the oracle checks.

Sources: Kafka (``source="kafka"``, needs the connector package) or a folder
of JSON-lines files (``source="files"``). Sinks: Kafka topics named as in the
original jobs, folders under ``output_root`` named after those topics
(``"json"`` / ``"parquet"``), or the console (``console_rows`` rows of each
batch). Checkpoints go under ``checkpoint_root``, by default a folder below
``output_root``, else one in the shared ``spark.checkpoint.dir`` named after
the input: the same on every start, so a job that is started again goes on
where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.parse import source_table
from ..plans.sql import custom_sql, default_output_mode
from ..schemas import (COUNTS_SINK, DASHBOARD_SINK, TOPIC_COUNTS, TOPIC_DASHBOARD, TOPIC_ENGAGEMENT, TOPIC_FILTERED,
                       TOPIC_HASHTAGS, TOPIC_POSTS)
from ..session import ensure_checkpoint_dir
from ..sources.kafka import read_replay, read_topic
from .changelog import changelog_job
from .heartbeat import heartbeat
from .keyed import checkpoint_name
from .jobs import (engagement_job, filter_job, full_pipeline_job, hashtag_job, window_stream,
                   write_stream)
from .timers import timed_windows


# outputs that are declared tables
DECLARED = {TOPIC_DASHBOARD: DASHBOARD_SINK, TOPIC_COUNTS: COUNTS_SINK}


class _Analyzer:
    default_offsets = "earliest"

    def __init__(self, spark: SparkSession, *, bootstrap_servers: str = "localhost:9092",
                 input_topic: str = TOPIC_POSTS, group_id: str | None = None,
                 source: str = "kafka", input_path: str | None = None,
                 starting_offsets: str | None = None, max_files_per_trigger: int | None = 1000,
                 sink: str | None = None, output_root: str | None = None,
                 checkpoint_root: str | None = None, trigger: dict | None = None,
                 console_rows: int | None = None, max_offsets_per_trigger: int = 5_000_000):
        if source not in ("kafka", "files"):
            raise ValueError(f"source must be 'kafka' or 'files', not {source!r}")
        if source == "files" and not input_path:
            raise ValueError("source='files' needs input_path")
        if sink in ("json", "parquet") and not output_root:
            raise ValueError(f"sink={sink!r} needs output_root")
        self.spark = spark
        self.bootstrap_servers = bootstrap_servers
        self.input_topic = input_topic
        self.group_id = group_id
        self.source = source
        self.input_path = input_path
        self.starting_offsets = starting_offsets or self.default_offsets
        self.max_files_per_trigger = max_files_per_trigger
        self.sink = sink
        self.output_root = output_root
        self.checkpoint_root = checkpoint_root or self._fixed_checkpoint()
        self.trigger = trigger
        self.console_rows = console_rows
        self.max_offsets_per_trigger = max_offsets_per_trigger

    def _fixed_checkpoint(self) -> str:
        if self.output_root:
            return f"{self.output_root.rstrip('/')}/_checkpoints"
        read = self.input_path if self.source == "files" else f"{self.bootstrap_servers}/{self.input_topic}"
        base = ensure_checkpoint_dir(self.spark).rstrip("/")
        return f"{base}/postwave/{type(self).__name__}-{checkpoint_name(read)}"

    def _raw(self) -> DataFrame:
        if self.source == "kafka":
            return read_topic(self.spark, self.input_topic, self.bootstrap_servers,
                              self.starting_offsets, group_id=self.group_id,
                              max_offsets_per_trigger=self.max_offsets_per_trigger)
        return read_replay(self.spark, self.input_path,
                           max_files_per_trigger=self.max_files_per_trigger)

    def _fmt(self, original: str) -> str:
        return self.sink or original

    def _target(self, fmt: str, name: str) -> dict:
        if fmt == "kafka":
            return {"topic": name, "bootstrap": self.bootstrap_servers}
        if fmt in ("json", "parquet"):
            if not self.output_root:
                raise ValueError(f"the {fmt} output {name} needs output_root")
            return {"path": f"{self.output_root.rstrip('/')}/{name}"}
        return {"rows": self.console_rows}

    def _start(self, df: DataFrame, original_fmt: str, name: str, output_mode: str = "append",
               schema: StructType | None = None) -> StreamingQuery:
        fmt = self._fmt(original_fmt)
        return write_stream(df, fmt, f"{self.checkpoint_root}/{name}", output_mode=output_mode,
                            trigger=self.trigger, schema=schema, **self._target(fmt, name))


class StreamAnalyzer(_Analyzer):
    """Record pipelines; by default every output goes to its Kafka topic."""

    def analyze_engagement(self) -> StreamingQuery:
        fmt = self._fmt("kafka")
        return engagement_job(self._raw(), fmt, f"{self.checkpoint_root}/{TOPIC_ENGAGEMENT}",
                              trigger=self.trigger, **self._target(fmt, TOPIC_ENGAGEMENT))

    def filter_by_language(self, languages: list[str] | None = None) -> StreamingQuery:
        fmt = self._fmt("kafka")
        return filter_job(self._raw(), fmt, f"{self.checkpoint_root}/{TOPIC_FILTERED}",
                          languages=languages, trigger=self.trigger,
                          **self._target(fmt, TOPIC_FILTERED))

    def extract_hashtags(self) -> StreamingQuery:
        fmt = self._fmt("kafka")
        return hashtag_job(self._raw(), fmt, f"{self.checkpoint_root}/{TOPIC_HASHTAGS}",
                           trigger=self.trigger, **self._target(fmt, TOPIC_HASHTAGS))

    def run_full_pipeline(self) -> StreamingQuery:
        """One parse per micro-batch, engagement and hashtag outputs."""
        fmt = self._fmt("kafka")
        return full_pipeline_job(
            self._raw(), f"{self.checkpoint_root}/full",
            {"fmt": fmt, **self._target(fmt, TOPIC_ENGAGEMENT)},
            {"fmt": fmt, **self._target(fmt, TOPIC_HASHTAGS)}, trigger=self.trigger)


class SQLAnalyzer(_Analyzer):
    """Windowed analyses over the declared post table.

    ``time="processing"`` windows on the arrival clock (with ``heartbeat``,
    or by ``timers``, windows also close while the source is silent); ``time="event"`` windows
    on ``created_at`` behind a watermark of ``delay``. By default the three
    statistics and custom queries go to Parquet folders under ``output_root``
    (the original jobs print them; a printed table holds only the rows it is
    asked for), and the dashboard and count outputs to their Kafka topics. The
    heartbeat is on unless a trigger ends the job by itself.
    """

    default_offsets = "latest"

    def __init__(self, spark: SparkSession, *, time: str = "processing",
                 delay: str = "0 seconds", heartbeat: bool | None = None, timers: bool = False, **kw):
        super().__init__(spark, **kw)
        if time not in ("processing", "event"):
            raise ValueError(f"time must be 'processing' or 'event', not {time!r}")
        self.time = time
        self.delay = delay
        ends = {"availableNow", "once"} & set(self.trigger or ())
        self.heartbeat = not ends if heartbeat is None else heartbeat
        if timers and ends:
            raise ValueError("timers are due later: they need a job that goes on, not one that ends by itself")
        self.timers = timers

    def _window(self, analysis: str, window_minutes: int | None, original_fmt: str,
                name: str) -> StreamingQuery:
        if self.timers and self.time == "processing":
            return self._start(timed_windows(self._raw(), analysis, window_minutes), original_fmt, name,
                               schema=DECLARED.get(name))
        hb = None
        if self.heartbeat and self.time == "processing":
            hb = heartbeat(self.spark, "proc_time")
        out = window_stream(self._raw(), analysis, time=self.time, window_minutes=window_minutes,
                            delay=self.delay, heartbeat=hb)
        return self._start(out, original_fmt, name, schema=DECLARED.get(name))

    def analyze_language_distribution(self, window_minutes: int = 5) -> StreamingQuery:
        return self._window("language", window_minutes, "parquet", "language_stats")

    def analyze_top_users(self, window_minutes: int = 10) -> StreamingQuery:
        return self._window("users", window_minutes, "parquet", "top_users")

    def analyze_engagement_metrics(self, window_minutes: int = 5) -> StreamingQuery:
        return self._window("engagement", window_minutes, "parquet", "engagement_metrics")

    def real_time_dashboard_query(self) -> StreamingQuery:
        return self._window("dashboard", None, "kafka", TOPIC_DASHBOARD)

    def simple_count_analysis(self) -> StreamingQuery:
        return self._window("count", None, "kafka", TOPIC_COUNTS)

    def custom_sql_changes(self, query: str, key: list[str] | None = None) -> StreamingQuery:
        """The changes of any SELECT's answer, with their kind, under
        ``output_root``; ``changelog.read_changes`` reads them."""
        if not self.output_root:
            raise ValueError("the changes of a query need output_root")
        posts = source_table(self._raw(), with_proc_time=(self.time == "processing"))
        return changelog_job(custom_sql(self.spark, query, posts), f"{self.output_root.rstrip('/')}/custom_changes",
                             f"{self.checkpoint_root}/custom_changes", key=key, trigger=self.trigger)

    def custom_sql_query(self, query: str) -> StreamingQuery:
        """Any SELECT over ``mastodon_posts``. Aggregating queries stream in
        update mode to topics and the console. Files only take final rows, so
        there the table has a watermark of ``delay`` on its time column, and
        aggregates by window or session are written once they are final."""
        posts = source_table(self._raw(), with_proc_time=(self.time == "processing"))
        aggregates = default_output_mode(custom_sql(self.spark, query, posts)) == "update"
        if aggregates and self._fmt("parquet") in ("json", "parquet"):
            posts = posts.withWatermark("proc_time" if self.time == "processing" else "event_time", self.delay)
            return self._start(custom_sql(self.spark, query, posts), "parquet", "custom")
        out = custom_sql(self.spark, query, posts)
        return self._start(out, "parquet", "custom", output_mode=default_output_mode(out))
