"""Posts that are asked for again and again: pages since the last id, each post
once, and the most used tags of every closed window.

``poll`` reads one page of a status table as a poller does, and remembers how far
it came in the manifest, together with the page. ``each_post_once`` drops posts
that overlapping polls bring again, by id, with state that ends after a while.
``trending_job`` chains two steps: Spark's windowed counts, which append mode
writes once a window is final, and the k best of each such window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import field, is_record, record, source_table
from ..sources.incremental import incremental_since
from .keyed import each_batch_once, read_rows, write_part
from .manifest import ManifestLog


def poll(spark: SparkSession, statuses: DataFrame, root: str, tag: str = "news",
         first_limit: int = 20, limit: int = 40) -> int:
    """Takes the newest posts with ``tag`` above the last id taken before (up to
    ``first_limit`` the first time, ``limit`` later) as one page under ``root``;
    returns the number of posts. The page and its last id are one committed
    change, so a poller that starts again neither loses nor repeats a page."""
    log = ManifestLog(spark, root)
    state = log.state()
    page = incremental_since(statuses, state["marks"].get("last_id"), tag, first_limit, limit)
    number = state["marks"].get("page", -1) + 1
    rows = page.withColumn("page", F.lit(number).cast("bigint"))
    told = write_part(spark, root, "pages", f"page-{number:012d}", rows, None, state["tables"].get("pages"))
    n = sum(f["rows"] for f in told["add"])
    if n:
        last = _last_id(spark, root, told)
        # of two pollers at the same place the second takes nothing
        log.commit(lambda s: {"tables": {"pages": told}, "marks": {"last_id": last, "page": number}}
                   if s["marks"].get("page", -1) + 1 == number else None)
    return n


def _last_id(spark: SparkSession, root: str, told: dict) -> str:
    rows = spark.read.parquet(*[f"{root}/{f['path']}" for f in told["add"]])
    return rows.agg(F.max_by("id", F.col("id").try_cast("decimal(38,0)"))).first()[0]


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """The posts of all pages, with ``page`` and ``poll_rank`` in it."""
    return read_rows(spark, root, "pages")


def each_post_once(raw: DataFrame, keep_seconds: int = 86_400, time_col: str = "polled_at",
                   value_col: str = "value") -> DataFrame:
    """The records of ``raw`` without those whose post id came before, as polls
    that overlap bring them. The first one stays, whatever the versions hold;
    last-write-wins is for keyed tables. An id is forgotten ``keep_seconds``
    after it was seen, by ``time_col``, the time of the poll. A record without
    an id, or that is no post, goes only if all columns of another are the same."""
    keep = raw.columns
    w = record(F.col(value_col))
    named = raw.withColumn("_w", w).select(*keep, F.when(is_record(F.col("_w")), field(F.col("_w"), "$.id", "string")).alias("_id"))
    whole = F.sha2(F.to_json(F.struct(*keep), {"ignoreNullFields": "false"}), 256)
    named = named.withColumn("_key", F.coalesce(F.concat(F.lit("i"), "_id"), F.concat(F.lit("w"), whole)))
    if raw.isStreaming:
        named = named.withWatermark(time_col, f"{keep_seconds} seconds").dropDuplicatesWithinWatermark(["_key"])
    else:
        named = named.dropDuplicates(["_key"])
    return named.select(*keep)


def trending_job(raw: DataFrame, root: str, checkpoint: str, *, window_minutes: int = 60, k: int = 3,
                 delay: str = "0 seconds", trigger: dict | None = None) -> StreamingQuery:
    """The ``k`` most used tags of every window, once the window is final; read
    them with ``read_trending``. All counts of a window leave the aggregation
    in the batch in which the watermark passes its end, so the ranking needs no
    state of its own, and keeps k rows a task before it shuffles."""
    posts = source_table(raw, with_proc_time=False).withWatermark("event_time", delay)
    # posts without tags move the watermark on too, and are left out after it
    counts = (posts.select("event_time", F.explode_outer("tags").alias("tag"))
              .groupBy(F.window("event_time", f"{window_minutes} minutes").alias("w"), "tag")
              .agg(F.count("tag").alias("tag_count")).where("tag_count > 0"))

    def job(batch: DataFrame, state: dict, part: str) -> dict:
        best = Window.partitionBy("w").orderBy(F.desc("tag_count"), F.asc("tag"))
        rows = (batch.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "tag", "tag_count", "rank"))
        return {"tables": {"trending": write_part(batch.sparkSession, root, "trending", part, rows, None,
                                                  state["tables"].get("trending"))}}

    return each_batch_once(counts, root, checkpoint, job, trigger)


def read_trending(spark: SparkSession, root: str) -> DataFrame:
    return read_rows(spark, root, "trending")
