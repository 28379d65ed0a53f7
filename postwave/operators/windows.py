"""Tumbling-window aggregates over posts (batch and streaming alike).

Every function takes the posts DataFrame (canonical shape: nested ``account``)
and the name of its time column, and returns a DataFrame. The same function
runs in batch (event time) and in Structured Streaming (processing time via
``with_proc_time`` or event time behind a watermark): it only composes
``groupBy(window(...))`` with algebraic aggregates, so Spark plans a partial
(map-side) aggregation before the shuffle and a hot language or user is
combined per input partition before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_proc_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    """Processing-time attribute: one timestamp per micro-batch / query."""
    return df.withColumn(name, F.current_timestamp())


def _tumble(time_col: str, duration: str) -> Column:
    return F.window(F.col(time_col), duration).alias("w")


def _bounds() -> list[Column]:
    return [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]


def _count(flag: str | None) -> Column:
    """Row count; with a heartbeat flag, only rows that are posts."""
    return F.count(F.lit(1)) if flag is None else F.count_if(F.col(flag))


def _drop_empty(df: DataFrame, flag: str | None, count_col: str) -> DataFrame:
    """Heartbeat-only groups are removed after the aggregation (a filter
    before it would be pushed below the watermark and starve it)."""
    return df if flag is None else df.filter(F.col(count_col) > 0)


def sql_engagement() -> Column:
    """Engagement as the SQL jobs compute it: ``favourites + 2 * reblogs``
    (NULL-propagating, replies not counted)."""
    return F.col("favourites_count") + F.col("reblogs_count") * 2


def language_distribution(posts: DataFrame, time_col: str = "proc_time",
                          window_minutes: int = 5, post_flag: str | None = None) -> DataFrame:
    """Posts and engagement per language per window.

    Groups on the raw language and only then maps NULL to ``'unknown'``, so a
    NULL language and a literal ``'unknown'`` give two rows.
    """
    agg = (posts.groupBy(_tumble(time_col, f"{window_minutes} minutes"), F.col("language"))
           .agg(_count(post_flag).alias("post_count"),
                F.sum(sql_engagement()).alias("total_engagement")))
    return (_drop_empty(agg, post_flag, "post_count")
            .select(*_bounds(),
                    F.coalesce(F.col("language"), F.lit("unknown")).alias("language"),
                    "post_count", "total_engagement"))


def top_users(posts: DataFrame, time_col: str = "proc_time",
              window_minutes: int = 10, post_flag: str | None = None) -> DataFrame:
    """Users with more than one post in a window and their mean follower
    count, truncated to an integer. No ranking or limit.

    On a stream (or with a heartbeat flag) the NULL-user test becomes
    ``count(username) > 0`` after the aggregation: a predicate on the
    grouping key would be pushed below the aggregate and the watermark, so
    rows without a user (or heartbeat rows) would stop advancing it and the
    last windows would never close. Batch input is filtered first."""
    user = F.col("account.username")
    followers = F.col("account.followers_count")
    src = posts if (post_flag or posts.isStreaming) else posts.filter(user.isNotNull())
    agg = (src.groupBy(_tumble(time_col, f"{window_minutes} minutes"), user.alias("username"))
           .agg(_count(post_flag).alias("post_count"), F.count(user).alias("_uc"),
                F.sum(followers).alias("_fs"), F.count(followers).alias("_fc"))
           .filter((F.col("post_count") > 1) & (F.col("_uc") > 0)))
    return agg.select(*_bounds(), "username", "post_count",
                      F.when(F.col("_fc") > 0, F.expr("_fs div _fc")).alias("avg_followers"))


def engagement_metrics(posts: DataFrame, time_col: str = "proc_time",
                       window_minutes: int = 5, post_flag: str | None = None) -> DataFrame:
    agg = (posts.groupBy(_tumble(time_col, f"{window_minutes} minutes"))
            .agg(_count(post_flag).alias("total_posts"),
                 F.avg(F.col("favourites_count").cast("double")).alias("avg_favourites"),
                 F.avg(F.col("reblogs_count").cast("double")).alias("avg_reblogs"),
                 F.max(sql_engagement()).alias("max_engagement")))
    return (_drop_empty(agg, post_flag, "total_posts")
            .select(*_bounds(), "total_posts", "avg_favourites", "avg_reblogs",
                    "max_engagement"))


def dashboard_volume(posts: DataFrame, time_col: str = "proc_time",
                     post_flag: str | None = None) -> DataFrame:
    """One-minute post volume as a long-format dashboard metric row."""
    agg = (posts.groupBy(_tumble(time_col, "1 minute"))
           .agg(_count(post_flag).alias("_n")))
    return (_drop_empty(agg, post_flag, "_n")
            .select(*_bounds(), F.lit("volume").alias("metric_type"),
                    F.lit("posts_per_minute").alias("metric_name"),
                    F.col("_n").cast("double").alias("metric_value")))


def simple_count(posts: DataFrame, time_col: str = "proc_time",
                 post_flag: str | None = None, keep_end: str | None = None) -> DataFrame:
    """Ten-second post counts keyed by the window end as ``HH:mm:ss``.
    ``keep_end`` names an extra column with the full window-end timestamp
    (the clock string alone loses the date)."""
    agg = (posts.groupBy(_tumble(time_col, "10 seconds"))
           .agg(_count(post_flag).alias("post_count")))
    extra = [F.col("w.end").alias(keep_end)] if keep_end else []
    return (_drop_empty(agg, post_flag, "post_count")
            .select(F.date_format(F.col("w.end"), "HH:mm:ss").alias("window_end"),
                    "post_count", *extra))


def trending_hashtags(posts: DataFrame, time_col: str = "proc_time",
                      window_minutes: int = 60, k: int = 3) -> DataFrame:
    """Top-k tags per tumbling window (ties broken by tag).

    Counts are aggregated first (partial + final), so the ranking window only
    sees one row per (window, tag); Spark adds a partial WindowGroupLimit so
    each task keeps at most k rows per window before the shuffle.
    """
    counts = (posts.select(F.col(time_col), F.explode("tags").alias("tag"))
              .groupBy(_tumble(time_col, f"{window_minutes} minutes"), "tag")
              .agg(F.count(F.lit(1)).alias("tag_count")))
    w = Window.partitionBy("w").orderBy(F.desc("tag_count"), F.asc("tag"))
    return (counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select(*_bounds(), "tag", "tag_count", "rank"))
