"""Processing-time windows that close by timers.

Each (window, group) keeps its sums in the state store and a timer at the
window's end. Spark runs a batch when a timer is due, with or without new posts,
so a window closes on a silent source without heartbeat rows, and its state is
gone once it is written. The columns are those of ``operators.windows``.

The sums are added up in Python workers, a batch of rows at a time. A batch of
posts is reduced to the six columns the sums need before it goes there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.parse import source_table
from ..operators.windows import sql_engagement

# What is summed up, and what a group of it keeps: values, sum, and greatest.
SUMMED = ("favourites", "reblogs", "followers", "score")
STATE = "posts long, " + ", ".join(f"{c}_n long, {c}_sum long" for c in SUMMED) + ", score_max long"
RESULT = "window_end_ms long, name string, " + STATE
FIELDS = [f.strip().split(" ")[0] for f in STATE.split(",")]

# analysis -> (window size in minutes or None if chosen, group)
SIZES = {"language": (5, None), "users": (10, None), "engagement": (5, None), "dashboard": (1, "volume"), "count": (1 / 6, "count")}


class WindowSums(StatefulProcessor):
    """Adds up the posts of one (window, group) and tells the sums when its
    timer, set for the window's end, is due."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.sums.exists()
        s = dict(zip(FIELDS, self.sums.get())) if known else dict.fromkeys(FIELDS, 0) | {"score_max": None}
        for pdf in rows:
            s["posts"] += len(pdf)
            for c in SUMMED:
                values = pdf[c].dropna()
                s[f"{c}_n"] += len(values)
                s[f"{c}_sum"] += int(values.sum())
            top = pdf["score"].max()
            if not pd.isna(top):
                s["score_max"] = int(top) if s["score_max"] is None else max(s["score_max"], int(top))
        self.sums.update(tuple(s[f] for f in FIELDS))
        if not known:
            self.handle.registerTimer(int(key[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = dict(zip(FIELDS, self.sums.get()))
        self.sums.clear()
        one = {"window_end_ms": [int(key[0])], "name": [key[1]]}
        yield pd.DataFrame(one | {f: pd.array([s[f]], dtype="Int64") for f in FIELDS})

    def close(self) -> None:
        pass


def _group(analysis: str) -> Column:
    if analysis == "language":
        return F.col("language")
    if analysis == "users":
        return F.col("account.username")
    return F.lit(analysis)


def timed_windows(raw: DataFrame, analysis: str, window_minutes: int | None = None) -> DataFrame:
    """A windowed analysis over processing time, for append mode: every window
    is written once, when its end has passed."""
    if analysis not in SIZES:
        raise ValueError(f"analysis {analysis!r} is none of {tuple(SIZES)}")
    minutes, own = SIZES[analysis]
    seconds = int(round(60 * (minutes if own or not window_minutes else window_minutes)))
    posts = source_table(raw, with_proc_time=True)
    end = F.unix_millis(F.window("proc_time", f"{seconds} seconds").end)
    summed = (posts.select(end.alias("window_end_ms"), _group(analysis).alias("name"),
                           F.col("favourites_count").alias("favourites"), F.col("reblogs_count").alias("reblogs"),
                           F.col("account.followers_count").alias("followers"), sql_engagement().alias("score"))
              .groupBy("window_end_ms", "name")
              .transformWithStateInPandas(WindowSums(), RESULT, "append", "processingTime"))
    return _columns(summed, analysis, seconds)


def _columns(summed: DataFrame, analysis: str, seconds: int) -> DataFrame:
    end = F.timestamp_millis("window_end_ms")
    bounds = [(end - F.expr(f"INTERVAL {seconds} SECONDS")).alias("window_start"), end.alias("window_end")]
    total = lambda c: F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum"))
    mean = lambda c: total(c).cast("double") / F.col(f"{c}_n")
    if analysis == "language":
        return summed.select(*bounds, F.coalesce("name", F.lit("unknown")).alias("language"),
                             F.col("posts").alias("post_count"), total("score").alias("total_engagement"))
    if analysis == "users":
        return (summed.where(F.col("name").isNotNull() & (F.col("posts") > 1))
                .select(*bounds, F.col("name").alias("username"), F.col("posts").alias("post_count"),
                        F.when(F.col("followers_n") > 0, F.expr("followers_sum div followers_n")).alias("avg_followers")))
    if analysis == "engagement":
        return summed.select(*bounds, F.col("posts").alias("total_posts"), mean("favourites").alias("avg_favourites"),
                             mean("reblogs").alias("avg_reblogs"), F.col("score_max").alias("max_engagement"))
    if analysis == "dashboard":
        return summed.select(*bounds, F.lit("volume").alias("metric_type"), F.lit("posts_per_minute").alias("metric_name"),
                             F.col("posts").cast("double").alias("metric_value"))
    return summed.select(F.date_format(end, "HH:mm:ss").alias("window_end"), F.col("posts").alias("post_count"))
