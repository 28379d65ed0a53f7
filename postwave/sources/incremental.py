"""Incremental "newest N since id" read over a post table.

The poller asks a hashtag timeline for the newest posts after the last id it
saw (20 on the first call, 40 afterwards) and emits them oldest first. As a
table operator that is a filter plus a top-N: Spark plans ``orderBy().limit()``
as TakeOrderedAndProject (each task keeps its N best, the driver merges N per
task), so no task ever holds more than N rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.transforms import filter_by_hashtag


def incremental_since(df: DataFrame, last_id: str | int | None = None, tag: str = "news",
                      first_limit: int = 20, limit: int = 40) -> DataFrame:
    """Newest posts carrying ``tag`` with numeric id above ``last_id``,
    returned with ``poll_rank`` 1 = oldest of the page."""
    num = F.col("id").try_cast("decimal(38,0)")
    cand = filter_by_hashtag(df, tag)
    n = first_limit
    if last_id is not None:
        cand = cand.filter(num > F.lit(str(last_id)).cast("decimal(38,0)"))
        n = limit
    page = cand.withColumn("_num", num).orderBy(F.desc("_num")).limit(n)
    from pyspark.sql import Window
    # the page is at most n rows: ranking it in one partition is bounded
    w = Window.orderBy("_num")
    return page.withColumn("poll_rank", F.row_number().over(w)).drop("_num")


def next_since_id(page: DataFrame) -> DataFrame:
    """The id to pass as ``last_id`` on the next poll (newest of the page)."""
    return page.agg(F.max_by("id", F.col("id").try_cast("decimal(38,0)")).alias("last_id"))
