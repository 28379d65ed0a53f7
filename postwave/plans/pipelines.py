"""The stream jobs as DataFrame plans (batch or streaming input alike).

J1 parse -> score, J2 parse -> language filter, J3 hashtags straight from
the raw records, J4 parse once -> both branches. Each returns DataFrames;
``streaming.jobs`` attaches sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.parse import parse_posts
from ..operators.transforms import (engagement_score, extract_hashtags,
                                    extract_hashtags_raw, language_filter, scored_view)
from ..schemas import PARSED_POST_COLUMNS


def engagement_pipeline(raw: DataFrame, value_col: str = "value",
                        include_replies: bool = False) -> DataFrame:
    return scored_view(engagement_score(parse_posts(raw, value_col), include_replies))


def filtered_pipeline(raw: DataFrame, languages: list[str] | None = None,
                      value_col: str = "value") -> DataFrame:
    return language_filter(parse_posts(raw, value_col), languages).select(*PARSED_POST_COLUMNS)


def hashtag_pipeline(raw: DataFrame, value_col: str = "value") -> DataFrame:
    return extract_hashtags_raw(raw, value_col)


def full_pipeline(raw: DataFrame, value_col: str = "value",
                  parsed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both branches from one parse. Pass an already persisted ``parsed``
    (as the streaming job does per micro-batch) to share the parse."""
    p = parsed if parsed is not None else parse_posts(raw, value_col)
    return scored_view(engagement_score(p)), extract_hashtags(p)


def full_pipeline_records(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Both J4 branches from one parse in one pass, as ``branch, record_id,
    metric`` rows (engagement score / hashtag count). Batch form of J4 for
    callers that want a single output without persisting the parse."""
    from pyspark.sql import functions as F
    p = engagement_score(parse_posts(raw, value_col))
    eng = F.struct(F.lit("engagement").alias("branch"), F.col("id").alias("record_id"),
                   F.col("engagement_score").alias("metric"))
    tags = F.when(F.col("tags").isNotNull(),
                  F.struct(F.lit("hashtags").alias("branch"), F.col("id").alias("record_id"),
                           F.size("tags").cast("bigint").alias("metric")))
    both = F.filter(F.array(eng, tags), lambda r: r.isNotNull())
    return p.select(F.inline(both))
