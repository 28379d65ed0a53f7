"""Whole-table aggregates: hashtag frequency, dashboard views, counters.

All are ``groupBy`` + algebraic aggregates (partial aggregation before the
shuffle, so a hot tag or language is combined map-side). Totals needed for
shares are summed over the already aggregated rows (one per language), never
over the raw table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashtag_frequency(df: DataFrame, col: str = "tags") -> DataFrame:
    """Occurrences per tag, most frequent first (ties by tag)."""
    return (df.select(F.explode(F.col(col)).alias("tag"))
            .groupBy("tag").agg(F.count(F.lit(1)).alias("tag_count"))
            .orderBy(F.desc("tag_count"), F.asc("tag")))


def view_language_share(indexed: DataFrame) -> DataFrame:
    """Posts per language and their share of all posts. The total is a sum
    over the per-language rows (bounded by the number of languages), so the
    input is scanned once."""
    per_lang = indexed.groupBy("language").agg(F.count(F.lit(1)).alias("post_count"))
    total = F.sum("post_count").over(Window.partitionBy())
    return per_lang.select("language", "post_count", (F.col("post_count") / total).alias("share"))


def view_volume_over_time(indexed: DataFrame, time_col: str = "created_at",
                          unit: str = "hour") -> DataFrame:
    return (indexed.groupBy(F.date_trunc(unit, F.col(time_col)).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("post_count")))


def view_top_hashtags(indexed: DataFrame, k: int = 10, col: str = "tags") -> DataFrame:
    """Top-k tags (a report; the limit is the feature)."""
    return (indexed.select(F.explode(F.col(col)).alias("tag"))
            .groupBy("tag").agg(F.count(F.lit(1)).alias("tag_count"))
            .orderBy(F.desc("tag_count"), F.asc("tag")).limit(k))


def view_engagement(indexed: DataFrame) -> DataFrame:
    s = F.col("engagement_score")
    return indexed.agg(F.count(F.lit(1)).alias("posts"), F.count(s).alias("scored_posts"),
                       F.avg(s.cast("double")).alias("avg_engagement"),
                       F.max(s).alias("max_engagement"), F.sum(s).alias("total_engagement"))


def index_stats(tables: dict[str, DataFrame | None], spark=None) -> DataFrame:
    """Document count per keyed table; a missing table (``None``) counts 0.
    ``spark`` is needed only when every table is missing."""
    parts = []
    for name, df in tables.items():
        if df is None:
            continue
        spark = df.sparkSession
        parts.append(df.agg(F.count(F.lit(1)).alias("doc_count"))
                     .select(F.lit(name).alias("index_name"), "doc_count"))
    missing = [n for n, d in tables.items() if d is None]
    out = parts[0] if parts else None
    for p in parts[1:]:
        out = out.unionByName(p)
    if missing:
        if spark is None:
            raise ValueError("every table is missing: pass spark")
        zeros = spark.createDataFrame([(n, 0) for n in missing], "index_name string, doc_count bigint")
        out = zeros if out is None else out.unionByName(zeros)
    return out


def index_counts(log: DataFrame, key: str, order: list[str], tables: dict[str, Column]) -> DataFrame:
    """``index_stats`` of tables that one log of versions feeds, in one pass:
    ``tables`` maps a name to the condition under which a version goes to it.
    A table has a document per key that ever met its condition, and one per
    record without a key (told apart by ``order``)."""
    k = F.col(key)
    names = list(tables)
    per_key = (log.groupBy(k.alias("k"), F.when(k.isNull(), F.struct(*order)).alias("n"))
               .agg(*[F.max(F.coalesce(c, F.lit(False))).alias(f"t{i}") for i, c in enumerate(tables.values())]))
    totals = per_key.agg(*[F.count_if(F.col(f"t{i}")).alias(f"t{i}") for i in range(len(names))])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("index_name"), F.col(f"t{i}").alias("doc_count")) for i, n in enumerate(names)])))


def ingest_summary(topic_frame: DataFrame, value_col: str = "value") -> DataFrame:
    """Per topic: records indexed (decodable JSON object) and errors."""
    from ..functions.parse import _decode_stage, is_record
    staged = _decode_stage(topic_frame, value_col, ["topic"])
    ok = F.coalesce(is_record(F.col("_v")), F.lit(False))
    return (staged.groupBy("topic", F.when(ok, "indexed").otherwise("error").alias("outcome"))
            .agg(F.count(F.lit(1)).alias("records")))
