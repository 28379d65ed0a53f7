"""Row-level post operators: language filter, engagement score, hashtag
records and the small projections around them. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import Decoder, _decoded, _typed_x, field
from ..schemas import DEFAULT_LANGUAGES, PARSED_POST_COLUMNS


def language_filter(df: DataFrame, languages: list[str] | None = None,
                    col: str = "language") -> DataFrame:
    """Exact, case-sensitive membership; an empty or missing list means the
    default ``['en', 'fr']``. NULL languages never pass."""
    langs = list(languages or DEFAULT_LANGUAGES)
    return df.filter(F.col(col).isin(*langs))


def engagement_expr(include_replies: bool = False, replies_col: str = "replies_count") -> Column:
    """``favourites + 2 * reblogs`` (+ replies); any NULL term -> NULL."""
    e = F.col("favourites_count") + F.col("reblogs_count") * 2
    if include_replies:
        e = e + F.col(replies_col)
    return e


def engagement_score(df: DataFrame, include_replies: bool = False) -> DataFrame:
    """Add ``engagement_score``; rows whose counters are NULL are kept with a
    NULL score.

    On a parsed record (nine fields) replies are gone, so the emitted score is
    ``favourites + 2 * reblogs`` unless ``include_replies`` asks for the
    documented formula (replies read at parse time, default 0 when missing).
    """
    if include_replies:
        rc = "_replies_count" if "_replies_count" in df.columns else "replies_count"
        if rc not in df.columns:
            df = df.withColumn("_replies_count", F.lit(0).cast("bigint"))
            rc = "_replies_count"
        return df.withColumn("engagement_score", engagement_expr(True, rc))
    return df.withColumn("engagement_score", engagement_expr(False))


def scored_view(df: DataFrame) -> DataFrame:
    """Parsed nine-field record plus score, in emission order."""
    return df.select(*PARSED_POST_COLUMNS, "engagement_score")


def extract_hashtags(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Hashtag record of a parsed post; a NULL tag list drops the record."""
    return (parsed.filter(F.col("tags").isNotNull())
            .select(*(keep or []), F.col("id").alias("post_id"), F.col("tags").alias("hashtags"),
                    F.size("tags").cast("int").alias("hashtag_count"), F.col("language")))


def extract_hashtags_raw(df: DataFrame, value_col: str = "value",
                         keep: list[str] | None = None) -> DataFrame:
    """Hashtag records straight from post JSON (no parse step in between,
    so ``account`` is never looked at). A record whose ``tags`` are there but
    no list is dropped."""
    return _decoded(df, value_col, keep, hashtag_decoder())


def hashtag_decoder() -> Decoder:
    v = F.col("_v")
    tags_x = field(v, "$.tags")
    a_list = tags_x.isNull() | F.schema_of_variant(tags_x).startswith("ARRAY<")
    tags = _typed_x(F.col("_tags"), "array<string>", F.array().cast("array<string>"))
    return Decoder([(F.lit("tags_not_a_list"), a_list)],
                   [field(v, "$.id").alias("_id"), tags_x.alias("_tags"), field(v, "$.language").alias("_lang")],
                   [F.col("_id").try_cast("string").alias("post_id"), tags.alias("hashtags"),
                    F.size(tags).cast("int").alias("hashtag_count"),
                    _typed_x(F.col("_lang"), "string", F.lit("unknown")).alias("language")])


def content_preview(col: str = "content", n: int = 50) -> Column:
    """First ``n`` characters, with ``...`` appended when the text is longer."""
    c = F.col(col)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def tag_slice(col: str = "tags", n: int = 5) -> Column:
    return F.slice(F.col(col), 1, n)


def filter_by_hashtag(df: DataFrame, tag: str, col: str = "tags") -> DataFrame:
    """Posts carrying ``tag`` (case-insensitive, as hashtag timelines are)."""
    return df.filter(F.array_contains(F.transform(F.col(col), lambda t: F.lower(t)), tag.lower()))


def significant_posts(scored: DataFrame, threshold: int) -> DataFrame:
    """Scored posts at or above an engagement threshold (threshold required)."""
    return scored.filter(F.col("engagement_score") >= F.lit(threshold))
