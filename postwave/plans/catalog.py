"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle per operator. ``__spark_entry__`` exposes both dictionaries.

Each query reads the provided tables (through the posts adapter) in full.
Array columns are compared as comma-joined text in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import parse as P
from ..operators import aggregates as A
from ..operators import transforms as T
from ..operators import windows as W
from ..sources.posts import EVENT_COLUMNS, NO_CONTENT, posts, raw_posts
from .oracle_sql import LOG_CTE, PARSED_CTE, wend, with_posts, wstart

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _joined(col: str, alias: str | None = None):
    return F.array_join(F.col(col), ",").alias(alias or col)


# ---------------------------------------------------------------- windows --

@register("language_distribution", with_posts(f"""
SELECT {wstart('created_at', 300)} AS window_start, {wend('created_at', 300)} AS window_end,
       coalesce(raw_language, 'unknown') AS language,
       count(*) AS post_count,
       CAST(sum(favourites_count + reblogs_count * 2) AS BIGINT) AS total_engagement
FROM (SELECT *, language AS raw_language FROM posts) p
GROUP BY 1, 2, raw_language"""))
def q_language_distribution(spark, d):
    return W.language_distribution(posts(spark, d, NO_CONTENT), "created_at", 5)


def _top_users_sql(minutes: int) -> str:
    s = minutes * 60
    return with_posts(f"""
SELECT {wstart('created_at', s)} AS window_start, {wend('created_at', s)} AS window_end,
       username, count(*) AS post_count,
       CAST(sum(followers_count) // count(followers_count) AS BIGINT) AS avg_followers
FROM posts WHERE username IS NOT NULL
GROUP BY 1, 2, username HAVING count(*) > 1""")


@register("top_users", _top_users_sql(10))
def q_top_users(spark, d):
    return W.top_users(posts(spark, d, EVENT_COLUMNS), "created_at", 10)


@register("top_users_60", _top_users_sql(60))
def q_top_users_60(spark, d):
    return W.top_users(posts(spark, d, EVENT_COLUMNS), "created_at", 60)


@register("engagement_metrics", with_posts(f"""
SELECT {wstart('created_at', 300)} AS window_start, {wend('created_at', 300)} AS window_end,
       count(*) AS total_posts,
       avg(CAST(favourites_count AS DOUBLE)) AS avg_favourites,
       avg(CAST(reblogs_count AS DOUBLE)) AS avg_reblogs,
       max(favourites_count + reblogs_count * 2) AS max_engagement
FROM posts GROUP BY 1, 2"""))
def q_engagement_metrics(spark, d):
    return W.engagement_metrics(posts(spark, d, EVENT_COLUMNS), "created_at", 5)


@register("dashboard_volume", with_posts(f"""
SELECT {wstart('created_at', 60)} AS window_start, {wend('created_at', 60)} AS window_end,
       'volume' AS metric_type, 'posts_per_minute' AS metric_name,
       CAST(count(*) AS DOUBLE) AS metric_value
FROM posts GROUP BY 1, 2"""))
def q_dashboard_volume(spark, d):
    return W.dashboard_volume(posts(spark, d, EVENT_COLUMNS), "created_at")


@register("simple_count", with_posts(f"""
SELECT strftime(w_end, '%H:%M:%S') AS window_end, count(*) AS post_count
FROM (SELECT {wend('created_at', 10)} AS w_end FROM posts) GROUP BY w_end"""))
def q_simple_count(spark, d):
    return W.simple_count(posts(spark, d, EVENT_COLUMNS), "created_at")


@register("trending_hashtags", with_posts(f"""
SELECT window_start, window_end, tag, tag_count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY tag_count DESC, tag) AS rank
  FROM (SELECT {wstart('created_at', 3600)} AS window_start, {wend('created_at', 3600)} AS window_end,
               tag, count(*) AS tag_count
        FROM (SELECT created_at, unnest(tags) AS tag FROM posts) GROUP BY 1, 2, 3))
WHERE rank <= 3"""))
def q_trending_hashtags(spark, d):
    return W.trending_hashtags(posts(spark, d, EVENT_COLUMNS), "created_at", 60, 3).withColumn(
        "rank", F.col("rank").cast("bigint"))


# ------------------------------------------------------------- aggregates --

@register("hashtag_frequency", with_posts("""
SELECT tag, count(*) AS tag_count FROM (SELECT unnest(tags) AS tag FROM posts) GROUP BY tag"""))
def q_hashtag_frequency(spark, d):
    return A.hashtag_frequency(posts(spark, d, EVENT_COLUMNS))


# ---------------------------------------------------------------- parsing --

@register("parse_posts", with_posts("""
SELECT id, content, language, username, followers_count, favourites_count, reblogs_count,
       array_to_string(tags, ',') AS tags, created_at FROM parsed""", PARSED_CTE))
def q_parse_posts(spark, d):
    p = P.parse_posts(raw_posts(spark, d))
    return p.select("id", "content", "language", "username", "followers_count",
                    "favourites_count", "reblogs_count", _joined("tags"), "created_at")


def _parsed(spark, d):
    return P.parse_posts(raw_posts(spark, d))


def _scored(spark, d):
    """Pipeline J1 as a batch plan: parse -> score (replies lost at parse)."""
    return T.engagement_score(_parsed(spark, d))


# ------------------------------------------------------------ row operators --

@register("engagement_score", with_posts("""
SELECT id, favourites_count + reblogs_count * 2 AS engagement_score FROM posts"""))
def q_engagement_score(spark, d):
    return T.engagement_score(posts(spark, d, EVENT_COLUMNS)).select("id", "engagement_score")


@register("engagement_score_with_replies", with_posts("""
SELECT id, favourites_count + reblogs_count * 2 + replies_count AS engagement_score FROM posts"""))
def q_engagement_score_with_replies(spark, d):
    return T.engagement_score(posts(spark, d, EVENT_COLUMNS), include_replies=True).select("id", "engagement_score")


@register("pipeline_engagement", with_posts("""
SELECT id, username, language, favourites_count + reblogs_count * 2 AS engagement_score
FROM parsed""", PARSED_CTE))
def q_pipeline_engagement(spark, d):
    return _scored(spark, d).select("id", "username", "language", "engagement_score")


@register("pipeline_engagement_documented", with_posts("""
SELECT id, favourites_count + reblogs_count * 2 + replies_count AS engagement_score
FROM parsed""", PARSED_CTE))
def q_pipeline_engagement_documented(spark, d):
    return T.engagement_score(_parsed(spark, d), include_replies=True).select("id", "engagement_score")


@register("language_filter", with_posts("""
SELECT id, language FROM parsed WHERE language IN ('en', 'fr')""", PARSED_CTE))
def q_language_filter(spark, d):
    return T.language_filter(_parsed(spark, d)).select("id", "language")


@register("language_filter_unknown", with_posts("""
SELECT id, language FROM parsed WHERE language = 'unknown'""", PARSED_CTE))
def q_language_filter_unknown(spark, d):
    return T.language_filter(_parsed(spark, d), ["unknown"]).select("id", "language")


@register("extract_hashtags", with_posts("""
SELECT id AS post_id, array_to_string(tags, ',') AS hashtags,
       CAST(len(tags) AS INTEGER) AS hashtag_count, language
FROM parsed""", PARSED_CTE))
def q_extract_hashtags(spark, d):
    h = T.extract_hashtags_raw(raw_posts(spark, d))
    return h.select("post_id", _joined("hashtags"), "hashtag_count", "language")


@register("pipeline_full", with_posts("""
SELECT 'engagement' AS branch, id AS record_id, favourites_count + reblogs_count * 2 AS metric
FROM parsed
UNION ALL
SELECT 'hashtags' AS branch, id AS record_id, CAST(len(tags) AS BIGINT) AS metric FROM parsed""",
                                   PARSED_CTE))
def q_pipeline_full(spark, d):
    from .pipelines import full_pipeline_records
    return full_pipeline_records(raw_posts(spark, d))


@register("content_preview", with_posts("""
SELECT id, CASE WHEN length(content) > 50 THEN substr(content, 1, 50) || '...' ELSE content END
       AS content_preview FROM posts"""))
def q_content_preview(spark, d):
    return posts(spark, d).select("id", T.content_preview("content").alias("content_preview"))


@register("tag_slice", with_posts("""
SELECT id, array_to_string(list_slice(tags, 1, 5), ',') AS first_tags,
       CAST(len(tags) AS INTEGER) AS tag_count FROM posts"""))
def q_tag_slice(spark, d):
    return posts(spark, d, EVENT_COLUMNS).select("id", F.array_join(T.tag_slice("tags"), ",").alias("first_tags"),
                                  F.size("tags").alias("tag_count"))


@register("normalise_created_at", with_posts("""
SELECT p.id, q.created_at AS created_ts FROM parsed p JOIN posts q ON p.id = q.id""", PARSED_CTE))
def q_normalise_created_at(spark, d):
    return _parsed(spark, d).select(
        "id", P.normalise_created_at(F.col("created_at")).cast("timestamp_ntz").alias("created_ts"))


@register("filter_by_hashtag", with_posts("""
SELECT id FROM posts WHERE list_contains(tags, 'click')"""))
def q_filter_by_hashtag(spark, d):
    return T.filter_by_hashtag(posts(spark, d, EVENT_COLUMNS), "CLICK").select("id")


@register("significant_posts", with_posts("""
SELECT id, favourites_count + reblogs_count * 2 AS engagement_score FROM parsed
WHERE favourites_count + reblogs_count * 2 >= 300""", PARSED_CTE))
def q_significant_posts(spark, d):
    return T.significant_posts(_scored(spark, d), 300).select("id", "engagement_score")


# ---------------------------------------------------------------- sources --

@register("source_table", with_posts("""
SELECT id, username, CASE WHEN seq % 19 = 0 THEN NULL ELSE language END AS language,
       favourites_count, reblogs_count, replies_count,
       array_to_string(tags, ',') AS tags, created_at AS event_time
FROM posts WHERE seq % 97 <> 0"""))
def q_source_table(spark, d):
    t = P.register_source_table(raw_posts(spark, d))
    return t.select("id", F.col("account.username").alias("username"), "language",
                    "favourites_count", "reblogs_count", "replies_count", _joined("tags"),
                    F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@register("quarantine_bad_json", with_posts("""
SELECT seq, 'not_an_object' AS reason FROM posts WHERE seq % 97 = 0"""))
def q_quarantine(spark, d):
    return P.quarantine(raw_posts(spark, d)).select("seq", "reason")


@register("project_raw_status", with_posts("""
SELECT id, created_iso AS created_at, username, display_name, followers_count, language,
       favourites_count, reblogs_count, replies_count, url, array_to_string(tags, ',') AS tags
FROM posts WHERE seq % 43 <> 0"""))
def q_project_raw_status(spark, d):
    from ..sources.posts import raw_statuses
    s = P.project_raw_status(raw_statuses(spark, d))
    return s.select("id", "created_at", F.col("account.username").alias("username"),
                    F.col("account.display_name").alias("display_name"),
                    F.col("account.followers_count").alias("followers_count"), "language",
                    "favourites_count", "reblogs_count", "replies_count", "url", _joined("tags"))


@register("incremental_since", with_posts("""
SELECT id, created_at, CAST(row_number() OVER (ORDER BY CAST(id AS DECIMAL(38,0))) AS INTEGER) AS poll_rank
FROM (SELECT * FROM posts WHERE list_contains(tags, 'view') AND CAST(id AS DECIMAL(38,0)) > 5000
      ORDER BY CAST(id AS DECIMAL(38,0)) DESC LIMIT 40)"""))
def q_incremental_since(spark, d):
    from ..sources.incremental import incremental_since
    return incremental_since(posts(spark, d, EVENT_COLUMNS), last_id=5000, tag="view").select(
        "id", "created_at", "poll_rank")


@register("incremental_since_first", with_posts("""
SELECT id, created_at, CAST(row_number() OVER (ORDER BY CAST(id AS DECIMAL(38,0))) AS INTEGER) AS poll_rank
FROM (SELECT * FROM posts WHERE list_contains(tags, 'view')
      ORDER BY CAST(id AS DECIMAL(38,0)) DESC LIMIT 20)"""))
def q_incremental_since_first(spark, d):
    from ..sources.incremental import incremental_since
    return incremental_since(posts(spark, d, EVENT_COLUMNS), last_id=None, tag="view").select(
        "id", "created_at", "poll_rank")


# ------------------------------------------------------------------ sinks --

@register("jsonl_roundtrip", with_posts("""
SELECT id, username, language, favourites_count, replies_count,
       array_to_string(tags, ',') AS tags, created_iso AS created_at FROM posts"""))
def q_jsonl_roundtrip(spark, d):
    from ..schemas import POST_SCHEMA
    from ..session import shared_path
    from ..sinks.writers import read_jsonl, write_jsonl
    from ..sources.posts import canonical_json_rows
    path = shared_path(spark, "archive")
    write_jsonl(canonical_json_rows(posts(spark, d)), path, append=True)
    back = read_jsonl(spark, path, POST_SCHEMA)
    return back.select("id", F.col("account.username").alias("username"), "language",
                       "favourites_count", "replies_count", _joined("tags"), "created_at")


@register("kafka_value_frame", with_posts("""
SELECT id, favourites_count + reblogs_count * 2 AS engagement_score, language FROM parsed""",
                                          PARSED_CTE))
def q_kafka_value_frame(spark, d):
    from ..sinks.writers import kafka_value_frame
    frame = kafka_value_frame(T.scored_view(_scored(spark, d)))
    back = F.from_json("value", "id string, engagement_score bigint, language string")
    return frame.select(back.alias("r")).select("r.id", "r.engagement_score", "r.language")


@register("kafka_keyed_frame", with_posts("""
SELECT id AS key, id, url FROM posts"""))
def q_kafka_keyed_frame(spark, d):
    from ..sinks.writers import kafka_keyed_frame
    frame = kafka_keyed_frame(posts(spark, d).select("id", "url", "language"))
    return frame.select("key", F.get_json_object("value", "$.id").alias("id"),
                        F.get_json_object("value", "$.url").alias("url"))


def _result_topics(spark, d):
    """Records of the engagement and hashtag topics, both from one parse."""
    from ..schemas import PARSED_POST_COLUMNS, TOPIC_ENGAGEMENT, TOPIC_HASHTAGS
    from ..sinks.writers import JSON_OPTS
    scored = T.engagement_score(P.parse_posts(raw_posts(spark, d)))
    message = lambda topic, *cols: F.struct(
        F.to_json(F.struct(*cols), JSON_OPTS).alias("value"), F.lit(topic).alias("topic"))
    eng = message(TOPIC_ENGAGEMENT, *PARSED_POST_COLUMNS, "engagement_score")
    tags = message(TOPIC_HASHTAGS, F.col("id").alias("post_id"), F.col("tags").alias("hashtags"),
                   F.size("tags").alias("hashtag_count"), "language")
    return scored.select(F.inline(F.when(F.col("tags").isNull(), F.array(eng)).otherwise(F.array(eng, tags))))


def _topic_frame(spark, d):
    """The records of all three topics from one read and one parse of the posts:
    each gives its own text, and if it is a post its engagement and, with a
    tag list, its hashtag record."""
    from ..schemas import PARSED_POST_COLUMNS, TOPIC_ENGAGEMENT, TOPIC_HASHTAGS, TOPIC_POSTS
    from ..sinks.writers import JSON_OPTS
    post = P.split_records(raw_posts(spark, d), P.posts_decoder())
    r = F.col("row")
    message = lambda topic, value: F.struct(value.alias("value"), F.lit(topic).alias("topic"))
    record = lambda *cols: F.to_json(F.struct(*cols), JSON_OPTS)
    eng = record(*[r[c].alias(c) for c in PARSED_POST_COLUMNS],
                 (r["favourites_count"] + r["reblogs_count"] * 2).alias("engagement_score"))
    tags = record(r["id"].alias("post_id"), r["tags"].alias("hashtags"), F.size(r["tags"]).alias("hashtag_count"),
                  r["language"].alias("language"))
    raw = message(TOPIC_POSTS, F.col("value"))
    return post.select(F.inline(
        F.when(r.isNull(), F.array(raw))
        .when(r["tags"].isNull(), F.array(raw, message(TOPIC_ENGAGEMENT, eng)))
        .otherwise(F.array(raw, message(TOPIC_ENGAGEMENT, eng), message(TOPIC_HASHTAGS, tags)))))


@register("route_by_topic", with_posts("""
SELECT 'mastodon-engagement' AS topic, id AS doc_key FROM parsed
UNION ALL SELECT 'mastodon-hashtags' AS topic, id AS doc_key FROM parsed""", PARSED_CTE))
def q_route_by_topic(spark, d):
    from ..sources.kafka import route_by_topic
    from ..schemas import TOPIC_ENGAGEMENT, TOPIC_HASHTAGS
    both = _result_topics(spark, d)
    routes = route_by_topic(both, [TOPIC_ENGAGEMENT, TOPIC_HASHTAGS])
    assert set(routes) == {TOPIC_ENGAGEMENT, TOPIC_HASHTAGS}
    # the two routes side by side in one pass: each record has the key of its topic
    key = F.when(F.col("topic") == TOPIC_ENGAGEMENT, F.get_json_object("value", "$.id")).otherwise(
        F.get_json_object("value", "$.post_id"))
    return both.filter(F.col("topic").isin(TOPIC_ENGAGEMENT, TOPIC_HASHTAGS)).select("topic", key.alias("doc_key"))


@register("ingest_summary", with_posts("""
SELECT 'mastodon-engagement' AS topic, 'indexed' AS outcome, count(*) AS records FROM parsed
UNION ALL SELECT 'mastodon-hashtags', 'indexed', count(*) FROM parsed
UNION ALL SELECT 'mastodon-posts', 'indexed', count(*) FROM posts WHERE seq % 97 <> 0
UNION ALL SELECT 'mastodon-posts', 'error', count(*) FROM posts WHERE seq % 97 = 0""", PARSED_CTE))
def q_ingest_summary(spark, d):
    return A.ingest_summary(_topic_frame(spark, d))


# ------------------------------------------------------------ keyed tables --

def _log_scored(spark, d, columns=EVENT_COLUMNS):
    """The post log with scores, without what the caller does not use."""
    from ..sources.posts import post_log
    return T.engagement_score(post_log(spark, d, columns))


def upserted_engagement(spark, d):
    from ..operators.upsert import upsert_latest
    return upsert_latest(_log_scored(spark, d).select("id", "seq", "favourites_count", "engagement_score"),
                         "id", ["seq"])


def upserted_hashtags(spark, d):
    from ..operators.upsert import upsert_latest
    h = T.extract_hashtags(_log_scored(spark, d, NO_CONTENT), keep=["seq"])
    return upsert_latest(h, "post_id", ["seq"])


@register("upsert_engagement", with_posts("""
SELECT id, seq, favourites_count, favourites_count + reblogs_count * 2 AS engagement_score
FROM post_log QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""", LOG_CTE))
def q_upsert_engagement(spark, d):
    return upserted_engagement(spark, d).select("id", "seq", "favourites_count", "engagement_score")


@register("upsert_hashtags", with_posts("""
SELECT id AS post_id, seq, CAST(len(tags) AS INTEGER) AS hashtag_count, language
FROM post_log QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""", LOG_CTE))
def q_upsert_hashtags(spark, d):
    return upserted_hashtags(spark, d).select("post_id", "seq", "hashtag_count", "language")


@register("index_stats", with_posts("""
SELECT 'mastodon-engagement' AS index_name, count(DISTINCT id) AS doc_count FROM post_log
UNION ALL SELECT 'mastodon-hashtags', count(DISTINCT id) FROM post_log""", LOG_CTE))
def q_index_stats(spark, d):
    from ..schemas import TOPIC_ENGAGEMENT, TOPIC_HASHTAGS
    from ..sources.posts import post_log
    return A.index_counts(post_log(spark, d, EVENT_COLUMNS), "id", ["seq"],
                          {TOPIC_ENGAGEMENT: F.lit(True), TOPIC_HASHTAGS: F.col("tags").isNotNull()})


@register("conform_engagement", with_posts("""
SELECT id, CAST(followers_count AS INTEGER) AS followers_count,
       CAST(favourites_count AS INTEGER) AS favourites_count,
       CAST(favourites_count + reblogs_count * 2 AS INTEGER) AS engagement_score,
       q.created_at AS created_at, true AS conform_ok
FROM parsed JOIN (SELECT id AS qid, created_at FROM posts) q ON parsed.id = q.qid""", PARSED_CTE))
def q_conform_engagement(spark, d):
    from ..operators.upsert import conform
    from ..schemas import ENGAGEMENT_TABLE
    c = conform(T.scored_view(_scored(spark, d)), ENGAGEMENT_TABLE)
    return c.select("id", "followers_count", "favourites_count", "engagement_score",
                    F.col("created_at").cast("timestamp_ntz").alias("created_at"), "conform_ok")


@register("conform_mixed", with_posts("""
SELECT id, CASE WHEN seq % 13 = 0 THEN NULL ELSE CAST(favourites_count AS INTEGER) END AS favourites_count,
       CASE WHEN seq % 17 = 0 THEN NULL ELSE CAST(followers_count AS INTEGER) END AS followers_count,
       CASE WHEN seq % 19 <> 0 THEN created_at END AS created_at,
       NOT (seq % 13 = 0 OR seq % 17 = 0 AND followers_count IS NOT NULL OR seq % 19 = 0) AS conform_ok
FROM posts"""))
def q_conform_mixed(spark, d):
    """K10 over records of which some do not fit: words for numbers, numbers
    beyond the column's type and times that are none."""
    from ..operators.upsert import conform
    from ..schemas import ENGAGEMENT_TABLE
    p, seq = posts(spark, d, EVENT_COLUMNS), F.col("id").cast("bigint")
    mixed = p.select(
        "id", F.when(seq % 13 == 0, F.lit("many")).otherwise(F.col("favourites_count").cast("string")).alias("favourites_count"),
        F.when(seq % 17 == 0, F.col("account.followers_count") + F.lit(1 << 40))
        .otherwise(F.col("account.followers_count")).alias("followers_count"),
        F.when(seq % 19 == 0, F.lit("noon")).otherwise(F.col("created_at").cast("string")).alias("created_at"))
    return conform(mixed, ENGAGEMENT_TABLE).select(
        "id", "favourites_count", "followers_count", F.col("created_at").cast("timestamp_ntz").alias("created_at"), "conform_ok")


# ------------------------------------------------------------------ views --

def _indexed(spark, d):
    s = _scored(spark, d)
    return s.withColumn("created_at", P.normalise_created_at(F.col("created_at")).cast("timestamp_ntz"))


@register("view_language_share", with_posts("""
SELECT language, count(*) AS post_count, count(*) / (SELECT count(*) FROM parsed) AS share
FROM parsed GROUP BY language""", PARSED_CTE))
def q_view_language_share(spark, d):
    return A.view_language_share(_indexed(spark, d))


@register("view_volume_over_time", with_posts("""
SELECT date_trunc('hour', q.created_at) AS bucket, count(*) AS post_count
FROM parsed JOIN (SELECT id AS qid, created_at FROM posts) q ON parsed.id = q.qid GROUP BY 1""",
                                              PARSED_CTE))
def q_view_volume_over_time(spark, d):
    return A.view_volume_over_time(_indexed(spark, d))


@register("view_top_hashtags", with_posts("""
SELECT tag, count(*) AS tag_count FROM (SELECT unnest(tags) AS tag FROM parsed)
GROUP BY tag ORDER BY tag_count DESC, tag LIMIT 10""", PARSED_CTE))
def q_view_top_hashtags(spark, d):
    return A.view_top_hashtags(_indexed(spark, d), 10)


@register("view_engagement", with_posts("""
SELECT count(*) AS posts, count(e) AS scored_posts, avg(CAST(e AS DOUBLE)) AS avg_engagement,
       max(e) AS max_engagement, CAST(sum(e) AS BIGINT) AS total_engagement
FROM (SELECT favourites_count + reblogs_count * 2 AS e FROM parsed)""", PARSED_CTE))
def q_view_engagement(spark, d):
    return A.view_engagement(_indexed(spark, d))


# ------------------------------------------------------------- custom SQL --
# Analyst queries through the guarded entry point (J7) over the posts table
# registered as ``mastodon_posts``. Spark text first, DuckDB oracle second.

LAG_FRAME_SQL = """
SELECT id, lag(created_at) OVER (PARTITION BY username ORDER BY created_at, id) AS previous_post,
       CAST(sum(favourites_count) OVER (PARTITION BY username ORDER BY created_at, id
                                        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS favourites_3
FROM posts"""
SESSIONS_SQL = """
SELECT username, min(created_at) AS session_start, max(created_at) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS post_count
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR created_at >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                  OVER (PARTITION BY username ORDER BY created_at, id) AS sid
      FROM (SELECT username, created_at, id,
                   lag(created_at) OVER (PARTITION BY username ORDER BY created_at, id) AS prev
            FROM posts WHERE username IS NOT NULL))
GROUP BY username, sid"""
EXISTS_SQL = """
SELECT p.id, p.language FROM posts p
WHERE EXISTS (SELECT 1 FROM posts q WHERE q.username = p.username AND q.favourites_count > 485)
  AND NOT EXISTS (SELECT 1 FROM posts r WHERE r.username = p.username AND r.language = 'es'
                  AND r.reblogs_count > 97 AND r.favourites_count > 200)"""

CUSTOM_SQL: dict[str, tuple[str, str]] = {
    "custom_sql_projection": ("""
SELECT id, account.username AS username, language,
       favourites_count + reblogs_count * 2 AS engagement
FROM mastodon_posts WHERE language = 'en' AND reblogs_count > 50""", """
SELECT id, username, language, favourites_count + reblogs_count * 2 AS engagement
FROM posts WHERE language = 'en' AND reblogs_count > 50"""),
    "custom_sql_group_having": ("""
SELECT account.username AS username, count(*) AS posts, sum(favourites_count) AS favourites
FROM mastodon_posts WHERE account.username IS NOT NULL
GROUP BY account.username HAVING count(*) > 60""", """
SELECT username, count(*) AS posts, CAST(sum(favourites_count) AS BIGINT) AS favourites
FROM posts WHERE username IS NOT NULL GROUP BY username HAVING count(*) > 60"""),
    # Same-user posts less than an hour apart, counted per post: the result has
    # one row per post. The hour bucket is an equi-key next to the user, so a
    # prolific user is split across many join tasks.
    "custom_sql_self_join": ("""
WITH p AS (SELECT id, account.username AS username, created_at,
                  date_trunc('HOUR', created_at) AS hb
           FROM mastodon_posts WHERE account.username IS NOT NULL),
     b AS (SELECT id, username, created_at, hb AS k FROM p
           UNION ALL
           SELECT id, username, created_at, hb - INTERVAL 1 HOUR AS k FROM p)
SELECT a.id AS id, a.username AS username, count(*) AS later_posts, min(b.created_at) AS next_post
FROM p a JOIN b ON a.username = b.username AND a.hb = b.k
WHERE b.created_at > a.created_at AND b.created_at <= a.created_at + INTERVAL 1 HOUR
GROUP BY a.id, a.username""", """
SELECT a.id AS id, a.username AS username, count(*) AS later_posts, min(b.created_at) AS next_post
FROM posts a JOIN posts b ON a.username = b.username
WHERE b.created_at > a.created_at AND b.created_at <= a.created_at + INTERVAL 1 HOUR
GROUP BY a.id, a.username"""),
    # EXISTS / NOT EXISTS per user, folded into one per-user aggregate that
    # combines on the map side; the semi join then meets at most one row per
    # user, so a hot user is split by AQE on the probing side only (or the
    # user side is broadcast when its measured runtime size is small).
    "custom_sql_semi_anti": ("""
SELECT p.id, p.language FROM mastodon_posts p
LEFT SEMI JOIN (
  SELECT account.username AS username FROM mastodon_posts
  WHERE account.username IS NOT NULL
  GROUP BY account.username
  HAVING max(favourites_count > 485)
     AND NOT coalesce(max(language = 'es' AND reblogs_count > 97 AND favourites_count > 200), false)
) u ON p.account.username = u.username""", """
SELECT p.id, p.language FROM posts p
WHERE EXISTS (SELECT 1 FROM posts q WHERE q.username = p.username AND q.favourites_count > 485)
  AND NOT EXISTS (SELECT 1 FROM posts r WHERE r.username = p.username AND r.language = 'es'
                  AND r.reblogs_count > 97 AND r.favourites_count > 200)"""),
    # Each branch is DISTINCT first, so a hot user is one row per task before
    # any set operation shuffles it.
    "custom_sql_union_intersect_except": ("""
(SELECT DISTINCT account.username AS username FROM mastodon_posts
 WHERE language = 'en' AND reblogs_count > 95
 INTERSECT
 SELECT DISTINCT account.username FROM mastodon_posts WHERE language = 'fr' AND reblogs_count > 90)
UNION
(SELECT DISTINCT account.username FROM mastodon_posts WHERE language = 'de' AND favourites_count > 480
 EXCEPT
 SELECT DISTINCT account.username FROM mastodon_posts WHERE language = 'es')""", """
(SELECT username FROM posts WHERE language = 'en' AND reblogs_count > 95
 INTERSECT
 SELECT username FROM posts WHERE language = 'fr' AND reblogs_count > 90)
UNION
(SELECT username FROM posts WHERE language = 'de' AND favourites_count > 480
 EXCEPT
 SELECT username FROM posts WHERE language = 'es')"""),
    "custom_sql_rollup": ("""
SELECT language, replies_count, CAST(grouping(language) AS INT) AS g_language,
       CAST(grouping(replies_count) AS INT) AS g_replies, count(*) AS post_count
FROM mastodon_posts GROUP BY ROLLUP(language, replies_count)""", """
SELECT language, replies_count, CAST(grouping(language) AS INTEGER) AS g_language,
       CAST(grouping(replies_count) AS INTEGER) AS g_replies, count(*) AS post_count
FROM posts GROUP BY ROLLUP(language, replies_count)"""),
    "custom_sql_lag_frame": ("""
SELECT id, lag(created_at) OVER (PARTITION BY account.username ORDER BY created_at, id) AS previous_post,
       sum(favourites_count) OVER (PARTITION BY account.username ORDER BY created_at, id
                                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS favourites_3
FROM mastodon_posts""", LAG_FRAME_SQL),
    "custom_sql_session_window": ("""
SELECT account.username AS username, session_window.start AS session_start,
       session_window.end AS session_end, count(*) AS post_count
FROM mastodon_posts WHERE account.username IS NOT NULL
GROUP BY account.username, session_window(created_at, '30 minutes')""", SESSIONS_SQL),
    "custom_sql_exists": ("""
SELECT p.id, p.language FROM mastodon_posts p
WHERE EXISTS (SELECT 1 FROM mastodon_posts q
              WHERE q.account.username = p.account.username AND q.favourites_count > 485)
  AND NOT EXISTS (SELECT 1 FROM mastodon_posts r
                  WHERE r.account.username = p.account.username AND r.language = 'es'
                    AND r.reblogs_count > 97 AND r.favourites_count > 200)""", EXISTS_SQL),
    "custom_sql_rank_topk": ("""
SELECT language, id, engagement, CAST(rn AS BIGINT) AS rn FROM (
  SELECT language, id, favourites_count + reblogs_count * 2 AS engagement,
         row_number() OVER (PARTITION BY language
                            ORDER BY favourites_count + reblogs_count * 2 DESC NULLS LAST, id) AS rn
  FROM mastodon_posts) WHERE rn <= 3""", """
SELECT language, id, engagement, CAST(rn AS BIGINT) AS rn FROM (
  SELECT language, id, favourites_count + reblogs_count * 2 AS engagement,
         row_number() OVER (PARTITION BY language
                            ORDER BY favourites_count + reblogs_count * 2 DESC NULLS LAST, id) AS rn
  FROM posts) WHERE rn <= 3"""),
    "custom_sql_hop_window": ("""
SELECT window.start AS window_start, window.end AS window_end, count(*) AS post_count
FROM mastodon_posts GROUP BY window(created_at, '10 minutes', '5 minutes')""", """
SELECT w AS window_start, w + INTERVAL 10 MINUTE AS window_end, count(*) AS post_count
FROM (SELECT unnest([make_timestamp((epoch_us(created_at) // 300000000) * 300000000),
                     make_timestamp((epoch_us(created_at) // 300000000) * 300000000 - 300000000)]) AS w
      FROM posts) GROUP BY w"""),
}


def _custom(name: str, text: str):
    def run(spark, d):
        from .sql import custom_sql
        # the view has the columns the text names
        columns = NO_CONTENT if "language" in text else EVENT_COLUMNS
        return custom_sql(spark, text, posts(spark, d, columns))
    run.__name__ = f"q_{name}"
    return run


for _name, (_spark_sql, _duck_sql) in CUSTOM_SQL.items():
    register(_name, with_posts(_duck_sql))(_custom(_name, _spark_sql))


# Sequence operators: what an analyst writes as
#   lag(created_at) / sum(favourites_count) ROWS 2 PRECEDING
#     OVER (PARTITION BY account.username ORDER BY created_at, id)
#   GROUP BY account.username, session_window(created_at, '30 minutes')
# in chunks, so a user holding a third of all posts is cut over many window
# tasks instead of sorted in one. The custom_sql_* keys above run the same as
# analyst SQL.

def _by_user(spark, d):
    return posts(spark, d, EVENT_COLUMNS).select(
        "id", "created_at", F.col("account.username").alias("username"), "favourites_count")


@register("sequence_lag_frame", with_posts(LAG_FRAME_SQL))
def q_sequence_lag_frame(spark, d):
    from ..operators.sequence import lag_frame
    out = lag_frame(_by_user(spark, d), ["username"], "created_at", "id", "favourites_count")
    return out.select("id", "previous_post", F.col("favourites_count_3").alias("favourites_3"))


@register("sequence_sessions", with_posts(SESSIONS_SQL))
def q_sequence_sessions(spark, d):
    from ..operators.sequence import sessions
    p = _by_user(spark, d).filter(F.col("username").isNotNull())
    return sessions(p, ["username"], "created_at", "id", 30)


# -------------------------------------------------------------- streaming --
# The same functions run as Structured Streaming jobs over the raw records
# replayed from files in the shared folder; results are read back whole.

SOURCE_TABLE_CTE = """srctable AS (
  SELECT id, seq, created_at, username, followers_count, favourites_count, reblogs_count,
         replies_count, tags, CASE WHEN seq % 19 = 0 THEN NULL ELSE language END AS language
  FROM posts WHERE seq % 97 <> 0
)"""


@register("stream_language_distribution", with_posts(f"""
SELECT {wstart('created_at', 300)} AS window_start, {wend('created_at', 300)} AS window_end,
       coalesce(raw_language, 'unknown') AS language, count(*) AS post_count,
       CAST(sum(favourites_count + reblogs_count * 2) AS BIGINT) AS total_engagement
FROM (SELECT *, language AS raw_language FROM srctable) GROUP BY 1, 2, raw_language""",
                                                      SOURCE_TABLE_CTE))
def q_stream_language_distribution(spark, d):
    from ..session import shared_path
    from ..sources.kafka import read_replay
    from ..streaming.jobs import window_stream, write_stream
    from ..streaming.replay import FLUSH_BEFORE, drain, write_replay
    base = shared_path(spark, "stream-language")
    write_replay(raw_posts(spark, d), f"{base}/in")
    out = window_stream(read_replay(spark, f"{base}/in"), "language", time="event",
                        window_minutes=5, delay="10 minutes")
    q = write_stream(out, "parquet", f"{base}/ckpt", path=f"{base}/out")
    drain(q, spark, f"{base}/in", flushes=1)
    res = spark.read.parquet(f"{base}/out").filter(F.col("window_start") < F.lit(FLUSH_BEFORE))
    return res.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "language", "post_count", "total_engagement")


def _stream_window(spark, d, analysis: str, name: str, window_minutes: int | None = None):
    """A windowed SQL analysis as a Structured Streaming job: replayed raw
    records -> declared-table decode -> event-time watermark -> the batch
    window function -> append-mode parquet sink, then read back whole."""
    from ..session import shared_path
    from ..sources.kafka import read_replay
    from ..streaming.jobs import window_stream, write_stream
    from ..streaming.replay import FLUSH_BEFORE, drain, write_replay
    base = shared_path(spark, name)
    write_replay(raw_posts(spark, d), f"{base}/in")
    out = window_stream(read_replay(spark, f"{base}/in"), analysis, time="event",
                        window_minutes=window_minutes, delay="10 minutes")
    q = write_stream(out, "parquet", f"{base}/ckpt", path=f"{base}/out")
    drain(q, spark, f"{base}/in", flushes=1)
    res = spark.read.parquet(f"{base}/out")
    if "window_start" in res.columns:
        res = res.filter(F.col("window_start") < F.lit(FLUSH_BEFORE))
        res = (res.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
                  .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))
    return res


@register("stream_top_users", with_posts(f"""
SELECT {wstart('created_at', 3600)} AS window_start, {wend('created_at', 3600)} AS window_end,
       username, count(*) AS post_count,
       CAST(sum(followers_count) // count(followers_count) AS BIGINT) AS avg_followers
FROM srctable WHERE username IS NOT NULL
GROUP BY 1, 2, username HAVING count(*) > 1""", SOURCE_TABLE_CTE))
def q_stream_top_users(spark, d):
    """A2 as a streaming job (60-minute windows)."""
    return _stream_window(spark, d, "users", "stream-users", 60)


@register("stream_engagement_metrics", with_posts(f"""
SELECT {wstart('created_at', 300)} AS window_start, {wend('created_at', 300)} AS window_end,
       count(*) AS total_posts,
       avg(CAST(favourites_count AS DOUBLE)) AS avg_favourites,
       avg(CAST(reblogs_count AS DOUBLE)) AS avg_reblogs,
       max(favourites_count + reblogs_count * 2) AS max_engagement
FROM srctable GROUP BY 1, 2""", SOURCE_TABLE_CTE))
def q_stream_engagement_metrics(spark, d):
    """A3 as a streaming job."""
    return _stream_window(spark, d, "engagement", "stream-engagement-metrics", 5)


@register("stream_dashboard_volume", with_posts(f"""
SELECT {wstart('created_at', 60)} AS window_start, {wend('created_at', 60)} AS window_end,
       'volume' AS metric_type, 'posts_per_minute' AS metric_name,
       CAST(count(*) AS DOUBLE) AS metric_value
FROM srctable GROUP BY 1, 2""", SOURCE_TABLE_CTE))
def q_stream_dashboard_volume(spark, d):
    """A4 as a streaming job."""
    return _stream_window(spark, d, "dashboard", "stream-dashboard")


@register("stream_simple_count", with_posts(f"""
SELECT strftime(w_end, '%H:%M:%S') AS window_end, count(*) AS post_count
FROM (SELECT {wend('created_at', 10)} AS w_end FROM srctable)
WHERE w_end < TIMESTAMP '2099-01-01' GROUP BY w_end""", SOURCE_TABLE_CTE))
def q_stream_simple_count(spark, d):
    """A5 as a streaming job. Its output keeps only the clock time of the
    window end, so the flush record's window is recognised by the raw
    window before formatting."""
    from ..session import shared_path
    from ..sources.kafka import read_replay
    from ..streaming.jobs import window_stream, write_stream
    from ..streaming.replay import FLUSH_BEFORE, drain, write_replay
    base = shared_path(spark, "stream-count")
    write_replay(raw_posts(spark, d), f"{base}/in")
    out = window_stream(read_replay(spark, f"{base}/in"), "count", time="event",
                        delay="10 minutes", keep_window_end=True)
    q = write_stream(out, "parquet", f"{base}/ckpt", path=f"{base}/out")
    drain(q, spark, f"{base}/in", flushes=1)
    res = spark.read.parquet(f"{base}/out")
    return res.filter(F.col("_w_end") < F.lit(FLUSH_BEFORE)).select("window_end", "post_count")


# J8: the dispatcher's SQL mode on a batch read of the replayed topic.
@register("dispatch_sql_engagement", with_posts(f"""
SELECT {wstart('created_at', 600)} AS window_start, {wend('created_at', 600)} AS window_end,
       count(*) AS total_posts,
       avg(CAST(favourites_count AS DOUBLE)) AS avg_favourites,
       avg(CAST(reblogs_count AS DOUBLE)) AS avg_reblogs,
       max(favourites_count + reblogs_count * 2) AS max_engagement
FROM srctable GROUP BY 1, 2""", SOURCE_TABLE_CTE))
def q_dispatch_sql_engagement(spark, d):
    """``--mode sql --analysis engagement --window 10 --time event`` over the
    topic's records, batch (the same call runs on a stream)."""
    from .dispatcher import run_analysis
    out = run_analysis(spark, raw_posts(spark, d).select("value"), "sql", "engagement",
                       window=10, time="event")
    return (out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
               .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


@register("dispatch_stream_filter", with_posts("""
SELECT id, content, language, username, followers_count, favourites_count, reblogs_count,
       array_to_string(tags, ',') AS tags, created_at
FROM parsed WHERE language IN ('fr', 'de')""", PARSED_CTE))
def q_dispatch_stream_filter(spark, d):
    """``--mode stream --analysis filter --languages fr de`` (J2 through J8)."""
    from .dispatcher import run_analysis
    out = run_analysis(spark, raw_posts(spark, d).select("value"), "stream", "filter",
                       languages=["fr", "de"])
    return out.select("id", "content", "language", "username", "followers_count",
                      "favourites_count", "reblogs_count", _joined("tags"), "created_at")


@register("stream_pipeline_full", ORACLE["pipeline_full"])
def q_stream_pipeline_full(spark, d):
    from ..session import shared_path
    from ..sources.kafka import read_replay
    from ..streaming.jobs import full_pipeline_job
    from ..streaming.replay import drain, write_replay
    base = shared_path(spark, "stream-full")
    write_replay(raw_posts(spark, d), f"{base}/in")
    q = full_pipeline_job(read_replay(spark, f"{base}/in"), f"{base}/ckpt",
                          {"fmt": "parquet", "path": f"{base}/eng"},
                          {"fmt": "parquet", "path": f"{base}/tags"})
    drain(q)
    eng = spark.read.parquet(f"{base}/eng")
    tags = spark.read.parquet(f"{base}/tags")
    return (eng.select(F.lit("engagement").alias("branch"), F.col("id").alias("record_id"),
                       F.col("engagement_score").alias("metric"))
            .unionByName(tags.select(F.lit("hashtags").alias("branch"),
                                     F.col("post_id").alias("record_id"),
                                     F.col("hashtag_count").cast("bigint").alias("metric"))))


@register("stream_archive", with_posts("""
SELECT id, username, language, favourites_count, replies_count,
       array_to_string(tags, ',') AS tags, created_iso AS created_at
FROM (SELECT *, CASE WHEN seq % 19 = 0 THEN NULL ELSE language END AS lang2 FROM posts)
     p(id, seq, created_at, content, username, display_name, followers_count, language_raw,
       favourites_count, reblogs_count, replies_count, url, tags, created_iso, language)
WHERE seq % 97 <> 0"""))
def q_stream_archive(spark, d):
    from ..schemas import POST_SCHEMA
    from ..session import shared_path
    from ..sinks.writers import read_jsonl
    from ..sources.kafka import read_replay
    from ..streaming.jobs import archive_job
    from ..streaming.replay import drain, write_replay
    base = shared_path(spark, "stream-archive")
    write_replay(raw_posts(spark, d), f"{base}/in")
    drain(archive_job(read_replay(spark, f"{base}/in"), f"{base}/archive", f"{base}/ckpt"))
    back = read_jsonl(spark, f"{base}/archive", POST_SCHEMA)
    return back.select("id", F.col("account.username").alias("username"), "language",
                       "favourites_count", "replies_count", _joined("tags"), "created_at")


@register("stream_upsert", ORACLE["upsert_engagement"])
def q_stream_upsert(spark, d):
    from ..schemas import TOPIC_ENGAGEMENT
    from ..session import shared_path
    from ..streaming import keyed
    from ..streaming.replay import drain
    base = shared_path(spark, "stream-upsert")
    log = _log_scored(spark, d).select("id", "seq", "favourites_count", "engagement_score")
    # the version order travels with each record, as Kafka offsets would
    frame = log.select("seq", F.struct("id", "favourites_count", "engagement_score").alias("r")) \
        .select("seq", F.to_json("r", {"ignoreNullFields": "false"}).alias("value"),
                F.lit(TOPIC_ENGAGEMENT).alias("topic"))
    frame.write.json(f"{base}/in")
    stream = spark.readStream.schema("seq bigint, value string, topic string").json(f"{base}/in")
    st = StructType([StructField("id", StringType()), StructField("favourites_count", LongType()),
                     StructField("engagement_score", LongType())])
    drain(keyed.upsert_job(stream, f"{base}/tables", f"{base}/ckpt",
                           {TOPIC_ENGAGEMENT: (st, "engagement")}))
    t = keyed.read_table(spark, f"{base}/tables/engagement", "id", ["seq"], st)
    return t.select("id", "seq", "favourites_count", "engagement_score")


ENGAGEMENT_RECORDS = StructType([StructField("id", StringType()), StructField("favourites_count", LongType()),
                                 StructField("engagement_score", LongType())])


def _index_in_batches(spark, d, name: str, value, **job) -> str:
    """The engagement records of the post log through the index job: four
    micro-batches of a file each, with a restart after two. The log is split
    by a hash of its order, so that versions of a post come in any batch."""
    from ..schemas import TOPIC_ENGAGEMENT
    from ..session import shared_path
    from ..streaming import keyed
    from ..streaming.replay import drain
    base = shared_path(spark, name)
    log = _log_scored(spark, d).select("id", "seq", "favourites_count", "engagement_score")
    frame = log.select("seq", F.to_json(F.struct("id", "favourites_count", "engagement_score"),
                                        {"ignoreNullFields": "false"}).alias("value"))
    frame = frame.select("seq", value(F.col("seq"), F.col("value")).alias("value"),
                         F.lit(TOPIC_ENGAGEMENT).alias("topic"))
    for half in (0, 1):
        (frame.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == half).repartition(2, "seq")
         .write.mode("append").json(f"{base}/in"))
        stream = (spark.readStream.schema("seq bigint, value string, topic string")
                  .option("maxFilesPerTrigger", "1").json(f"{base}/in"))
        drain(keyed.upsert_job(stream, f"{base}/tables", f"{base}/ckpt",
                               {TOPIC_ENGAGEMENT: (ENGAGEMENT_RECORDS, "engagement")}, **job))
    return f"{base}/tables"


@register("stream_upsert_mixed", with_posts("""
SELECT 'document' AS kind, id AS name, seq, favourites_count + reblogs_count * 2 AS value
FROM post_log WHERE seq % 97 <> 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1
UNION ALL SELECT 'indexed', 'mastodon-engagement', NULL, count(*) FROM post_log WHERE seq % 97 <> 0
UNION ALL SELECT 'error', 'mastodon-engagement', NULL, count(*) FROM post_log WHERE seq % 97 = 0
UNION ALL SELECT 'rejected: malformed_json', 'mastodon-engagement', NULL, count(*) FROM post_log WHERE seq % 97 = 0""",
                                           LOG_CTE))
def q_stream_upsert_mixed(spark, d):
    """J6 over four batches with broken and re-emitted records, a restart and
    compaction after every second batch."""
    from ..schemas import TOPIC_ENGAGEMENT
    from ..streaming import keyed
    broken = lambda seq, value: F.when(seq % 97 == 0, F.lit("{bad}")).otherwise(value)
    base = _index_in_batches(spark, d, "stream-upsert-mixed", broken, compact_every=2)
    at = f"{base}/engagement"
    none = F.lit(None).cast("bigint")
    rows = keyed.read_table(spark, at, "id", ["seq"], ENGAGEMENT_RECORDS).select(
        F.lit("document").alias("kind"), F.col("id").alias("name"), "seq", F.col("engagement_score").alias("value"))
    counts = keyed.read_counts(spark, base).select(
        F.col("outcome").alias("kind"), F.col("topic").alias("name"), none.alias("seq"), F.col("records").alias("value"))
    refused = keyed.read_rejects(spark, at).groupBy("reason").count().select(
        F.concat(F.lit("rejected: "), "reason").alias("kind"), F.lit(TOPIC_ENGAGEMENT).alias("name"),
        none.alias("seq"), F.col("count").alias("value"))
    return rows.unionByName(counts).unionByName(refused)


@register("keyed_lookup", with_posts("""
SELECT id, seq, favourites_count, favourites_count + reblogs_count * 2 AS engagement_score FROM post_log
WHERE id IN (SELECT CAST(max(event_id) AS VARCHAR) FROM events GROUP BY event_type)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""", LOG_CTE))
def q_keyed_lookup(spark, d):
    """The last post of each kind by its key, from the table that the index job
    made of all posts."""
    from ..sources.tables import read_table
    from ..streaming import keyed
    base = _index_in_batches(spark, d, "keyed-lookup", lambda seq, value: value, compact_every=2)
    keys = [r.id for r in read_table(spark, d, "events").groupBy("event_type")
            .agg(F.max("event_id").cast("string").alias("id")).collect()]
    rows = keyed.lookup(spark, f"{base}/engagement", "id", ["seq"], ENGAGEMENT_RECORDS, keys)
    return rows.select("id", "seq", "favourites_count", "engagement_score")


# Streams of four micro-batches: in runs of seven records, or in the order of
# time with every thirteenth record a batch late.
BATCHES = 4
RUNS = f"(seq DIV 7) % {BATCHES}"
BATCHES_CTE = f"b AS (SELECT unnest(range({BATCHES})) AS batch)"


def _in_batches(base: str, frame, batch, jobs) -> None:
    """Puts the records of ``frame`` into a topic folder in BATCHES goes, ``batch`` telling which. After each go every job of ``jobs``
    (a function of the stream) begins anew at its checkpoint and takes what
    is there."""
    from ..streaming.replay import drain
    frame = frame.persist()
    spark = frame.sparkSession
    try:
        for b in range(BATCHES):
            frame.where(batch == b).write.mode("append").json(f"{base}/in")
            for job in jobs:
                drain(job(spark.readStream.schema(frame.schema).json(f"{base}/in")))
    finally:
        frame.unpersist()


def _by_time(spark, d, behind: str = "0"):
    """The batch of a record by its place in time, ``behind`` batches later."""
    from ..sources.tables import read_table
    n = read_table(spark, d, "events").agg(F.max("event_id") + 1).first()[0] or 1
    return F.expr(f"least({BATCHES - 1}, seq * {BATCHES} DIV {n} + {behind})")


TIMED_CTE = f"""t AS (
  SELECT *, seq * {BATCHES} // (SELECT max(seq) + 1 FROM posts) AS batch FROM posts)"""


CHANGELOG_SQL = {
    "having": """
SELECT account.username AS username, count(*) AS posts, sum(reblogs_count) AS reblogs
FROM mastodon_posts GROUP BY account.username HAVING count(*) % 3 <> 0""",
    "all": """
SELECT language, count(*) AS posts, sum(favourites_count) AS favourites FROM mastodon_posts GROUP BY language"""}


@register("stream_changelog", with_posts(f"""
SELECT 'having' AS query, batch, username AS name, count(*) AS posts, CAST(sum(reblogs_count) AS BIGINT) AS total
FROM srctable JOIN b ON (seq // 7) % {BATCHES} <= batch GROUP BY batch, username HAVING count(*) % 3 <> 0
UNION ALL
SELECT 'all', batch, language, count(*), CAST(sum(favourites_count) AS BIGINT)
FROM srctable JOIN b ON (seq // 7) % {BATCHES} <= batch GROUP BY batch, language""", SOURCE_TABLE_CTE, BATCHES_CTE))
def q_stream_changelog(spark, d):
    """J7 with changes: two custom queries as streams of four batches, each
    batch by a job started anew; the changes up to each batch, folded, are the
    answer at that time."""
    from ..session import shared_path
    from ..streaming.changelog import changelog_job, folded, read_changes
    from .sql import custom_sql
    base = shared_path(spark, "stream-changelog")

    def job(name):
        return lambda stream: changelog_job(
            custom_sql(spark, CHANGELOG_SQL[name], P.source_table(stream, with_proc_time=False)),
            f"{base}/{name}", f"{base}/ckpt-{name}", compact_every=2)

    _in_batches(base, raw_posts(spark, d, NO_CONTENT).select("seq", "value"), F.expr(RUNS), [job(n) for n in CHANGELOG_SQL])
    out = None
    for name in CHANGELOG_SQL:
        changes = read_changes(spark, f"{base}/{name}")
        for b in range(BATCHES):
            then = folded(changes.where(F.col("batch") <= b).drop("batch"))
            then = then.toDF("name", "posts", "total").select(
                F.lit(name).alias("query"), F.lit(b).cast("bigint").alias("batch"), "name", "posts", "total")
            out = then if out is None else out.unionByName(then)
    return out


VIEWED_CTE = f"""v AS (
  SELECT batch, l.*, favourites_count + reblogs_count * 2 AS score
  FROM post_log l JOIN b ON (seq // 7) % {BATCHES} <= batch
  QUALIFY row_number() OVER (PARTITION BY batch, id ORDER BY seq DESC) = 1)"""


@register("stream_views", with_posts("""
SELECT batch, 'language' AS view, language AS name, CAST(count(*) AS DOUBLE) AS value FROM v GROUP BY batch, language
UNION ALL SELECT batch, 'hour', strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S'), count(*)
  FROM v GROUP BY ALL
UNION ALL SELECT batch, 'tag', tag, count(*) AS n FROM (SELECT batch, unnest(tags) AS tag FROM v) GROUP BY batch, tag
  QUALIFY row_number() OVER (PARTITION BY batch ORDER BY n DESC, tag) <= 10
UNION ALL SELECT batch, 'engagement', 'posts', count(*) FROM v GROUP BY batch
UNION ALL SELECT batch, 'engagement', 'scored_posts', count(score) FROM v GROUP BY batch
UNION ALL SELECT batch, 'engagement', 'avg_engagement', avg(CAST(score AS DOUBLE)) FROM v GROUP BY batch
UNION ALL SELECT batch, 'engagement', 'max_engagement', max(score) FROM v GROUP BY batch
UNION ALL SELECT batch, 'engagement', 'total_engagement', sum(score) FROM v GROUP BY batch""", LOG_CTE, BATCHES_CTE, VIEWED_CTE))
def q_stream_views(spark, d):
    """A8 kept up to date over four batches in which posts are replaced, older
    versions coming after newer ones too; the views after each batch."""
    from ..session import shared_path
    from ..sources.posts import raw_log
    from ..streaming.changelog import read_views, views_job
    from ..streaming.replay import drain
    base = shared_path(spark, "stream-views")
    frame, seen = raw_log(spark, d, NO_CONTENT), []

    def after(b):
        v = read_views(spark, f"{base}/views")
        e = v["engagement"]
        rows = [v["language_share"].select(F.lit("language").alias("view"), F.col("language").alias("name"),
                                           F.col("post_count").cast("double").alias("value")),
                v["volume_over_time"].select(F.lit("hour").alias("view"), F.col("bucket").cast("string").alias("name"),
                                             F.col("post_count").cast("double").alias("value")),
                v["top_hashtags"].select(F.lit("tag").alias("view"), F.col("tag").alias("name"),
                                         F.col("tag_count").cast("double").alias("value")),
                e.select(F.lit("engagement").alias("view"),
                         F.stack(F.lit(len(e.columns)), *[x for c in e.columns for x in (F.lit(c), F.col(c).cast("double"))])
                         .alias("name", "value"))]
        for r in rows:
            seen.append(r.select(F.lit(b).cast("bigint").alias("batch"), "view", "name", "value"))

    frame = frame.persist()
    try:
        for b in range(BATCHES):
            frame.where(F.expr(RUNS) == b).write.mode("append").json(f"{base}/in")
            stream = spark.readStream.schema("seq bigint, value string").json(f"{base}/in")
            drain(views_job(stream, f"{base}/views", f"{base}/ckpt", compact_every=2))
            after(b)
    finally:
        frame.unpersist()
    out = seen[0]
    for r in seen[1:]:
        out = out.unionByName(r)
    return out


# A1-A5 with every row accounted for: window size, then per window the DuckDB
# text of name, a and b, its condition, and the Spark columns.
ACCOUNTED = {
    "language": (300, "coalesce(language, 'unknown')", "count(*)", "sum(favourites_count + reblogs_count * 2)",
                 "GROUP BY w_end, language", ("language", "post_count", "total_engagement")),
    "users": (3600, "username", "count(*)", "sum(followers_count) // count(followers_count)",
              "AND username IS NOT NULL GROUP BY w_end, username HAVING count(*) > 1",
              ("username", "post_count", "avg_followers")),
    "engagement": (300, "NULL", "avg(CAST(favourites_count AS DOUBLE))", "max(favourites_count + reblogs_count * 2)",
                   "GROUP BY w_end", (None, "avg_favourites", "max_engagement")),
    "dashboard": (60, "'posts_per_minute'", "count(*)", "NULL", "GROUP BY w_end", ("metric_name", "metric_value", None)),
    "count": (10, "strftime(w_end, '%H:%M:%S')", "count(*)", "NULL", "GROUP BY w_end", ("window_end", "post_count", None)),
}


def _accounted_sql(seconds: int, name: str, a: str, b: str, rest: str) -> str:
    split = f"""r AS (
  SELECT *, least({BATCHES - 1}, seq * {BATCHES} // (SELECT max(seq) + 1 FROM posts) + (seq % 13 = 0)::INT) AS batch,
         {wend('created_at', seconds)} AS w_end FROM srctable),
m AS (SELECT batch, max(created_at) AS newest FROM r GROUP BY batch),
k AS (SELECT r.*, coalesce(w_end <= c.closed, false) AS late FROM r LEFT JOIN (
        SELECT x.batch, max(m.newest) - INTERVAL 10 MINUTE AS closed
        FROM (SELECT DISTINCT batch FROM r) x JOIN m ON m.batch < x.batch GROUP BY x.batch) c USING (batch))"""
    return with_posts(f"""
SELECT 'window' AS kind, w_end AS window_end, {name} AS name, CAST({a} AS DOUBLE) AS a, CAST({b} AS DOUBLE) AS b
FROM k WHERE NOT late {rest}
UNION ALL SELECT 'behind_watermark', w_end, id, NULL, NULL FROM k WHERE late""", SOURCE_TABLE_CTE, split)


def _accounted(analysis: str):
    *_, columns = ACCOUNTED[analysis]

    @register(f"stream_late_{analysis}", _accounted_sql(*ACCOUNTED[analysis][:-1]))
    def run(spark, d):
        """The analysis over four batches, each by a job started anew, with
        rows that come a batch late: its windows, and the rows told as late."""
        from ..session import shared_path
        from ..streaming.late import accounted_windows_job, finish, read_late, read_windows
        base = shared_path(spark, f"stream-late-{analysis}")
        minutes = ACCOUNTED[analysis][0] // 60 if analysis in ("language", "users", "engagement") else None
        batch = _by_time(spark, d, "CAST(seq % 13 = 0 AS INT)")
        _in_batches(base, raw_posts(spark, d, NO_CONTENT).select("seq", "value"), batch, [lambda stream: accounted_windows_job(
            stream, analysis, f"{base}/out", f"{base}/ckpt", window_minutes=minutes, delay_seconds=600)])
        finish(spark, f"{base}/out", analysis, minutes)
        found, late = read_windows(spark, f"{base}/out"), read_late(spark, f"{base}/out")
        end = "window_end_at" if analysis == "count" else "window_end"
        value = lambda c, t: (F.lit(None) if c is None else F.col(c)).cast(t)
        return found.select(
            F.lit("window").alias("kind"), F.col(end).cast("timestamp_ntz").alias("window_end"),
            value(columns[0], "string").alias("name"), value(columns[1], "double").alias("a"),
            value(columns[2], "double").alias("b")).unionByName(late.select(
                F.col("reason").alias("kind"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                F.col("id").alias("name"), value(None, "double").alias("a"), value(None, "double").alias("b")))
    return run


for _name in ACCOUNTED:
    _accounted(_name)


@register("stream_trending_hashtags", with_posts(f"""
SELECT window_start, window_end, tag, tag_count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY tag_count DESC, tag) AS rank
  FROM (SELECT {wstart('created_at', 3600)} AS window_start, {wend('created_at', 3600)} AS window_end,
               tag, count(*) AS tag_count
        FROM (SELECT created_at, unnest(tags) AS tag FROM srctable) GROUP BY 1, 2, 3))
WHERE rank <= 3""", SOURCE_TABLE_CTE))
def q_stream_trending_hashtags(spark, d):
    """A9 as a stream of four batches and restarts: final counts of a window,
    then its three most used tags."""
    from ..session import shared_path
    from ..streaming.polling import read_trending, trending_job
    from ..streaming.replay import FLUSH_RECORD, drain
    base = shared_path(spark, "stream-trending")
    job = lambda s: trending_job(s, f"{base}/out", f"{base}/ckpt", delay="10 minutes")
    _in_batches(base, raw_posts(spark, d, NO_CONTENT).select("seq", "value"), _by_time(spark, d), [job])
    spark.createDataFrame([(-1, FLUSH_RECORD)], "seq bigint, value string").write.mode("append").json(f"{base}/in")
    drain(job(spark.readStream.schema("seq bigint, value string").json(f"{base}/in")))
    return read_trending(spark, f"{base}/out").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "tag", "tag_count",
        F.col("rank").cast("bigint").alias("rank"))


@register("stream_dedup", with_posts(f"""
SELECT id, min(batch) AS poll FROM t WHERE seq % 97 <> 0 GROUP BY id
UNION ALL SELECT NULL, batch + i FROM t, (SELECT unnest([0, 1]) AS i)
WHERE seq % 97 = 0 AND (i = 0 OR seq % 3 = 0 AND batch < {BATCHES - 1})""", TIMED_CTE))
def q_stream_dedup(spark, d):
    """Overlapping polls: every third post is brought again by the next poll,
    after a restart. Each post stays once, as first polled; records that are no
    posts have no id and stay."""
    from ..session import shared_path
    from ..streaming.jobs import write_stream
    from ..streaming.polling import each_post_once
    base = shared_path(spark, "stream-dedup")
    poll = _by_time(spark, d)
    again = F.when((F.col("seq") % 3 == 0) & (F.col("poll") < BATCHES - 1), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    frame = raw_posts(spark, d, EVENT_COLUMNS).select("seq", "value").withColumn("poll", poll)
    frame = frame.select("seq", "value", "poll", F.explode(again).alias("i")).select(
        "seq", "value", (F.col("poll") + F.col("i")).cast("bigint").alias("poll"))
    frame = frame.withColumn("polled_at", F.timestamp_seconds(F.col("poll") * 3600 + 1_700_000_000))
    _in_batches(base, frame, F.col("poll"), [lambda s: write_stream(
        each_post_once(s, 86_400), "parquet", f"{base}/ckpt", path=f"{base}/out")])
    out = spark.read.schema(frame.schema).parquet(f"{base}/out")
    return out.select(F.when(F.col("value").startswith('{"id"'), F.get_json_object("value", "$.id")).alias("id"), "poll")


@register("poll_pages", with_posts(f"""
SELECT page, id, row_number() OVER (PARTITION BY page ORDER BY seq) AS poll_rank
FROM (SELECT batch AS page, id, seq FROM t WHERE list_contains(tags, 'click')
      QUALIFY row_number() OVER (PARTITION BY batch ORDER BY seq DESC) <= CASE WHEN batch = 0 THEN 20 ELSE 40 END)""",
                                 TIMED_CTE))
def q_poll_pages(spark, d):
    """S5 as a poller over a status table that grows by four goes: each page
    has the newest posts since the last one (the page size is the feature)."""
    from ..session import shared_path
    from ..streaming.polling import poll, read_pages
    base = shared_path(spark, "poll-pages")
    p = posts(spark, d, EVENT_COLUMNS).withColumn("seq", F.col("id").cast("bigint"))
    p = p.withColumn("go", _by_time(spark, d)).persist()
    try:
        for b in range(BATCHES):
            poll(spark, p.where(F.col("go") <= b).drop("go", "seq"), f"{base}/out", "click")
            poll(spark, p.where(F.col("go") <= b).drop("go", "seq"), f"{base}/out", "click")  # nothing is new
    finally:
        p.unpersist()
    return read_pages(spark, f"{base}/out").select("page", "id", F.col("poll_rank").cast("bigint").alias("poll_rank"))


# Every record through each decoder, accepted or with the reason it is refused.
SPLITS = {
    "posts": ("CASE WHEN seq % 97 = 0 THEN 'not_an_object' END", "favourites_count"),
    "declared": ("CASE WHEN seq % 97 = 0 THEN 'not_an_object' END", "favourites_count"),
    "hashtags": ("CASE WHEN seq % 97 = 0 THEN 'not_an_object' END", "len(tags)"),
    "status": ("CASE WHEN seq % 43 = 0 THEN 'tags_without_names' END", "favourites_count"),
}


def _split_key(name: str):
    reason, value = SPLITS[name]

    @register(f"split_{name}", with_posts(f"""
SELECT seq, {reason} AS reason, CASE WHEN {reason} IS NULL THEN id END AS id,
       CASE WHEN {reason} IS NULL THEN CAST({value} AS BIGINT) END AS value FROM posts"""))
    def run(spark, d):
        from ..sources.posts import raw_statuses
        decoder = {"posts": P.posts_decoder, "declared": P.declared_decoder, "status": P.status_decoder,
                   "hashtags": T.hashtag_decoder}[name]()
        raw = raw_statuses(spark, d) if name == "status" else raw_posts(spark, d)
        rows = P.split_records(raw, decoder, keep=["seq"])
        key, number = ("post_id", "hashtag_count") if name == "hashtags" else ("id", "favourites_count")
        return rows.select("seq", "reason", F.col("row")[key].alias("id"),
                           F.col("row")[number].cast("bigint").alias("value"))
    return run


for _name in SPLITS:
    _split_key(_name)


def _stream_single(spark, d, name: str, job, select: list[str], **kw):
    from ..session import shared_path
    from ..sources.kafka import read_replay
    from ..streaming.replay import drain, write_replay
    base = shared_path(spark, name)
    write_replay(raw_posts(spark, d), f"{base}/in")
    drain(job(read_replay(spark, f"{base}/in"), "parquet", f"{base}/ckpt",
              path=f"{base}/out", **kw))
    return spark.read.parquet(f"{base}/out")


@register("stream_source_replay", ORACLE["pipeline_engagement"])
def q_stream_source_replay(spark, d):
    """S1 + J1 as a streaming job over the replayed topic."""
    from ..streaming.jobs import engagement_job
    out = _stream_single(spark, d, "stream-engagement", engagement_job, [])
    return out.select("id", "username", "language", "engagement_score")


@register("stream_language_filter", ORACLE["language_filter"])
def q_stream_language_filter(spark, d):
    """J2 as a streaming job."""
    from ..streaming.jobs import filter_job
    return _stream_single(spark, d, "stream-filter", filter_job, []).select("id", "language")


@register("stream_hashtags", ORACLE["extract_hashtags"])
def q_stream_hashtags(spark, d):
    """J3 as a streaming job."""
    from ..streaming.jobs import hashtag_job
    out = _stream_single(spark, d, "stream-hashtags", hashtag_job, [])
    return out.select("post_id", _joined("hashtags"), "hashtag_count", "language")
