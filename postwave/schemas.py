"""Schemas of the post data model.

Canonical post = what producers publish; parsed post = the nine fields the
stream operators keep; engagement / hashtag tables = the typed keyed outputs.
"""

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

ACCOUNT_SCHEMA = StructType([
    StructField("username", StringType()),
    StructField("display_name", StringType()),
    StructField("followers_count", LongType()),
])

# Canonical post as written to the posts topic (id is text even when a
# producer emits a JSON number).
POST_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("created_at", StringType()),
    StructField("content", StringType()),
    StructField("account", ACCOUNT_SCHEMA),
    StructField("language", StringType()),
    StructField("favourites_count", LongType()),
    StructField("reblogs_count", LongType()),
    StructField("replies_count", LongType()),
    StructField("url", StringType()),
    StructField("tags", ArrayType(StringType())),
])

# Raw status as returned by the social API: tags are objects with a name.
RAW_STATUS_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("created_at", StringType()),
    StructField("content", StringType()),
    StructField("account", ACCOUNT_SCHEMA),
    StructField("language", StringType()),
    StructField("favourites_count", LongType()),
    StructField("reblogs_count", LongType()),
    StructField("replies_count", LongType()),
    StructField("url", StringType()),
    StructField("tags", ArrayType(StructType([StructField("name", StringType())]))),
])

PARSED_POST_COLUMNS = ["id", "content", "language", "username", "followers_count",
                       "favourites_count", "reblogs_count", "tags", "created_at"]

PARSED_POST_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("content", StringType()),
    StructField("language", StringType()),
    StructField("username", StringType()),
    StructField("followers_count", LongType()),
    StructField("favourites_count", LongType()),
    StructField("reblogs_count", LongType()),
    StructField("tags", ArrayType(StringType())),
    StructField("created_at", StringType()),
])

# Record on the engagement topic: the parsed post plus its score.
ENGAGEMENT_RECORD_SCHEMA = StructType(PARSED_POST_SCHEMA.fields
                                      + [StructField("engagement_score", LongType())])

HASHTAG_RECORD_SCHEMA = StructType([
    StructField("post_id", StringType()),
    StructField("hashtags", ArrayType(StringType())),
    StructField("hashtag_count", IntegerType()),
    StructField("language", StringType()),
])

# Keyed index tables (typed mapping of the search indices).
ENGAGEMENT_TABLE = StructType([
    StructField("id", StringType()),
    StructField("content", StringType()),
    StructField("language", StringType()),
    StructField("username", StringType()),
    StructField("followers_count", IntegerType()),
    StructField("favourites_count", IntegerType()),
    StructField("reblogs_count", IntegerType()),
    StructField("engagement_score", IntegerType()),
    StructField("tags", ArrayType(StringType())),
    StructField("created_at", TimestampType()),
    StructField("indexed_at", TimestampType()),
])

HASHTAG_TABLE = StructType([
    StructField("post_id", StringType()),
    StructField("hashtags", ArrayType(StringType())),
    StructField("hashtag_count", IntegerType()),
    StructField("language", StringType()),
    StructField("indexed_at", TimestampType()),
])

# Declared sink tables of the windowed jobs that write to topics.
DASHBOARD_SINK = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("metric_type", StringType()),
    StructField("metric_name", StringType()),
    StructField("metric_value", DoubleType()),
])

COUNTS_SINK = StructType([
    StructField("window_end", StringType()),
    StructField("post_count", LongType()),
])

# Topic names and defaults used by the pipelines.
TOPIC_POSTS = "mastodon-posts"
TOPIC_ENGAGEMENT = "mastodon-engagement"
TOPIC_HASHTAGS = "mastodon-hashtags"
TOPIC_FILTERED = "mastodon-filtered"
TOPIC_DASHBOARD = "mastodon-dashboard"
TOPIC_COUNTS = "mastodon-counts"
DEFAULT_LANGUAGES = ["en", "fr"]
