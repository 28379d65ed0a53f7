"""Post tables derived from the provided tables.

There is no social-post table among the inputs, so posts are derived from
``events`` (one post per event: id, time, author, counters, tags) joined to
``documents`` (the post body and its language). Every event and every
document takes part: an event's document is ``event_id mod count(documents)``,
and the body is the whole document text.

A few deterministic rules inject the edge cases the operators must handle
(NULL author, NULL and literal ``'unknown'`` language, NULL counters, empty tag
lists). They shape values; they never drop rows.

Everything here is a lazy DataFrame: the join is an equi-join on a uniform
key (so no hot key from the adapter) and ``documents`` is pruned to the
columns a query needs. The documents side is broadcast only when its decoded
size (texts included) is proven under the limit (``operators.joins``);
otherwise both sides shuffle on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, sized_side
from .tables import read_table, table_path

# Edge-case injection rules of the posts adapter (moduli of
# event_id) and the URL pattern.
NULL_USER_MOD = 23
NULL_LANGUAGE_MOD = 17
UNKNOWN_LANGUAGE_MOD = 29
NULL_FAVOURITES_MOD = 31
EMPTY_TAGS_MOD = 5
REPLIES_MOD = 7
FOLLOWERS_MOD = 5000
MISSING_LANGUAGE_KEY_MOD = 19   # raw JSON: "language" key left out
BAD_JSON_MOD = 97               # raw JSON: value replaced by a broken object
NULL_TAGS_MOD = 43              # raw status JSON: "tags": null (record dropped)
REEMIT_TAG = "click"            # post log: posts with this tag are edited once
REEMIT_SEQ_OFFSET = 10_000_000
URL_PREFIX = "https://social.example/@user"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _k(props: Column) -> Column:
    return F.regexp_extract(props, r"([0-9]+)", 1)


# Fixed value: events that one task turns into posts.
EVENTS_PER_TASK = 100_000


def _tasks(spark: SparkSession, df: DataFrame) -> int:
    """Tasks for the per-post work: as many as cores, and more as rows grow,
    so that what a task holds does not grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-df.count() // EVENTS_PER_TASK))


def _spread(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that arrives in fewer partitions than ``_tasks`` (a
    split of a file may hold no row group, or a large one), so the per-post
    work after it runs in parallel. Inputs already split into that many
    partitions are left alone; only narrow event rows move, never document
    text."""
    tasks = _tasks(spark, df)
    if df.rdd.getNumPartitions() < tasks:
        return df.repartition(tasks, key)
    return df


def _spread_for_join(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """The events by the key of a join that shuffles. Adaptive execution merges
    partitions by the bytes that are shuffled, but each event leaves the join
    with a whole text, so the number of tasks comes from the rows. Fewer than
    the session's shuffle partitions would be shuffled once more."""
    return df.repartition(max(_tasks(spark, df), int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


# Post columns that come from ``documents``, and the column each needs.
FROM_DOCUMENTS = {"content": "text", "language": "lang"}
COLUMNS = ("id", "created_at", "content", "account", "language", "favourites_count",
           "reblogs_count", "replies_count", "url", "tags")
EVENT_COLUMNS = tuple(c for c in COLUMNS if c not in FROM_DOCUMENTS)
NO_CONTENT = tuple(c for c in COLUMNS if c != "content")


def posts(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Canonical posts table; ``created_at`` is the event timestamp. Only
    ``columns`` are made: without content and language ``documents`` is
    neither read nor joined, and its size is measured on what is carried."""
    ev = read_table(spark, sf_dir, "events")
    carried = [c for p, c in FROM_DOCUMENTS.items() if p in columns]
    if carried:
        docs = read_table(spark, sf_dir, "documents").select("doc_id", *carried)
        n_docs = docs.select(F.count(F.lit(1))).scalar()
        small = fits_broadcast(spark, docs, [table_path(sf_dir, "documents")])
        docs = sized_side(spark, docs, [table_path(sf_dir, "documents")])
        ev = _spread(spark, ev, "event_id") if small else ev
        e = ev.withColumn("_doc", F.col("event_id") % n_docs)
        e = e if small else _spread_for_join(spark, e, "_doc")
        j = e.join(docs, e["_doc"] == docs["doc_id"], "left")
    else:
        j = _spread(spark, ev, "event_id")
    eid = F.col("event_id")
    uid = F.col("user_id").cast("string")
    k = _k(F.col("props"))
    account = F.struct(
        F.when(eid % NULL_USER_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("user"), uid)).alias("username"),
        F.concat(F.lit("User "), uid).alias("display_name"),
        ((F.col("user_id") * 37 + eid) % FOLLOWERS_MOD).cast("bigint").alias("followers_count"),
    )
    language = (F.when(eid % NULL_LANGUAGE_MOD == 0, F.lit(None).cast("string"))
                 .when(eid % UNKNOWN_LANGUAGE_MOD == 0, F.lit("unknown"))
                 .otherwise(F.col("lang")))
    tags = (F.when(eid % EMPTY_TAGS_MOD == 0, F.array().cast("array<string>"))
             .otherwise(F.array(F.col("event_type"), F.concat(F.lit("k"), k))))
    made = {
        "id": eid.cast("string"),
        "created_at": F.col("ts"),
        "content": F.col("text"),
        "account": account,
        "language": language,
        "favourites_count": F.when(eid % NULL_FAVOURITES_MOD == 0, F.lit(None).cast("bigint"))
                             .otherwise(F.floor(F.col("value")).cast("bigint")),
        "reblogs_count": F.expr("try_cast(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"),
        "replies_count": (eid % REPLIES_MOD).cast("bigint"),
        "url": F.concat(F.lit(URL_PREFIX), uid, F.lit("/"), eid.cast("string")),
        "tags": tags,
    }
    return j.select(*[made[c].alias(c) for c in COLUMNS if c in columns])


def iso_created_at(ts: Column) -> Column:
    """Timestamp -> ISO-8601 text with explicit UTC offset (producer form)."""
    return F.concat(F.date_format(ts, ISO_MICROS), F.lit("+00:00"))


def _post_struct(p: DataFrame, with_language: bool) -> Column:
    """The record of a post, of the columns that ``p`` has."""
    made = {"created_at": iso_created_at(F.col("created_at"))}
    return F.struct(*[made.get(c, F.col(c)).alias(c) for c in COLUMNS
                      if c in p.columns and (with_language or c != "language")])


def raw_posts(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Kafka-shaped JSON values of the canonical posts: ``seq, key, value``.

    Nulls are written (``ignoreNullFields=false``); some records leave the
    ``language`` key out (missing, not null) and some are broken JSON. Other
    columns than ``columns`` are left out of the records.
    """
    p = posts(spark, sf_dir, columns)
    opts = {"ignoreNullFields": "false"}
    eid = F.col("id").cast("bigint")
    value = (F.when(eid % BAD_JSON_MOD == 0, F.lit("{bad"))
              .when(eid % MISSING_LANGUAGE_KEY_MOD == 0, F.to_json(_post_struct(p, False), opts))
              .otherwise(F.to_json(_post_struct(p, True), opts)))
    return p.select(eid.alias("seq"), F.col("id").alias("key"), value.alias("value"))


def raw_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped JSON statuses (tags are ``{"name": ...}`` objects)."""
    p = posts(spark, sf_dir)
    opts = {"ignoreNullFields": "false"}
    st = F.struct(
        F.col("id"), iso_created_at(F.col("created_at")).alias("created_at"),
        F.col("content"), F.col("account"), F.col("language"),
        F.col("favourites_count"), F.col("reblogs_count"), F.col("replies_count"),
        F.col("url"),
        F.when(F.col("id").cast("bigint") % NULL_TAGS_MOD == 0,
               F.lit(None).cast("array<struct<name:string>>"))
         .otherwise(F.transform("tags", lambda t: F.struct(t.alias("name")))).alias("tags"))
    return p.select(F.col("id").cast("bigint").alias("seq"), F.to_json(st, opts).alias("value"))


def post_log(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Append log of posts with re-emissions: ``seq`` orders versions and the
    latest version of a post id must win on upsert. One read: a generator
    gives each post its one or two versions."""
    p = posts(spark, sf_dir, columns)
    seq = F.col("id").cast("bigint")
    version = lambda n, fav: F.struct(n.alias("seq"), fav.alias("_favourites"))
    first = version(seq, F.col("favourites_count"))
    again = version(seq + REEMIT_SEQ_OFFSET, F.col("favourites_count") + 5)
    versions = F.when(F.array_contains("tags", REEMIT_TAG), F.array(first, again)).otherwise(F.array(first))
    return (p.select("*", F.inline(versions)).withColumn("favourites_count", F.col("_favourites"))
             .drop("_favourites"))


def raw_log(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The post log as JSON records: ``seq, value``."""
    p = post_log(spark, sf_dir, columns)
    return p.select("seq", F.to_json(_post_struct(p, True), {"ignoreNullFields": "false"}).alias("value"))


def canonical_json_rows(p: DataFrame) -> DataFrame:
    """Posts in canonical record shape (``created_at`` as ISO text), ready
    for a JSON-lines archive or a topic."""
    return p.select(_post_struct(p, True).alias("r")).select("r.*")
