"""Changes with their kind: what a query's answer, or a view, gains and loses in
every micro-batch.

The kinds are those of a changelog: ``+I`` a new row, ``-U`` and ``+U`` a row
that is replaced, before and after, ``-D`` a row that is no longer there. They
come from comparing a batch's rows, by key, with the last emitted value of that
key, which is kept as a keyed table (``streaming.keyed``). The change rows and
the new last values are committed together, so each change is told once.

``changelog_job`` does so for a custom query. ``views_job`` does so for posts and
keeps the dashboard views by signed counts: a replaced version of a post takes
away what it had added. Scores are counted by value, so that the maximum stays
right when the post that had it is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.parse import normalise_created_at, parse_posts
from ..operators.transforms import engagement_score
from ..operators.upsert import upsert_latest
from .keyed import (META, MOST_KEYS, _read, compact, each_batch_once, lookup, read_rows, read_table, retire,
                    write_part)
from .manifest import ManifestLog

# The kinds of change.
NEW, BEFORE, AFTER, GONE = "+I", "-U", "+U", "-D"
LAST = ["seq"]


def key_text(columns: list[str]) -> Column:
    """The key as text; nulls are told apart from any text."""
    if not columns:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


def signed(new: DataFrame, old: DataFrame, complete: bool) -> DataFrame:
    """key, kind, row: the changes from ``old`` (key, row) to ``new`` (key,
    row). If ``new`` is ``complete``, keys that it lacks are gone."""
    a, b = F.col("new_row"), F.col("old_row")
    change = lambda kind, row: F.struct(F.lit(kind).alias("kind"), row.alias("row"))
    both = (new.withColumnRenamed("row", "new_row")
            .join(old.withColumnRenamed("row", "old_row"), "key", "full_outer" if complete else "left"))
    told = (F.when(b.isNull(), F.array(change(NEW, a))).when(a.isNull(), F.array(change(GONE, b)))
             .when(~a.eqNullSafe(b), F.array(change(BEFORE, b), change(AFTER, a))))
    return both.select("key", F.inline(told))


def _nodes(df: DataFrame) -> tuple[object | None, list[str], object]:
    """The topmost aggregation of a query, what stands above it, and its plan."""
    node = plan = df._jdf.queryExecution().analyzed()
    above: list[str] = []
    while node.nodeName() not in ("Aggregate", "Distinct"):
        if node.children().size() != 1:
            return None, above, plan
        above.append(node.nodeName())
        node = node.children().apply(0)
    return node, above, plan


def group_columns(df: DataFrame) -> list[str]:
    """The output columns that are the groups of a query's aggregation."""
    node, _, plan = _nodes(df)
    if node is None or node.nodeName() == "Distinct":
        return df.columns
    seq = lambda s: [s.apply(i) for i in range(s.size())]
    out = {str(a.exprId()): a.name() for a in seq(plan.output())}
    names = []
    for group in seq(node.groupingExpressions()):
        same = [e for e in seq(node.aggregateExpressions())
                if e.semanticEquals(group) or e.nodeName() == "Alias" and e.child().semanticEquals(group)]
        found = [out[str(e.exprId())] for e in same if str(e.exprId()) in out]
        if not found:
            raise ValueError(f"the query does not return its group {group.sql()}; name the key columns")
        names.append(found[0])
    return names


def changes_mode(df: DataFrame) -> str:
    """Spark's output mode that holds every change: ``append`` without an
    aggregation, ``update`` if the answer is the aggregation's rows, and
    ``complete`` if something above it can take a row away again."""
    node, above, _ = _nodes(df)
    if node is None:
        return "append"
    return "update" if set(above) <= {"Project", "SubqueryAlias"} else "complete"


def changelog_job(df: DataFrame, root: str, checkpoint: str, key: list[str] | None = None,
                  trigger: dict | None = None, compact_every: int = 8) -> StreamingQuery:
    """Writes the changes of a streaming query's answer under ``root``; read
    them with ``read_changes``. ``key`` names the columns that identify a row,
    by default the groups of its aggregation. Rows without an aggregation
    are all new."""
    mode = changes_mode(df)
    key = df.columns if mode == "append" else group_columns(df) if key is None else key
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])

    def job(batch: DataFrame, state: dict, part: str) -> dict:
        spark, tables = batch.sparkSession, state["tables"]
        number = F.lit(int(part.rsplit("-", 1)[1])).cast("bigint")
        if mode == "append":
            changes = batch.select(F.lit(NEW).alias("kind"), row.alias("row"))
            return {"tables": {"changes": write_part(spark, root, "changes", part, changes.select(
                number.alias("batch"), "kind", "row.*"), None, tables.get("changes"))}}
        new = batch.select(key_text(key).alias("key"), row.alias("row")).persist()
        old = last_values(spark, root, new.schema, None if mode == "complete" else new)
        changes = signed(new, old, mode == "complete").persist()
        try:
            told = write_part(spark, root, "changes", part, changes.select(number.alias("batch"), "kind", "row.*"),
                              None, tables.get("changes"))
            live = F.col("kind") != GONE
            kept = changes.where(F.col("kind") != BEFORE).select(
                "key", F.when(live, F.col("row")).alias("row"), live.alias("live"), number.alias("seq"))
            return {"tables": {"changes": told, "last": write_part(spark, root, "last", part, kept, "key", tables.get("last"))}}
        finally:
            changes.unpersist()
            new.unpersist()

    def after(log: ManifestLog, batch_id: int) -> None:
        if (batch_id + 1) % compact_every == 0:
            compact(df.sparkSession, f"{root}/last", "key", LAST, StructType(), log=log)

    job.after = after
    return each_batch_once(df, root, checkpoint, job, trigger, mode)


def last_values(spark: SparkSession, root: str, schema: StructType, of: DataFrame | None = None) -> DataFrame:
    """key, row of the rows that are in the answer now, at least those with a
    key of ``of``. Up to MOST_KEYS keys are looked up, which opens few files;
    with more the table is read."""
    kept = StructType(schema.fields).add("live", "boolean").add("seq", "long")
    keys = [] if of is None else [r.key for r in of.select("key").limit(MOST_KEYS + 1).collect()]
    if 0 < len(keys) <= MOST_KEYS:
        rows = lookup(spark, f"{root}/last", "key", LAST, kept, keys)
    else:
        rows = read_table(spark, f"{root}/last", "key", LAST, kept)
    return rows.where("live").select("key", "row")


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """batch, kind and the answer's columns, of all changes so far."""
    return read_rows(spark, root, "changes")


def folded(changes: DataFrame) -> DataFrame:
    """The answer that ``changes`` (without their batch) lead to."""
    columns = [f"`{c}`" for c in changes.columns if c != "kind"]
    sign = F.when(F.col("kind").isin(NEW, AFTER), 1).otherwise(-1)
    return (changes.groupBy(*columns).agg(F.sum(sign).alias("_times")).where("_times > 0")
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*columns))


# ---- dashboard views --------------------------------------------------------

VIEWED = "id string, language string, bucket timestamp, tags array<string>, score bigint"


def _counts(changes: DataFrame) -> DataFrame:
    """view, name, score, n: what the changes add to the views. A view's rows
    are combined before they are shuffled."""
    sign = F.when(F.col("kind").isin(NEW, AFTER), 1).otherwise(-1).cast("bigint")
    text, none = lambda c: c.cast("string"), F.lit(None).cast("bigint")
    entry = lambda view, name, score: F.struct(
        F.lit(view).alias("view"), text(name).alias("name"), score.alias("score"))
    r = F.col("row")
    entries = F.concat(
        F.array(entry("language", r.language, none), entry("hour", r.bucket, none),
                entry("score", F.lit(None), r.score)),
        F.coalesce(F.transform(r.tags, lambda t: entry("tag", t, none)), F.array()))
    return (changes.select(sign.alias("n"), F.inline(entries)).groupBy("view", "name", "score")
            .agg(F.sum("n").alias("n")).where("n != 0"))


def views_job(raw: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
              compact_every: int = 8, value_col: str = "value") -> StreamingQuery:
    """Keeps the dashboard views of a stream of posts in which a later version
    replaces an earlier one with its id (by Kafka's place or ``seq``, in
    whatever order they come). Read them with ``read_views``."""
    order = [c for c in META if c in raw.columns]

    def job(batch: DataFrame, state: dict, part: str) -> dict:
        spark, tables = batch.sparkSession, state["tables"]
        posts = engagement_score(parse_posts(batch, value_col, keep=order))
        row = F.struct("id", "language", F.date_trunc("hour", normalise_created_at(F.col("created_at"))).alias("bucket"),
                       "tags", F.col("engagement_score").alias("score"))
        posts = upsert_latest(posts.select("id", row.alias("row"), *order), "id", order)
        place = F.struct(*order)
        # a post without id is a document of its own, named by its place
        new = posts.select(F.coalesce(F.concat(F.lit("i"), "id"), F.concat(F.lit("p"), F.to_json(place))).alias("key"),
                           "row", *order)
        kept = new.schema
        old = read_table(spark, f"{root}/posts", "key", order, kept).select(
            "key", F.col("row").alias("was"), F.struct(*order).alias("was_at"))
        # a version that is older than the one we know changes nothing
        new = (new.join(old, "key", "left").where(F.col("was_at").isNull() | (place > F.col("was_at")))
               .select(*new.columns, "was").persist())
        try:
            changes = signed(new.select("key", "row"), new.where("was is not null").select("key", F.col("was").alias("row")),
                             False)
            deltas = write_part(spark, root, "deltas", part, _counts(changes), None, tables.get("deltas"))
            return {"tables": {"deltas": deltas, "posts": write_part(
                spark, root, "posts", part, new.drop("was"), "key", tables.get("posts"))}}
        finally:
            new.unpersist()

    def after(log: ManifestLog, batch_id: int) -> None:
        if (batch_id + 1) % compact_every == 0:
            compact(raw.sparkSession, f"{root}/posts", "key", order, StructType(), log=log)
            compact_counts(raw.sparkSession, root, log=log)

    job.after = after
    return each_batch_once(raw, root, checkpoint, job, trigger)


def _summed(spark: SparkSession, root: str, files: list[dict], schema) -> DataFrame:
    return (_read(spark, root, files, schema).groupBy("view", "name", "score")
            .agg(F.sum("n").alias("n")).where("n != 0"))


def compact_counts(spark: SparkSession, root: str, fan: int = 4, log: ManifestLog | None = None) -> None:
    """Adds up the parts of the signed counts, ``fan`` of a level to one of the
    next."""
    log, level = log or ManifestLog(spark, root), 0
    while True:
        t = log.state()["tables"]["deltas"]
        mine = [f for f in t["files"] if f["level"] == level]
        if len({f["path"].rsplit("/", 1)[0] for f in mine}) >= fan:
            part = f"sum-{log.state()['version'] + 1:012d}"
            told = write_part(spark, root, "deltas", part, _summed(spark, root, mine, t["schema"]), None, t)
            told["add"] = [{**f, "level": level + 1} for f in told["add"]]
            log.commit(lambda s: {"tables": {"deltas": {**told, "drop": [f["path"] for f in mine]}}})
        if not any(f["level"] > level for f in log.state()["tables"]["deltas"]["files"]):
            break
        level += 1
    retire(spark, root, log=log)


def read_views(spark: SparkSession, root: str, tags: int = 10) -> dict[str, DataFrame]:
    """The four dashboard views as they are now: ``language_share``,
    ``volume_over_time``, ``top_hashtags`` (the first ``tags``) and
    ``engagement``."""
    t = ManifestLog(spark, root).state()["tables"]["deltas"]
    counts = _summed(spark, root, t["files"], t["schema"])
    of = lambda view: counts.where(F.col("view") == view)
    total = F.sum("post_count").over(Window.partitionBy())
    s, n = F.col("score"), F.col("n")
    return {
        "language_share": of("language").select(F.col("name").alias("language"), n.alias("post_count"))
        .select("language", "post_count", (F.col("post_count") / total).alias("share")),
        "volume_over_time": of("hour").select(F.col("name").cast("timestamp").alias("bucket"), n.alias("post_count")),
        "top_hashtags": of("tag").select(F.col("name").alias("tag"), n.alias("tag_count"))
        .orderBy(F.desc("tag_count"), "tag").limit(tags),
        "engagement": of("score").agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("posts"),
            F.coalesce(F.sum(F.when(s.isNotNull(), n)), F.lit(0)).alias("scored_posts"),
            (F.sum(s * n).cast("double") / F.sum(F.when(s.isNotNull(), n))).alias("avg_engagement"),
            F.max(s).alias("max_engagement"), F.sum(s * n).alias("total_engagement")),
    }
