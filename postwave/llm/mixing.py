"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of the requested words. A source whose
share is above ``max_epochs`` times its size is clamped there, and what it
cannot give is shared again among the others by weight, until no share is
above its cap. The share is then taken as whole repetitions of every document
plus one seeded fraction of a repetition.

The fraction is a prefix of the source's documents in seeded order, cut where
the words taken come nearest to the target. The cut is found in two steps, so
that a source of any size is never sorted in one task: words per (source,
bucket of the seeded order) are summed and scanned first, and only the
documents of the one bucket that holds the cut are put in order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postwave.llm.tables import read, small_or_merge, word_count, written

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MAX_EPOCHS = 2
SEED = 17
# Buckets of the seeded order: the top 12 of its 32 bits.
BUCKET_BITS = 12


def _source_key(source: Column) -> Column:
    """A text for joins that keeps the null source apart from every other."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def repeating_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """source, weight: the given weights dealt over the distinct sources in
    code point order, null last. One row per source goes through one task."""
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return (sources.select("source").distinct().withColumn("i", (n - 1) % len(weights))
            .select("source", F.element_at(F.array(*map(F.lit, weights)), F.col("i").cast("int") + 1)
                    .alias("weight")))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (one row each, with size and weight) with ``target``.

    Each turn reads two sums: what the clamped sources give and the weight of
    the others. The level only rises, so clamped sources stay clamped; it ends
    when a turn clamps none. A source without words or weight gets 0.
    """
    cap, weight = max_epochs * F.col("size"), F.col("weight")
    level, clamped = 0.0, -1
    over = F.lit(False)
    while True:
        s = sources.agg(F.sum(F.when(over, cap)).alias("given"), F.count_if(over).alias("clamped"),
                        F.sum(F.when(~over, weight)).alias("weight")).first()
        if s["clamped"] == clamped or not s["weight"]:
            break
        clamped, level = s["clamped"], (total - (s["given"] or 0)) / s["weight"]
        over = weight * F.lit(level) > cap
    return sources.withColumn("target", F.when(over, cap).otherwise(weight * F.lit(level)).cast("double"))


def _turn(seed: int) -> Column:
    """32 bits of the seeded order."""
    return F.conv(F.substring(F.md5(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long")


def _keyed(docs: DataFrame, seed: int, *keep: str) -> DataFrame:
    return docs.select(
        *keep, "doc_id", _source_key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"),
        _turn(seed).alias("turn")).withColumn("bucket", F.shiftright("turn", 32 - BUCKET_BITS))


def _plan(sizes: DataFrame, weights: DataFrame | None, total: float, max_epochs: float):
    """Per source: source_size, target, whole repetitions, the words needed
    beyond them, the bucket that holds the cut and the words before it. And
    doc_id, size, key, turn, more (1 to take once more) in the cut buckets."""
    per_bucket = written(sizes.groupBy("source", "key", "bucket").agg(F.sum("size").alias("size")),
                         "mix-buckets")
    per_source = per_bucket.groupBy("source", "key").agg(F.sum("size").alias("size"))
    weights = repeating_weights(per_source) if weights is None else weights
    weights = weights.select(_source_key(F.col("source")).alias("key"), "weight")
    per_source = written(per_source.join(weights, "key", "left").na.fill(0, ["weight"]), "mix-sources")
    words = per_source.agg(F.sum("size")).first()[0] or 0
    plan = water_fill(per_source, total * words, max_epochs).select(
        "key", F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
        .cast("long").alias("whole"))
    plan = plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    before = (F.sum("size").over(Window.partitionBy("key").orderBy("bucket"))
              - F.col("size")).alias("before")
    cuts = (per_bucket.select("key", "bucket", "size", before).join(plan.select("key", "need"), "key")
            .where("before <= need").groupBy("key")
            .agg(F.max_by("before", "bucket").alias("before"), F.max("bucket").alias("cut")))
    plan = small_or_merge(written(plan.join(cuts, "key", "left"), "mix-plan"))
    running = F.sum("size").over(Window.partitionBy("key").orderBy("turn", "doc_id", "size")
                                 .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    near = (sizes.join(plan, "key").where("bucket = cut")
            .withColumn("mid", F.col("before") + running + F.col("size") / 2)
            .withColumn("more", (F.col("mid") <= F.col("need")).cast("long")))
    return plan, near


def mix(docs: DataFrame, weights: DataFrame | None = None, total: float = TOTAL,
        max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times
    (whole and fractional repetitions as a count) and taken.

    ``total`` is a multiple of all words. ``weights`` (source, weight) may be
    given; by default they repeat ``WEIGHTS``. Null source: a source of its
    own. Null or empty text: size 0, nothing taken from it. Rows with the same
    id are separate documents; those that tie in the seeded order are taken by
    size. An empty table gives no rows. Columns besides doc_id, text and
    source are not read.
    """
    sizes = written(_keyed(docs, seed, "source"), "mix-sizes")
    plan, near = _plan(sizes, weights, total, max_epochs)
    rest = sizes.join(plan, "key").where("cut is null or bucket != cut").withColumn(
        "more", F.coalesce(F.col("bucket") < F.col("cut"), F.lit(False)).cast("long"))
    times = F.col("whole") + F.col("more")
    return near.drop("mid").unionByName(rest).select(
        "doc_id", "source", "size", "source_size", "target", times.alias("times"),
        (times * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, total: float = TOTAL,
          max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``mix`` takes it.
    Texts stay where they are: how often follows from the source's plan, and
    for the few documents of the cut buckets from a small table."""
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text")
    plan, near = _plan(written(_keyed(docs, seed, "source"), "mix-sizes"), weights, total, max_epochs)
    near = small_or_merge(written(near.groupBy(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "key", "size")
        .agg(F.max("more").alias("more")), "mix-near"))
    rows = _keyed(row, seed, "row").withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    times = F.col("whole") + F.coalesce(F.when(F.col("bucket") == F.col("cut"), F.col("more")),
                                        (F.col("bucket") < F.col("cut")).cast("long"), F.lit(0))
    return (rows.join(plan, "key").join(near, ["id", "key", "size"], "left")
            .select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("_"))
            .select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS turn
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, 1.5 * sum(size) OVER () AS total,
         sum(2.0 * size) OVER by_ratio - 2.0 * size AS given,
         sum(weight) OVER () - sum(weight) OVER by_ratio + weight AS others
  FROM s WINDOW by_ratio AS (ORDER BY 2.0 * size / weight, source ROWS UNBOUNDED PRECEDING)),
lv AS (
  SELECT max((total - given)::DOUBLE / others) AS level FROM f
  WHERE (total - given)::DOUBLE / others * weight <= 2.0 * size),
t AS (
  SELECT source, size AS source_size, least(2.0 * size, weight * coalesce(level, 0))::DOUBLE AS target,
         CASE WHEN size > 0 THEN floor(least(2.0 * size, weight * coalesce(level, 0))::DOUBLE / size) ELSE 0 END
           AS whole
  FROM s, lv),
r AS (
  SELECT d.doc_id, d.size, source_size, target, whole, target - whole * source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2.0
           AS mid
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN mid <= need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""
