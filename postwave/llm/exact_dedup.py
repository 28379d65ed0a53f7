"""Exact duplicates by stateful streaming.

A streaming aggregate keeps, per digest of the normalised text, the digest,
the smallest document id with the place of its content, and the number of
rows. The state lives in the session's disk-backed state store, has no
watermark and never expires, so a later run on the same ``state`` folder goes
on where the last one stopped and only reads new files.

A digest seen twice is only a hit. Each hit is then settled on the full bytes:
the text of every row of the group is compared with the text found at the
group's content locator. Rows that share the digest but not the bytes form
groups of their own.

Everything is DataFrame code. The group that holds a third of all rows costs
one state row, as rows combine before the shuffle; for the byte check its rows
are dealt over ``ceil(rows / SALT_ROWS)`` salts with one copy of the kept text
each.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm.tables import SPACES, small_or_merge, written
from postwave.session import shared_path

# Rows of one group that are compared with one copy of the kept text.
SALT_ROWS = 2_000


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, place, norm and text_sha256 of every row; null text is empty."""
    flat = docs.select(
        "doc_id", F.struct("_metadata.file_path", "_metadata.row_index").alias("place"),
        F.translate(F.coalesce("text", F.lit("")), SPACES, " " * len(SPACES)).alias("flat"))
    norm = flat.select("doc_id", "place", F.when(
        F.instr("flat", "  ") > 0, F.regexp_replace("flat", " {2,}", " ")
    ).otherwise(F.col("flat")).alias("norm"))
    return norm.select("doc_id", "place", "norm", digest(F.col("norm")).alias("digest"))


def _first() -> Column:
    """Sorts by id, ids before null, then by place."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")


def fold(spark: SparkSession, path: str, state: str, digest=sha256,
         files_per_batch: int = 1000) -> DataFrame:
    """Feed the files under ``path`` that ``state`` has not seen to the stream
    and return its groups: digest, first (id and place), n."""
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    # as a pattern the path may also be one file, which the stream refuses otherwise
    path = path.rstrip("/")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(f"{path[:-1]}[{path[-1]}]"))
    seen = (_keyed(stream, digest).select("digest", _first().alias("first"))
            .groupBy("digest").agg(F.min("first").alias("first"), F.count("*").alias("n")))
    log = f"{state}/groups"

    def keep(batch: DataFrame, number: int) -> None:
        # a batch that is run again writes the same rows to the same place
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    # many small state stores: none of them claims megabytes of log in advance
    setting = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    was = spark.conf.get(setting, None)
    spark.conf.set(setting, "false")
    try:
        query = (seen.writeStream.outputMode("update").foreachBatch(keep)
                 .option("checkpointLocation", f"{state}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.unset(setting) if was is None else spark.conf.set(setting, was)
    if not _exists(spark, log):
        return spark.createDataFrame([], seen.schema)
    # the state is sent again whenever it changes; the last has the most rows
    return (spark.read.schema(seen.schema).parquet(log).groupBy("digest")
            .agg(F.min("first").alias("first"), F.max("n").alias("n")))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def exact_dedup(spark: SparkSession, path: str, state: str | None = None,
                digest: Callable[[Column], Column] = sha256,
                files_per_batch: int = 1000) -> DataFrame:
    """One row per document under ``path``: doc_id, keep_id, group_size, kept,
    text_sha256.

    - null text counts as empty; all empty texts are one group;
    - of equal texts the row with the smallest doc_id stays, one with a null
      id only if the whole group has none; of rows that share that id the
      first by file and row;
    - an empty table gives no rows; columns besides doc_id and text are not
      read; ``digest`` may be weak (tests use one), as hits compare bytes.
    """
    state = state or shared_path(spark, "exact-dedup")
    groups = written(fold(spark, path, state, digest, files_per_batch), "dedup-groups")
    hits = small_or_merge(groups.where("n > 1").select(
        "digest", "n", F.col("first.doc_id").alias("keep_id"),
        F.col("first.place").alias("keep_place")))
    rows = written(
        _keyed(spark.read.parquet(path), digest).join(hits, "digest", "left")
        .withColumn("sha", sha256(F.col("norm")) if digest is not sha256 else F.col("digest"))
        .withColumn("norm", F.when(F.col("n").isNotNull(), F.col("norm"))),
        "dedup-rows")
    alone = rows.where("n is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))

    # full bytes of each hit against the text at the group's content locator
    salts = F.ceil(F.col("n") / SALT_ROWS)
    members = (rows.where("n is not null")
               .withColumn("salt", F.pmod(F.xxhash64("doc_id", "place"), salts)))
    kept = (rows.where("place = keep_place")
            .select("digest", "n", F.col("norm").alias("kept_text"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n"))
    same = F.col("norm") == F.col("kept_text")
    checked = written(
        members.join(kept, ["digest", "salt"])
        .select("doc_id", "place", "digest", "sha", "n", "keep_id", "keep_place", same.alias("same"),
                F.when(~same, F.col("norm")).alias("other")), "dedup-checked")
    others = checked.where("not same")
    fewer = others.groupBy("digest").agg(F.count("*").alias("less"))
    equal = (checked.where("same").join(small_or_merge(fewer), "digest", "left")
             .select("doc_id", "keep_id", (F.col("n") - F.coalesce("less", F.lit(0))).alias("group_size"),
                     F.col("sha").alias("text_sha256"),
                     (F.col("place") == F.col("keep_place")).alias("first")))
    by_bytes = (others.groupBy("digest", "other")
                .agg(F.min(_first()).alias("first"), F.count("*").alias("group_size")))
    unequal = (others.join(by_bytes, ["digest", "other"])
               .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                       F.col("sha").alias("text_sha256"),
                       _first().eqNullSafe(F.col("first")).alias("first")))
    found = equal.unionByName(unequal).select(
        "doc_id", "keep_id", "group_size", F.col("first").alias("kept"), "text_sha256")
    return alone.unionByName(found)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
