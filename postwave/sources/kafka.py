"""Topic sources: Kafka when its connector is on the classpath, file replay
otherwise. Both yield the Kafka source shape (``value`` text plus
``topic``/``partition``/``offset``/``timestamp`` where known)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, topics: str | list[str], bootstrap: str,
               starting_offsets: str = "earliest", streaming: bool = True,
               group_id: str | None = None, max_offsets_per_trigger: int | None = 5_000_000,
               **options) -> DataFrame:
    """Kafka topic(s) as ``key, value`` strings plus metadata columns.

    ``starting_offsets`` is honoured on first start only; afterwards offsets
    live in the query checkpoint. Needs ``spark-sql-kafka`` (``--packages``).
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    r = spark.readStream if streaming else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", names).option("startingOffsets", starting_offsets))
    if group_id:
        # a prefix: queries that share one group id may each read part of the data
        r = r.option("groupIdPrefix", group_id)
    if streaming and max_offsets_per_trigger:
        # a backlog is taken in batches of bounded size
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"),
                           "topic", "partition", "offset", "timestamp")


def read_replay(spark: SparkSession, path: str, topic: str | None = None,
                streaming: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a topic: one record per line in ``value``."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = r.load(path)
    else:
        df = spark.read.text(path)
    if topic:
        df = df.withColumn("topic", F.lit(topic))
    return df


def route_by_topic(df: DataFrame, topics: list[str]) -> dict[str, DataFrame]:
    """Split one multi-topic frame into a frame per topic (a filter each;
    in streaming, use inside ``foreachBatch`` on a persisted batch so the
    input is read once)."""
    return {t: df.filter(F.col("topic") == F.lit(t)) for t in topics}
