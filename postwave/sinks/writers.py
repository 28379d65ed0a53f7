"""Sinks: Kafka-shaped frames, JSON-lines archives, console.

Kafka I/O needs the ``spark-sql-kafka`` package on the classpath
(``--packages``); the frame builders here are what gets written, and they
are tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

JSON_OPTS = {"ignoreNullFields": "false"}
# Files of whole records are gzipped (readers see it by the name)
# and end after so many records, as one task must read such a file.
RECORD_FILES = {"compression": "gzip", "maxRecordsPerFile": "50000"}


def kafka_value_frame(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Unkeyed JSON value per row (nulls written, as ``json.dumps`` does)."""
    out = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTS).alias("value"))
    if topic:
        out = out.withColumn("topic", F.lit(topic))
    return out


def kafka_keyed_frame(df: DataFrame, key_col: str = "id", topic: str | None = None) -> DataFrame:
    """``key = str(id)``, ``value = JSON`` of the row."""
    out = df.select(F.col(key_col).cast("string").alias("key"),
                    F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTS).alias("value"))
    if topic:
        out = out.withColumn("topic", F.lit(topic))
    return out


class SinkSchemaError(ValueError):
    pass


def typed_frame(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` as a declared sink takes it: the columns of ``schema`` in its
    order. A column that is missing, not declared or of another type is an
    error before anything is written; what may be null is not compared."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    wrong = [f"{n}: missing" for n in want if n not in have]
    wrong += [f"{n}: not declared" for n in have if n not in want]
    wrong += [f"{n}: {have[n]}, declared {want[n]}" for n in want if n in have and have[n] != want[n]]
    if wrong:
        raise SinkSchemaError("the sink's schema does not fit: " + "; ".join(wrong))
    return df.select(*[F.col(f"`{n}`") for n in want])


def publish(frame: DataFrame, topic: str, bootstrap: str | None = None, send=None) -> dict:
    """Sends a batch of Kafka-shaped records and tells what came of it:
    ``topic``, ``outcome`` (``delivered`` / ``failed``), ``records`` delivered
    and the ``error``. The records are counted as they are sent. ``send(frame,
    topic)`` is the connector's writer by default."""
    seen = Observation()
    counted = frame.observe(seen, F.count(F.lit(1)).alias("records"))
    try:
        (send or (lambda f, t: write_kafka(f, bootstrap, t)))(counted, topic)
    except Exception as e:  # the connector's or the cluster's; the caller decides what to do
        return {"topic": topic, "outcome": "failed", "records": 0, "error": str(e).splitlines()[0]}
    return {"topic": topic, "outcome": "delivered", "records": seen.get["records"], "error": None}


def write_kafka(frame: DataFrame, bootstrap: str, topic: str | None = None):
    w = frame.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic:
        w = w.option("topic", topic)
    return w.save()


def write_jsonl(df: DataFrame, path: str, append: bool = True) -> None:
    """Append (or overwrite) JSON lines; the writer creates the folder.
    Each task writes its own part files, so the archive scales with executors."""
    df.write.mode("append" if append else "overwrite").options(**JSON_OPTS, **RECORD_FILES).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch re-read of an archive with the declared schema (no inference)."""
    return spark.read.schema(schema).json(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a JSON-lines archive, or an empty typed frame if it is missing."""
    try:
        return spark.read.schema(schema).json(path)
    except Exception as e:  # PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence probe through the Hadoop filesystem. An error of the file
    system is raised: it does not say that nothing is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def console(df: DataFrame, rows: int) -> None:
    """Show ``rows`` rows in full; the number must be named, as the rest is
    not shown."""
    df.show(rows, truncate=False)
