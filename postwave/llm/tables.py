"""Shared helpers of the operators: input columns, words, written tables and
size-checked joins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.operators.joins import broadcast_limit, decoded_bytes
from postwave.session import shared_path

# The characters between words (space and \t \n \x0b \x0c \r).
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
# An operator may hold a dozen of these at a time, next to Python workers.
MOST_BROADCAST = 8 << 20
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % m, F.lit(-1))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends
    there, so a lost executor costs no recomputation before this point."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_merge(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast when its decoded size is measured within
    MOST_BROADCAST and the session's limit, for a shuffled join otherwise.
    ``df`` should be a written table or cheap to compute, as measuring reads
    it once."""
    spark = df.sparkSession
    small = decoded_bytes(df) <= min(MOST_BROADCAST, broadcast_limit(spark))
    return F.broadcast(df) if small else df.hint("merge")


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with Arrow batches of so many rows in its session: long texts
    then take little memory in a Python worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df
