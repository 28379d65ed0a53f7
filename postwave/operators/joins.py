"""Join-side choice on a proven size.

Spark's static planner estimates a string column at a fixed 20 bytes, so a
table of long texts looks far smaller than it is and can be broadcast by
estimate. ``sized_side`` decides from sizes that are known instead:

1. the table's files on disk (a metadata listing, no scan). Above the limit
   the side is never broadcast and never measured: a decoded row is never
   smaller than its compressed parquet form, so it cannot fit either;
2. otherwise the exact decoded size of the columns the side carries, from
   one aggregate over a table that is at most ``limit`` bytes on disk.

At or under the limit the side is marked ``broadcast``; above it, ``merge``
(shuffle both sides on the key). The limit comes from the session setting
``spark.postwave.broadcastLimitBytes`` (default 64 MiB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

LIMIT_CONF = "spark.postwave.broadcastLimitBytes"
DEFAULT_LIMIT = 64 << 20

# decisions per (paths, their size and file count, columns, limit): inputs
# are immutable tables, and a changed table changes its size or file count
_DECISIONS: dict[tuple, bool] = {}


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(LIMIT_CONF, str(DEFAULT_LIMIT)))


def files_on_disk(spark: SparkSession, paths: list[str]) -> tuple[int, int]:
    """(bytes, files) under ``paths`` from the filesystem's metadata."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    size = files = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        cs = hp.getFileSystem(conf).getContentSummary(hp)
        size += cs.getLength()
        files += cs.getFileCount()
    return size, files


def _beyond_word(c: Column, t: DataType) -> Column:
    """Bytes of a value besides the 8-byte word of its field: the bytes of
    strings and binaries, and all that arrays, structs and maps hold."""
    none = F.lit(0).cast("bigint")
    if isinstance(t, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c).cast("bigint"), none)
    if isinstance(t, ArrayType):
        return F.coalesce(F.aggregate(c, none, lambda s, x: s + 8 + _beyond_word(x, t.elementType)), none)
    if isinstance(t, MapType):
        return (_beyond_word(F.map_keys(c), ArrayType(t.keyType))
                + _beyond_word(F.map_values(c), ArrayType(t.valueType)))
    if isinstance(t, StructType):
        total = F.lit(8 * len(t.fields)).cast("bigint")
        for f in t.fields:
            total = total + _beyond_word(c.getField(f.name), f.dataType)
        return total
    return none


def decoded_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as Spark rows: an 8-byte word per field plus a null
    word per row, plus what strings, binaries, arrays, structs and maps hold."""
    per_row = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    for f in df.schema.fields:
        per_row = per_row + _beyond_word(F.col(f"`{f.name}`"), f.dataType)
    got = df.agg(F.sum(per_row).alias("b")).first()["b"]
    return int(got or 0)


def fits_broadcast(spark: SparkSession, df: DataFrame, paths: list[str],
                   limit: int | None = None) -> bool:
    limit = broadcast_limit(spark) if limit is None else limit
    disk, files = files_on_disk(spark, paths)
    key = (tuple(paths), disk, files, tuple(df.columns), limit)
    if key not in _DECISIONS:
        _DECISIONS[key] = disk <= limit and decoded_bytes(df) <= limit
    return _DECISIONS[key]


def sized_side(spark: SparkSession, df: DataFrame, paths: list[str],
               limit: int | None = None) -> DataFrame:
    """``df`` hinted ``broadcast`` when its size is proven under the limit,
    else ``merge``."""
    return F.broadcast(df) if fits_broadcast(spark, df, paths, limit) else df.hint("merge")
