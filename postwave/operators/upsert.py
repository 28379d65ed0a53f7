"""Keyed tables where the latest version of a document wins.

``upsert_latest`` replaces "index document by id" with an aggregation:
``max_by(row, ordering)`` per key. Being an aggregate, it is combined
partially on the map side, so a key with millions of re-emissions (a hot
group of copies) shrinks to one row per input partition before the shuffle
instead of landing whole in one task, as a ``row_number`` window would.
Rows with a NULL key are new documents: each record is kept once.

``conform`` enforces the typed table mapping with ``try_cast`` and reports
rows that do not fit instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType


def upsert_latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per non-NULL ``key`` (greatest ``order`` tuple wins) plus one
    row per NULL-key record.

    ``order`` must identify a record, as ``["seq"]`` or Kafka's
    ``["timestamp", "partition", "offset"]`` do. NULL-key rows are grouped by
    that tuple, so each record stays its own document and a re-delivered copy
    of the same record collapses. This is a single aggregate: the input is
    read once, and a hot key (or a mass of NULL keys) is combined, or spread
    by its order tuple, before the shuffle."""
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])
    k = F.col(key)
    return (df.groupBy(k.alias("_k"), F.when(k.isNull(), ordering).alias("_n"))
            .agg(F.max_by(row, ordering).alias("_r"))
            .select("_r.*"))


def conform(df: DataFrame, schema: StructType, stamp_col: str | None = "indexed_at") -> DataFrame:
    """Cast every column of ``schema`` (``try_cast``; dates via
    ``try_to_timestamp``), stamp ``indexed_at`` and flag rows where a
    non-NULL input did not survive the cast (``conform_ok``)."""
    outs, ok = [], F.lit(True)
    for f in schema.fields:
        if f.name == stamp_col:
            outs.append(F.current_timestamp().alias(f.name))
            continue
        if f.name not in df.columns:
            outs.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            c = F.try_to_timestamp(src.cast("string")) if dict(df.dtypes)[f.name] == "string" \
                else src.cast(f.dataType)
        else:
            c = src.try_cast(f.dataType)
        outs.append(c.alias(f.name))
        ok = ok & (src.isNull() | c.isNotNull())
    return df.select(*outs, ok.alias("conform_ok"))
