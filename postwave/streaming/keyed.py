"""Keyed tables fed by a stream: latest version of a record wins.

The tables of one job lie under a common folder ``<base>`` and share its
manifest log (``streaming.manifest``). A micro-batch writes the typed records of
each table as a part (``<base>/<table>/part-...``), the records that do not
decode or do not fit the table's types as rejects with a reason, and then
commits all of them, with the counts, as one change. Until then nothing of it is
seen. A batch that was committed is not written again when it is retried.

Parts wait at level 0. ``compact`` merges them into runs, one per bucket of the
key's hash, at level 1; a bucket with ``FAN`` runs at a level has them merged into
one run of the next level, so levels grow by that factor and a record is
rewritten once per level. Buckets that no new key fell into are left alone.
Replaced files stay for ``GRACE_SECONDS``, for readers that started before.

The table is read as ``upsert_latest`` over the files that the manifest names.
``lookup`` reads a few keys: it opens only files of the key's bucket whose key
range and Bloom filter allow it.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructField, StructType, TimestampType

from ..functions.parse import field, is_record, object_text, record
from ..operators.upsert import upsert_latest
from ..sources.kafka import route_by_topic
from .manifest import ManifestLog

META = ("timestamp", "partition", "offset", "seq")
BUCKETS, FAN = 16, 4
# Bytes of a bucket's run that one task writes.
RUN_BYTES = 256 << 20
GRACE_SECONDS = 24 * 3600
# Bloom filters: hashes and bits per key, and the bits of one stored piece.
HASHES, BITS, PIECE = 4, 10, 32768
MOST_KEYS = 10_000


def checkpoint_name(checkpoint: str) -> str:
    """A short name of a checkpoint location, the same on every start."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def part_name(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint_name(checkpoint)}-{batch_id:012d}"


def _split(root: str) -> tuple[str, str]:
    """The common folder and the table's name."""
    base, name = root.rstrip("/").rsplit("/", 1)
    return base, name


def _table(spark: SparkSession, root: str) -> dict | None:
    base, name = _split(root)
    return ManifestLog(spark, base).state()["tables"].get(name)


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The number of the table's last compaction, if there was one."""
    t = _table(spark, root)
    return [] if t is None or t["snapshot"] is None else [t["snapshot"]]


def _merged(a: str | None, b: StructType) -> str:
    """The fields of both schemas; what is in both keeps the newer type."""
    old = [] if a is None else StructType.fromJson(a).fields
    new = {f.name for f in b.fields}
    return StructType([StructField(f.name, f.dataType) for f in b.fields]
                      + [f for f in old if f.name not in new]).jsonValue()


def _read(spark: SparkSession, base: str, files: list[dict], schema) -> DataFrame:
    """The rows of the named files. The schema is given, so none is opened to
    find it out."""
    return spark.read.schema(StructType.fromJson(schema)).parquet(*[f"{base}/{f['path']}" for f in files])


def read_table(spark: SparkSession, root: str, key: str, order: list[str],
               schema: StructType) -> DataFrame:
    """Latest version per key over all files of the table's last change."""
    t = _table(spark, root)
    if t is None or not t["files"]:
        return spark.createDataFrame([], schema)
    return upsert_latest(_read(spark, _split(root)[0], t["files"], t["schema"]), key, order)


def read_rows(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Every row of the table's parts, as written. The table must be there."""
    t = ManifestLog(spark, base).state()["tables"][name]
    return (_read(spark, base, t["files"], t["schema"]) if t["files"]
            else spark.createDataFrame([], StructType.fromJson(t["schema"])))


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``value``, ``reason`` and the record's place, of every refused record."""
    t = _table(spark, root)
    if t is None or not t["rejects"]:
        return spark.createDataFrame([], "value string, reason string")
    return _read(spark, _split(root)[0], t["rejects"], t["rejects_schema"])


def read_counts(spark: SparkSession, base: str) -> DataFrame:
    """Records per topic and outcome (``indexed`` / ``error``) so far, as the
    manifest has added them up."""
    counts = ManifestLog(spark, base).state()["counts"]
    return spark.createDataFrame([(t, o, n) for t, of in sorted(counts.items()) for o, n in sorted(of.items())],
                                 "topic string, outcome string, records bigint")


def index_stats_at(spark: SparkSession, root: str,
                   tables: dict[str, tuple[str, list[str], StructType]]) -> DataFrame:
    """``index_name``, ``doc_count`` per keyed table under ``root`` (``name ->
    (key, order, schema)``). A table that the index job has not created yet
    counts 0; one that cannot be counted counts -1."""
    rows = []
    for name, (key, order, schema) in tables.items():
        try:
            n = read_table(spark, f"{root}/{name}", key, order, schema).count()
        except Exception:  # as a store that does not answer
            n = -1
        rows.append((name, n))
    return spark.createDataFrame(rows, "index_name string, doc_count bigint")


# ---- parts ------------------------------------------------------------------

def _described(spark: SparkSession, base: str, part: str, key: str | None, **more) -> list[dict]:
    """Path, size, rows and key range of the files of a written part, from one
    pass over the key column."""
    df = spark.read.parquet(f"{base}/{part}")
    ends = [] if key is None else [F.min(key).alias("low"), F.max(key).alias("high")]
    found = df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), *ends).collect()
    files = []
    for r in found:
        path = part + r.file.rsplit("/" + part.rsplit("/", 1)[1], 1)[1]
        files.append({"path": path, "bytes": r.bytes, "rows": r.rows, **more}
                     | ({} if key is None else {"low": r.low, "high": r.high}))
    return sorted(files, key=lambda f: f["path"])


def _positions(key: Column, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), bits) for i in range(HASHES)])


def _add_blooms(spark: SparkSession, base: str, part: str, key: str, files: list[dict]) -> None:
    """Writes the Bloom filters of a run's files beside it, in pieces, and
    notes their number of pieces. Bits per key do not depend on the file's size."""
    for f in files:
        f["pieces"] = 1 << max(0, (BITS * f["rows"] - 1) // PIECE).bit_length()
        f["bloom"] = f"{part}-bloom"
    number = spark.createDataFrame([(f["path"], f["pieces"]) for f in files], "file string, pieces int")
    at = F.concat(F.lit(part), F.regexp_extract(F.col("_metadata.file_path"), "/" + part.rsplit("/", 1)[1] + "(/.*)$", 1))
    rows = spark.read.parquet(f"{base}/{part}").select(at.alias("file"), F.col(key).alias("k")).where("k is not null")
    bits = F.explode(_positions(F.col("k"), F.col("pieces").cast("long") * PIECE)).alias("bit")
    (rows.join(F.broadcast(number), "file").select("file", bits)
     .groupBy("file", F.floor(F.col("bit") / PIECE).cast("int").alias("piece"))
     .agg(F.bitmap_construct_agg(F.col("bit") % PIECE).alias("bits"))
     .write.mode("overwrite").parquet(f"{base}/{part}-bloom"))


def _bucket(key: str, order: list[str], buckets: int) -> Column:
    """Records without a key are spread by their place, as each is its own."""
    return F.pmod(F.when(F.col(key).isNull(), F.xxhash64(*order)).otherwise(F.xxhash64(key)), F.lit(buckets)).cast("int")


def _merge(spark: SparkSession, log: ManifestLog, root: str, key: str, order: list[str], level: int,
           taken: list[dict], table: dict) -> None:
    """Merges files of the table into one run per bucket at ``level``, as one
    committed change."""
    base, name = _split(root)
    buckets = table["buckets"]
    part = f"{name}/run-{log.state()['version'] + 1:012d}-{level}"
    # tasks per bucket follow from the bytes that go in
    split = max(1, -(-sum(f["bytes"] for f in taken) // (buckets * RUN_BYTES)))
    rows = upsert_latest(_read(spark, base, taken, table["schema"]), key, order).withColumn(
        "b", _bucket(key, order, buckets))
    used = len({f["bucket"] for f in taken}) if level > 1 else buckets
    spread = F.pmod(F.xxhash64(F.lit(7), key, *order), F.lit(split))
    (rows.repartition(used * split, "b", spread).sortWithinPartitions("b", key)
     .write.mode("overwrite").partitionBy("b").parquet(f"{base}/{part}"))
    files = _described(spark, base, part, key, level=level)
    for f in files:
        f["bucket"] = int(f["path"].split("/b=")[1].split("/")[0])
    _add_blooms(spark, base, part, key, files)
    log.commit(lambda s: {"tables": {name: {"add": files, "drop": [f["path"] for f in taken]}}})


def compact(spark: SparkSession, root: str, key: str, order: list[str], schema: StructType,
            fan: int = FAN, grace_seconds: float = GRACE_SECONDS, log: ManifestLog | None = None) -> int | None:
    """Merges the waiting parts into runs, and the runs of a bucket level by
    level where ``fan`` of them have gathered; returns the number of the table's
    compaction. With no part waiting nothing is read or written. Each merge
    is a change of its own: one that is broken off leaves the table as it was."""
    base, name = _split(root)
    log = log or ManifestLog(spark, base)
    table = log.state()["tables"].get(name)
    if table is None:
        return None
    waiting = [f for f in table["files"] if f["level"] == 0]
    if not waiting:
        return table["snapshot"]
    _merge(spark, log, root, key, order, 1, waiting, table)
    level = 1
    while True:
        table = log.state()["tables"][name]
        runs: dict[int, set[str]] = {}
        for f in table["files"]:
            if f["level"] == level:
                runs.setdefault(f["bucket"], set()).add(f["path"].split("/b=")[0])
        full = {b for b, parts in runs.items() if len(parts) >= fan}
        if full:
            _merge(spark, log, root, key, order, level + 1,
                   [f for f in table["files"] if f["level"] == level and f["bucket"] in full], table)
        if not any(f["level"] > level for f in table["files"]):
            break
        level += 1
    n = 0 if table["snapshot"] is None else table["snapshot"] + 1
    log.commit(lambda s: {"tables": {name: {"snapshot": n}}})
    retire(spark, base, grace_seconds, log)
    return n


def retire(spark: SparkSession, base: str, grace_seconds: float = GRACE_SECONDS,
           log: ManifestLog | None = None) -> int:
    """Deletes the files that were replaced at least ``grace_seconds`` ago."""
    log = log or ManifestLog(spark, base)
    until = time.time() - grace_seconds
    old = [r["path"] for r in log.state()["retired"] if r["at"] <= until]
    for path in old:
        log.files.delete(f"{base}/{path}")
    if old:
        log.commit(lambda s: {"deleted": old})
    return len(old)


# ---- lookup -----------------------------------------------------------------

def lookup_files(spark: SparkSession, root: str, keys: list) -> list[dict]:
    """The files of the table that can hold one of ``keys``: those of a key's
    bucket (all that wait at level 0) with the key in their range and in their
    Bloom filter. Of the filters only the pieces asked for are read."""
    base, _ = _split(root)
    t = _table(spark, root)
    keys = sorted({k for k in keys if k is not None})
    if len(keys) > MOST_KEYS:
        raise ValueError(f"a lookup takes up to {MOST_KEYS} keys; join read_table with more")
    if t is None or not keys:
        return []
    kind = "string" if isinstance(keys[0], str) else "bigint"
    pieces = sorted({f["pieces"] for f in t["files"] if "pieces" in f})
    # a local relation: evaluated on the driver without a job
    hashed = spark.createDataFrame([(k,) for k in keys], f"k {kind}").select(
        "k", F.pmod(F.xxhash64("k"), F.lit(t["buckets"])).cast("int").alias("bucket"),
        *[_positions(F.col("k"), F.lit(n * PIECE)).alias(f"p{n}") for n in pieces]).collect()
    in_range = lambda f, k: f["low"] is not None and f["low"] <= k <= f["high"]
    found = [f for f in t["files"] if f["level"] == 0 and any(in_range(f, k) for k in keys)]
    asked = [(f, r) for f in t["files"] if f["level"] > 0 for r in hashed
             if r.bucket == f["bucket"] and in_range(f, r.k)]
    if not asked:
        return found
    names = sorted({f["path"] for f, _ in asked})
    which = sorted({p // PIECE for f, r in asked for p in r[f"p{f['pieces']}"]})
    blooms = (spark.read.schema("file string, piece int, bits binary")
              .parquet(*sorted({f"{base}/{f['bloom']}" for f, _ in asked}))
              .where(F.col("file").isin(names) & F.col("piece").isin(which)).collect())
    bits = {(r.file, r.piece): r.bits for r in blooms}

    def has(f: dict, positions: list[int]) -> bool:
        held = [(bits.get((f["path"], p // PIECE)), p % PIECE) for p in positions]
        return all(b is not None and b[p // 8] >> p % 8 & 1 for b, p in held)

    kept = {f["path"] for f, r in asked if has(f, r[f"p{f['pieces']}"])}
    return found + [f for f in t["files"] if f["path"] in kept]


def lookup(spark: SparkSession, root: str, key: str, order: list[str], schema: StructType,
           keys: list) -> DataFrame:
    """The rows of ``read_table`` whose key is one of ``keys`` (up to
    MOST_KEYS), read from the files of ``lookup_files`` only."""
    files = lookup_files(spark, root, keys)
    if not files:
        return read_table(spark, root, key, order, schema).limit(0)
    rows = _read(spark, _split(root)[0], files, _table(spark, root)["schema"])
    return upsert_latest(rows.where(F.col(key).isin([k for k in keys if k is not None])), key, order)


# ---- the job ----------------------------------------------------------------

def _typed(x: Column, dtype: DataType) -> Column:
    if isinstance(dtype, TimestampType):
        return F.try_to_timestamp(x.try_cast("string"))
    return x.try_cast(dtype)


def decode(df: DataFrame, schema: StructType, stamp_col: str = "indexed_at") -> DataFrame:
    """``r`` (the record with the table's types) and ``reason`` (null if it
    fits) next to the columns of ``df``. Missing and JSON null are NULL; a
    value that its type cannot hold refuses the record, named in the reason."""
    fields = [f for f in schema.fields if f.name != stamp_col]
    staged = df.withColumn("_w", record(F.col("value")))
    w = F.col("_w")
    staged = staged.select(*df.columns, is_record(w).alias("_is"),
                           F.struct(*[field(w, "$." + f.name).alias(f.name) for f in fields]).alias("_x"))
    x = lambda f: F.col("_x").getField(f.name)
    typed = F.struct(*[_typed(x(f), f.dataType).alias(f.name) for f in fields])
    staged = staged.withColumn("r", typed)
    ill = F.array_compact(F.array(*[
        F.when(x(f).isNotNull() & ~F.is_variant_null(x(f)) & F.col("r").getField(f.name).isNull(),
               F.lit(f.name)) for f in fields]))
    value = F.col("value")
    reason = (F.when(value.isNull(), F.lit("null"))
               .when(~object_text(value), F.lit("not_an_object"))
               .when(~F.col("_is"), F.lit("malformed_json"))
               .when(F.size(ill) > 0, F.concat(F.lit("ill_typed:"), F.array_join(ill, ","))))
    return staged.withColumn("reason", reason).select(*df.columns, "r", "reason")


def write_part(spark: SparkSession, base: str, name: str, part: str, rows: DataFrame, key: str | None,
               before: dict | None, buckets: int = BUCKETS) -> dict:
    """Writes ``rows`` as a waiting part of the table; what the manifest has to
    say of it. ``before`` is the table's state so far, if there is one."""
    at = f"{name}/part-{part}"
    rows.write.mode("overwrite").parquet(f"{base}/{at}")
    files = [f for f in _described(spark, base, at, key, level=0, bucket=None) if f["rows"]]
    before = before or {}
    return {"add": files, "buckets": before.get("buckets") or buckets,
            "schema": _merged(before.get("schema"), rows.schema)}


def write_split(spark: SparkSession, base: str, part: str, name: str, good: DataFrame, bad: DataFrame,
                key: str | None, before: dict | None, buckets: int = BUCKETS) -> dict:
    """``write_part`` with the records that were refused."""
    told = write_part(spark, base, name, part, good, key, before, buckets)
    at = f"{name}/rejects-{part}"
    bad.write.mode("overwrite").parquet(f"{base}/{at}")
    told["rejects"] = [f for f in _described(spark, base, at, None) if f["rows"]]
    told["rejects_schema"] = _merged((before or {}).get("rejects_schema"), bad.schema)
    return told


def write_batch(spark: SparkSession, base: str, part: str, name: str, staged: DataFrame, key: str,
                meta: list[str], before: dict | None, buckets: int) -> tuple[dict, dict]:
    """Writes the accepted and refused records of ``staged`` as a part of the
    table each; what the manifest has to say of them, and their counts."""
    good = staged.where("reason is null").select("r.*", *meta, F.current_timestamp().alias("indexed_at"))
    bad = staged.where("reason is not null").select("value", "reason", *meta)
    told = write_split(spark, base, part, name, good, bad, key, before, buckets)
    counts = {"indexed": sum(f["rows"] for f in told["add"]), "error": sum(f["rows"] for f in told["rejects"])}
    return told, {k: n for k, n in counts.items() if n}


def each_batch_once(raw: DataFrame, base: str, checkpoint: str, job, trigger: dict | None = None,
                    output_mode: str = "append") -> StreamingQuery:
    """Runs ``job(batch, state, part)`` per micro-batch and commits the change
    it returns, with the batch, to the manifest of ``base``. A batch that was
    committed before is not run again. ``job`` may have a second function,
    ``job.after(log, batch_id)``, for what follows a commit."""
    mine = checkpoint_name(checkpoint)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        log = ManifestLog(batch.sparkSession, base)
        state = log.state()
        if state["batches"].get(mine, -1) < batch_id:
            change = job(batch, state, part_name(checkpoint, batch_id))
            log.commit(lambda s: {**change, "batch": {mine: batch_id}})
            if after := getattr(job, "after", None):
                after(log, batch_id)

    w = raw.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(per_batch)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def upsert_job(raw: DataFrame, root: str, checkpoint: str,
               topics: dict[str, tuple[StructType, str]],
               trigger: dict | None = None, key: str = "id",
               compact_every: int | None = None, buckets: int = BUCKETS,
               grace_seconds: float = GRACE_SECONDS) -> StreamingQuery:
    """J6: multi-topic stream -> one keyed table per topic, under ``root``.

    ``topics`` maps topic -> (table schema, table name[, key]). Records keep the
    Kafka ``(timestamp, partition, offset)`` (or the replay ``seq``) as the
    version order. A record that is not one JSON object, or does not fit the
    table's types, is written to the table's rejects; ``read_counts(root)``
    gives the records indexed and refused per topic. A batch is seen in all
    tables at once or not at all, and once. With ``compact_every=N`` each table
    is compacted after every N-th batch; ``key`` is the document key used by
    compaction and ``buckets`` the hash buckets of a new table.
    """
    def job(batch: DataFrame, state: dict, part: str) -> dict:
        spark, tables, counts = batch.sparkSession, {}, {}
        meta = [c for c in META if c in batch.columns]
        batch = batch.persist()
        try:
            for topic, rows in route_by_topic(batch, list(topics)).items():
                schema, name = topics[topic][:2]
                tkey = topics[topic][2] if len(topics[topic]) > 2 else key
                staged = decode(rows.select(*meta, "value"), schema).persist()
                try:
                    tables[name], counts[topic] = write_batch(
                        spark, root, part, name, staged, tkey, meta, state["tables"].get(name), buckets)
                finally:
                    staged.unpersist()
        finally:
            batch.unpersist()
        return {"tables": tables, "counts": counts}

    def after(log: ManifestLog, batch_id: int) -> None:
        if compact_every and (batch_id + 1) % compact_every == 0:
            for spec in topics.values():
                compact(raw.sparkSession, f"{root}/{spec[1]}", spec[2] if len(spec) > 2 else key,
                        [c for c in META if c in raw.columns], spec[0], grace_seconds=grace_seconds, log=log)

    job.after = after
    return each_batch_once(raw, root, checkpoint, job, trigger)
