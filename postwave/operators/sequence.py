"""Per-group sequence operators (lag, running frames, sessions) that stay
balanced when one group is hot.

A window with ``PARTITION BY user, day`` sorts each group in one task, so a
group holding a third of all rows makes one task a third of the job. Here a
group with more than ``chunk_rows`` rows is cut into chunks at sort tuples
sampled from it (a random salt splits even exact copies); the window runs
per (group, chunk), which
spreads a hot group over many tasks, and what a chunk needs from the rows
before it (the last ``k`` rows, or the last session start) comes from a
seam table with a few rows per chunk of a hot group. That table holds at
most a few rows per ``chunk_rows`` input rows, so its size is bounded by the
data over the chunk size; it is checkpointed to the shared folder and
broadcast only after its decoded size is measured under the limit.

Groups at or under ``chunk_rows`` (every group, usually) are one chunk, and
the plan is one count pass plus the ordinary window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_limit, decoded_bytes

CHUNK_CONF = "spark.postwave.sequenceChunkRows"
DEFAULT_CHUNK_ROWS = 2_000_000
OVERSAMPLE = 8                      # sampled rows per chunk when choosing cut points
SALT_SEED, SAMPLE_SEED = 17, 29


def _sized(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    return F.broadcast(df) if decoded_bytes(df) <= broadcast_limit(spark) else df.hint("merge")


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL keys as equal (a NULL user is a group too)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(_sized(r), cond, how).drop(*[f"_r_{k}" for k in keys])


def _order(order: list[str], cut: bool) -> list[str]:
    """Rows tied on ``order`` follow a hash of their own values, whatever the
    group's size; only exact copies are left to the salt."""
    return [*order, "_tie", "_salt"] if cut else [*order, "_tie"]


def _with_tie(df: DataFrame) -> DataFrame:
    return df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))


def _cuts_at_or_before(cuts: str, tup, steps: int):
    """How many of the sorted ``cuts`` are at or before ``tup``, by binary
    search, so that a group with very many chunks costs a row few comparisons."""
    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        before = F.get(cuts, mid) <= tup
        return F.when(s["lo"] < s["hi"], F.struct(
            F.when(before, mid + 1).otherwise(s["lo"]).cast("int").alias("lo"),
            F.when(before, s["hi"]).otherwise(mid).cast("int").alias("hi"))).otherwise(s)
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["lo"]


def chunk_groups(df: DataFrame, keys: list[str], order: list[str],
                 chunk_rows: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` with ``_c``, the chunk of the row within its group (0 for
    groups of at most ``chunk_rows`` rows), and ``_h``, whether the group was
    cut, and ``_tie``, a hash of the row. Returns whether any group was cut;
    then rows also carry ``_salt`` and chunks follow the order ``order +
    [_tie, _salt]``: every row of chunk ``c`` sorts after every row of chunk
    ``c - 1``.

    Cut points are whole sort tuples taken from a per-group sample of about
    ``OVERSAMPLE`` rows per chunk, so rows that share a timestamp are still
    cut, and ``_salt`` (random) cuts even exact copies, the only rows it
    orders."""
    spark = df.sparkSession
    df = _with_tie(df)
    if chunk_rows is None:
        chunk_rows = int(spark.conf.get(CHUNK_CONF, str(DEFAULT_CHUNK_ROWS)))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # one job on the usual path: the largest group's size, a single number
    top = counts.agg(F.max("_n").alias("m")).first()["m"]
    if top is None or top <= chunk_rows:
        return df.withColumn("_c", F.lit(0)).withColumn("_h", F.lit(False)), False
    hot = (counts.filter(F.col("_n") > chunk_rows)
                 .withColumn("_need", F.ceil(F.col("_n") / F.lit(chunk_rows)))
                 .checkpoint())
    order = [*order, "_tie"]
    tup = F.struct(*[F.col(c) for c in order], F.col("_salt"))
    p = F.least(F.lit(1.0), F.lit(OVERSAMPLE) * F.col("_need") / F.col("_n"))
    smp = (_join(df.select(*keys, *order).withColumn("_salt", F.rand(SALT_SEED)), hot, keys)
             .filter(F.rand(SAMPLE_SEED) < p))
    ws = Window.partitionBy(*keys).orderBy(*order, "_salt")
    smp = (smp.withColumn("_i", F.row_number().over(ws))
              .withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(*keys))))
    # sample row i closes chunk j when i = ceil(j * k / need), j < need
    step = lambda i: F.floor(i * F.col("_need") / F.col("_k"))
    cuts = (smp.filter((step(F.col("_i")) > step(F.col("_i") - 1)) & (F.col("_i") < F.col("_k")))
               .groupBy(*keys).agg(F.array_sort(F.collect_list(tup)).alias("_cuts"))
               .checkpoint())
    out = _join(df.withColumn("_salt", F.rand(SALT_SEED)), cuts, keys, "left")
    most = hot.agg(F.max("_need").alias("m")).first()["m"]
    c = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(
        _cuts_at_or_before("_cuts", tup, int(most).bit_length() + 1))
    # the salt is random and the window shuffles on the chunk it decides:
    # written once, so a map task rerun after a lost executor reads the same
    # salts and sends every row where the first attempt did
    return (out.withColumn("_c", c).withColumn("_h", F.col("_cuts").isNotNull())
               .drop("_cuts").checkpoint(), True)


def group_lags(df: DataFrame, keys: list[str], order: list[str],
               lags: dict[str, tuple[str, int]],
               chunk_rows: int | None = None) -> DataFrame:
    x, cut = chunk_groups(df, keys, order, chunk_rows)
    return _chunk_lags(x, cut, keys, order, lags).drop("_c", "_h", "_salt", "_tie")


def _chunk_lags(x: DataFrame, cut: bool, keys: list[str], order: list[str],
                lags: dict[str, tuple[str, int]]) -> DataFrame:
    """Add, for each ``name: (col, k)``, the value of ``col`` ``k`` rows
    earlier in the row's group under ``order`` (NULL before the first),
    as ``lag(col, k) OVER (PARTITION BY keys ORDER BY order)`` would.
    Rows tied on ``order`` follow a hash of their values."""
    kmax = max(k for _, k in lags.values())
    cols = sorted({c for c, _ in lags.values()})
    order = _order(order, cut)
    w = Window.partitionBy(*keys, "_c").orderBy(*order)
    x = x.withColumn("_rn", F.row_number().over(w))
    for name, (col, k) in lags.items():
        x = x.withColumn(name, F.lag(col, k).over(w))
    if not cut:
        return x.drop("_rn")
    # seam: the last kmax rows of every chunk, in group order. The first seam
    # row of chunk c is preceded in it by the last kmax rows before chunk c.
    x = x.withColumn("_tail", F.lead(F.lit(1), kmax).over(w).isNull())
    x = x.checkpoint()
    s = x.filter(F.col("_tail") & F.col("_h")).select(*keys, "_c", *order, *cols)
    ws = Window.partitionBy(*keys).orderBy("_c", *order)
    prev = [F.array(*[F.lag(c, j).over(ws) for j in range(1, kmax + 1)]).alias(f"_p_{c}")
            for c in cols]
    seam = (s.select(*keys, "_c", F.lag("_c").over(ws).alias("_pc"), *prev)
             .filter(F.col("_pc").isNull() | (F.col("_pc") != F.col("_c")))
             .filter(F.col("_c") > 0).drop("_pc").checkpoint())
    x = _join(x, seam, [*keys, "_c"], "left")
    for name, (col, k) in lags.items():
        at = F.greatest(F.lit(k + 1) - F.col("_rn"), F.lit(1)).cast("int")
        x = x.withColumn(name, F.when(F.col("_rn") > k, F.col(name))
                                .otherwise(F.element_at(F.col(f"_p_{col}"), at)))
    return x.drop("_rn", "_tail", *[f"_p_{c}" for c in cols])


def lag_frame(df: DataFrame, keys: list[str], ts: str, tiebreak: str, value: str,
              chunk_rows: int | None = None) -> DataFrame:
    """Per group ordered by (ts, tiebreak): the previous row's ``ts`` as
    ``previous_post`` and the sum of ``value`` over the row and the two
    before it (ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) as ``<value>_3``."""
    x = group_lags(df, keys, [ts, tiebreak],
                   {"previous_post": (ts, 1), "_v1": (value, 1), "_v2": (value, 2)},
                   chunk_rows)
    vs = [F.col(value), F.col("_v1"), F.col("_v2")]
    total = F.when(vs[0].isNull() & vs[1].isNull() & vs[2].isNull(), F.lit(None)).otherwise(
        F.coalesce(vs[0], F.lit(0)) + F.coalesce(vs[1], F.lit(0)) + F.coalesce(vs[2], F.lit(0)))
    return x.withColumn(f"{value}_3", total.cast("bigint")).drop("_v1", "_v2")


def sessions(df: DataFrame, keys: list[str], ts: str, tiebreak: str, gap_minutes: int,
             chunk_rows: int | None = None) -> DataFrame:
    """Gap sessions per group: a row starts a session when it is the group's
    first or comes ``gap_minutes`` or more after the previous row. One row
    per session: ``keys``, ``session_start``, ``session_end`` (last row's
    time plus the gap) and ``post_count``. The final aggregate combines on
    the map side, so a long session is never gathered in one task."""
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(gap_minutes))
    x, cut = chunk_groups(df.select(*keys, ts, tiebreak), keys, [ts, tiebreak], chunk_rows)
    x = _chunk_lags(x, cut, keys, [ts, tiebreak], {"_prev": (ts, 1)})
    start = F.col("_prev").isNull() | (F.col(ts) >= F.col("_prev") + gap)
    x = x.withColumn("_s", F.when(start, F.col(ts)))
    # the session a row belongs to starts at the last start at or before it;
    # a chunk's rows before its own first start continue the previous chunk's
    w = Window.partitionBy(*keys, "_c").orderBy(*_order([ts, tiebreak], cut)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    if cut:
        # last start per chunk of a hot group (map-side combined), then the
        # last start before each chunk; ``x`` reads from the lag checkpoint
        last = x.filter(F.col("_h")).groupBy(*keys, "_c").agg(F.max("_s").alias("_ls"))
        wc = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        carry = (last.select(*keys, "_c", F.max("_ls").over(wc).alias("_carry"))
                     .filter(F.col("_c") > 0).checkpoint())
    x = x.withColumn("_sid", F.max("_s").over(w))
    if cut:
        x = (_join(x, carry, [*keys, "_c"], "left")
              .withColumn("_sid", F.coalesce("_sid", "_carry")))
    return (x.groupBy(*keys, "_sid")
             .agg(F.max(ts).alias("_last"), F.count(F.lit(1)).alias("post_count"))
             .select(*keys, F.col("_sid").alias("session_start"),
                     (F.col("_last") + gap).alias("session_end"), "post_count"))
