"""Exact top-k search by inner product with pivot-table elimination.

Every vector keeps its distances to ``PIVOTS`` pivots, computed once. For a
query q, a candidate x and any pivot p the triangle inequality gives

    |q - x| >= | |q - p| - |x - p| |

and with <q, x> = (|q|**2 + |x|**2 - |q - x|**2) / 2 the greatest of these lower
bounds of the distance is an upper bound of the score.

1. The pivots are spread over a bounded sample (each the farthest from those
   before it); every row goes to the cell of its nearest pivot. Of each cell
   the span of the distances to every pivot and the greatest norm are kept: a
   table of PIVOTS * PIVOTS spans, whatever the number of rows.
2. A query's k-th best score within the sample is a first floor under its
   answer. Cells whose bound lies below the floor are left out for that query.
3. Cells are dealt out in blocks of rows, queries in blocks too. A task meets
   one block of candidates and one of queries, and takes each query's
   candidates in the order of their bounds, in growing steps, until the next
   bound is below the k-th best score found: none of the rest can enter, not
   even as a tie.
4. The blocks' best k are ranked per query.

Bounds are rounded upwards, scores are exact integers, so the result is that of
a full search.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postwave.llm.tables import read, written
from postwave.llm.vectors import floors, longest, packed, unpacked, whole

SCALE, TOP, EVERY = 64, 20, 20
PIVOTS = 32
# Rows of the sample that pivots and first floors come from.
SAMPLE = 4096
# Rows of a block of candidates and of a block of queries, about.
CANDIDATES, QUERIES = 32_768, 8_192
# Bounds held at a time: queries times candidates.
AT_A_TIME = 1 << 17
# 32-bit distances are off by less than this part of themselves.
ROUNDING = 2.0 ** -22


def _distances(v: np.ndarray, norm: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the rows to the pivots; the squares are whole numbers."""
    p = pivots.astype(np.float64)
    square = norm[:, None] + (p * p).sum(axis=1) - 2.0 * (v.astype(np.float64) @ p.T)
    return np.sqrt(np.maximum(square, 0)).astype(np.float32)


def _norms(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return np.einsum("ij,ij->i", v, v)


def spread(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Up to ``most`` different rows of the sample: the first, then always the
    one farthest from those taken."""
    if not len(sample):
        return sample
    v = sample.astype(np.float64)
    near, taken = np.full(len(v), np.inf), []
    at = 0
    while len(taken) < most and near[at] > 0:
        taken.append(at)
        far = v - v[at]
        near = np.minimum(near, np.einsum("ij,ij->i", far, far))
        at = int(near.argmax())
    return sample[taken]


def integers(rows: DataFrame, scale: int = SCALE) -> tuple[DataFrame, int]:
    """row (a number of its own), vec_id and ``v``, written, for the rows that
    take part, and the length of a vector."""
    rows = rows.select("vec_id", "embedding").where(whole())
    dim = longest(rows)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = floors(batch.column(2), scale)
                if dim * int(np.abs(v).max(initial=0)) ** 2 >= 1 << 50:
                    raise OverflowError("scores are not exact beyond 2**50")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed(v.astype(np.int32))],
                                                 names=["row", "vec_id", "v"])

    table = (rows.where(F.size("embedding") == dim)
             .select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
             .mapInArrow(task, f"row long, vec_id {kind}, v binary"))
    return written(table, "pivot-vectors"), dim


def pivot_table(table: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """``table`` with its norm, its distances to the pivots and its cell."""
    kind = table.schema["vec_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = unpacked(batch.column(2).to_pylist(), "<i4", dim)
                norm = _norms(v)
                d = _distances(v, norm, pivots)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(norm), packed(d), pa.array(d.argmin(axis=1).astype(np.int32))],
                    names=["row", "vec_id", "v", "norm", "d", "cell"])

    return table.mapInArrow(task, f"row long, vec_id {kind}, v binary, norm double, d binary, cell int")


def _spans(table: DataFrame, pivots: int) -> dict[int, tuple]:
    """Per cell: rows, greatest norm, least and greatest distance to each pivot.
    A task sends one row a cell."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(pivots, np.int64)
        norm, low = np.full(pivots, -1.0), np.full((pivots, pivots), np.inf, np.float32)
        high = np.full((pivots, pivots), -1.0, np.float32)
        for batch in batches:
            if batch.num_rows:
                cell, d = batch.column(0).to_numpy(), unpacked(batch.column(2).to_pylist(), "<f4", pivots)
                n += np.bincount(cell, minlength=pivots)
                np.maximum.at(norm, cell, batch.column(1).to_numpy())
                np.minimum.at(low, cell, d)
                np.maximum.at(high, cell, d)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has, pa.int32()), pa.array(n[has]), pa.array(norm[has]),
             pa.array(list(low[has]), pa.list_(pa.float32())), pa.array(list(high[has]), pa.list_(pa.float32()))],
            names=["cell", "n", "norm", "low", "high"])

    each = table.select("cell", "norm", "d").mapInArrow(
        task, "cell int, n long, norm double, low array<float>, high array<float>")
    ends = [f(F.col(c)[i]).alias(f"{c}{i}") for c, f in (("low", F.min), ("high", F.max)) for i in range(pivots)]
    found = each.groupBy("cell").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), *ends).collect()
    return {r.cell: (r.n, r.norm, np.array([r[f"low{i}"] for i in range(pivots)], np.float32),
                     np.array([r[f"high{i}"] for i in range(pivots)], np.float32)) for r in found}


def _bound(norms, gap, reach):
    """The greatest score that a distance of at least ``gap`` leaves; ``norms``
    is the sum of the two squared norms, ``reach`` the largest distance used."""
    gap = np.maximum(gap - 2 * ROUNDING * reach, 0)
    return (norms - gap * gap) / 2 + 1e-6 * (1 + norms * 1e-6)


def routed(queries: DataFrame, sample: np.ndarray, sample_rows: np.ndarray, spans: dict, blocks: dict[int, int],
           parts: int, top: int, dim: int, pivots: int) -> DataFrame:
    """Each query once per block of the cells that it has to see, with its
    first floor under the k-th score."""
    kind = queries.schema["vec_id"].dataType.simpleString()
    cells = np.array(sorted(spans))
    norm = np.array([spans[c][1] for c in cells])
    low, high = (np.array([spans[c][i] for c in cells]).reshape(len(cells), pivots) for i in (2, 3))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                q = unpacked(rows.column(2).to_pylist(), "<i4", dim).astype(np.float64)
                d = unpacked(rows.column(4).to_pylist(), "<f4", pivots)
                n = rows.column(3).to_numpy()
                floor = np.full(len(q), -np.inf)
                if len(sample) > top:
                    scores = q @ sample.astype(np.float64).T
                    scores[rows.column(0).to_numpy()[:, None] == sample_rows[None, :]] = -np.inf
                    floor = np.partition(scores, -top, axis=1)[:, -top]
                gap = np.maximum(low[None] - d[:, None], d[:, None] - high[None]).max(axis=2, initial=0)
                reach = np.maximum(d.max(axis=1, initial=0)[:, None], high.max(axis=1, initial=0)[None])
                who, cell = np.nonzero(_bound(n[:, None] + norm[None], gap.astype(np.float64), reach) >= floor[:, None])
                part = rows.column(0).to_numpy() * 0x9E3779B1 % parts
                times = np.array([blocks[c] for c in cells], np.int64)[cell]
                block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                who, cell = np.repeat(who, times), cells[np.repeat(cell, times)]
                taken = pa.Table.from_batches([rows]).take(pa.array(who)).combine_chunks()
                out = pa.table([pa.array(cell, pa.int32()), pa.array(block, pa.int32()), pa.array(part[who], pa.int32()),
                                *(taken.column(c) for c in ("row", "vec_id", "v", "norm", "d")), pa.array(floor[who])],
                               names=["cell", "block", "part", "row", "vec_id", "v", "norm", "d", "floor"])
                yield from out.to_batches()

    return queries.select("row", "vec_id", "v", "norm", "d").mapInArrow(
        task, f"cell int, block int, part int, row long, vec_id {kind}, v binary, norm double, d binary, floor double")


def _bounds(q: dict, x: dict, far: np.ndarray) -> np.ndarray:
    """Upper bounds of all scores of the queries ``q`` with the candidates ``x``
    (``far``: their distances, pivot by pivot); -inf for a query's own row."""
    gap = np.zeros((len(q["row"]), len(x["row"])), np.float32)
    one = np.empty_like(gap)
    for p, d in enumerate(far):
        np.subtract(q["d"][:, p, None], d[None], out=one)
        np.maximum(gap, np.abs(one, out=one), out=gap)
    reach = np.maximum(q["d"].max(axis=1, initial=0)[:, None], far.max(axis=0, initial=0)[None])
    bound = _bound(q["norm"][:, None] + x["norm"][None], gap.astype(np.float64), reach)
    bound[q["row"][:, None] == x["row"][None]] = -np.inf
    return bound


def _largest(m: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf if a row is shorter."""
    n = m.shape[1]
    return np.partition(m, n - k, axis=1)[:, n - k] if n >= k else np.full(len(m), -np.inf)


def best_of_block(q: dict, x: dict, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's ``top`` scores of the block,
    ties to the smaller id, as places in ``q`` and ``x``. ``x`` is ordered by
    id, so of equal scores the first places win.

    Each query scores the candidates with its highest bounds first, then those
    that follow in growing steps, until no bound left reaches the k-th score it
    has found or knows of."""
    found: list[tuple] = []
    n = len(x["row"])
    # small enough to stay in the processor's cache over all pivots
    together = max(1, AT_A_TIME // max(n, 1))
    far = np.ascontiguousarray(x["d"].T)
    for start in range(0, len(q["row"]), together):
        some = {k: v[start:start + together] for k, v in q.items()}
        bound, floor = _bounds(some, x, far), some["floor"]
        score = np.full(bound.shape, -np.inf)
        live, step = (bound >= floor[:, None]) & (bound > -np.inf), 8 * top
        while live.any():
            now = live & (bound >= _largest(np.where(live, bound, -np.inf), step)[:, None])
            if now.sum() * 16 > now.size:
                # most of a block: one product of matrices
                np.copyto(score, some["v"] @ x["v"].T, where=now)
            else:
                i, j = np.nonzero(now)
                score[i, j] = np.einsum("ij,ij->i", some["v"][i], x["v"][j])
            floor = np.maximum(floor, _largest(score, top))
            live &= ~now & (bound >= floor[:, None])
            step *= 64
        i, j = np.nonzero((score >= floor[:, None]) & (score > -np.inf))
        order = np.lexsort((j, -score[i, j], i))
        i, j = i[order], j[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j = i[rank < top], j[rank < top]
        found.append((i + start, j, score[i, j]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    who, places, scores = (np.concatenate(c) for c in zip(*found))
    return who, places, scores.astype(np.int64)


def exact_kind(most: int, dim: int):
    """The narrowest float type whose products and sums of such components are
    exact."""
    return np.float32 if dim * most * most < 1 << 24 else np.float64


def search(vectors: DataFrame, is_query, top: int = TOP, scale: int = SCALE,
           candidates: int = CANDIDATES, queries: int = QUERIES, pivots: int = PIVOTS,
           sample_rows: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of ``vectors`` for
    which ``is_query`` (a condition on vec_id) holds, the ``top`` other rows by
    inner product of floor(scale * x), ties to the smaller vec_id.

    Rows whose vector is null, holds null or non-finite components, or is
    shorter than the longest of the others (or empty) take no part, neither as query nor
    as candidate. Only a query's own row is left out: a row told twice finds its
    copy. Null ids are candidates, after all other ids where scores tie. With
    fewer candidates than ``top`` all are returned; an empty table gives no
    rows. Columns besides vec_id and embedding are not read. Scores beyond
    2**50 raise, as they would not be exact.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    result = f"query_row long, query_id {kind}, vec_id {kind}, score long"
    table, dim = integers(vectors, scale)
    some = table.orderBy(F.xxhash64("v"), "row").limit(sample_rows).collect()
    sample = unpacked([bytes(r.v) for r in some], "<i4", dim)
    marks = spread(sample, pivots)
    if not len(marks):
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    n_pivots = len(marks)
    table = written(pivot_table(table, marks, dim), "pivot-table")
    spans = _spans(table, n_pivots)
    blocks = {c: -(-s[0] // candidates) for c, s in spans.items()}
    asked = table.where(is_query)
    parts = max(1, -(-asked.count() // queries))
    left = routed(asked, sample, np.array([r.row for r in some]), spans, blocks, parts, top, dim, n_pivots)

    # each block of candidates meets each block of queries
    many = F.element_at(F.create_map(*[F.lit(int(x)) for c, b in blocks.items() for x in (c, b)]), F.col("cell"))
    right = table.select("cell", F.pmod(F.xxhash64("row"), many).cast("int").alias("block"),
                         F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                         "row", "vec_id", "v", "norm", "d")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # null ids last
        q, x = ({"row": t["row"].to_numpy(), "norm": t["norm"].to_numpy(),
                 "v": unpacked(t["v"].to_pylist(), "<i4", dim), "d": unpacked(t["d"].to_pylist(), "<f4", n_pivots)}
                for t in (a, b))
        kind = exact_kind(max(int(np.abs(t["v"]).max(initial=0)) for t in (q, x)), dim)
        q["v"], x["v"] = q["v"].astype(kind), x["v"].astype(kind)
        q["floor"] = a["floor"].to_numpy()
        who, place, score = best_of_block(q, x, top)
        return pa.table([pa.array(q["row"][who]), a["vec_id"].take(pa.array(who)), b["vec_id"].take(pa.array(place)),
                         pa.array(score)], names=["query_row", "query_id", "vec_id", "score"])

    key = ["cell", "block", "part"]
    near = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(meet, result)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.id, q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON q.id <> x.id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
WHERE rank <= {TOP}
"""
