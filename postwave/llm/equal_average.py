"""Vector code compression: parts of vectors as indexes into trained codebooks,
the nearest entry found by equal-average search.

Vectors are cut into ``PARTS`` equal consecutive parts of integers, and every
part position has a codebook of up to ``ENTRIES`` entries, trained by rounds of
assigning and averaging. For a part x and an entry c of ``w`` components,

    (sum(x) - sum(c))**2 / w <= |x - c|**2

so the entries are sorted by their component sum, and a search starts at the
part's own sum and expands outward on both sides. A side ends once its squared
gap over ``w`` strictly exceeds the best distance so far; an equal one could
still tie at a lower index. No entry beyond can be nearer, so the result is
that of a full search.

Each round is one pass of tasks over the vectors. A task sums the parts of each
entry itself, and what it sends on is bounded by the codebooks; only those
(ENTRIES * dimension integers) come to the driver.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm.tables import read, small_or_merge, written
from postwave.llm.vectors import batches_of, floors, longest, packed, unpacked, whole

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
# Parts that are searched at a time.
TOGETHER = 8192


class Codebook:
    """The entries of one part position, sorted by component sum."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.width = entries.shape[1]
        sums = self.entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]
        if self.width and int(self.width) * (2 * int(np.abs(entries).max(initial=0)) + 1) ** 2 >= 1 << 62:
            raise OverflowError("squared distances do not fit 64 bits")

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each part's nearest entry, ties to the
        lower index."""
        n, k = len(parts), len(self.entries)
        best = np.full(n, np.iinfo(np.int64).max)
        index = np.full(n, k, np.int64)
        own = parts.sum(axis=1)
        right = np.searchsorted(self.sums, own)
        for step, at, end in ((1, right, k), (-1, right - 1, -1)):
            self._expand(parts, own, at, step, end, best, index)
        return index, best

    def _expand(self, parts, own, at, step, end, best, index) -> None:
        """One side of the search, for all parts that still go on."""
        live = np.flatnonzero(at != end)
        at = at[live]
        while len(live):
            gap = self.sums[at] - own[live]
            # gap**2 / width > best, in whole numbers
            on = -(-gap * gap // max(self.width, 1)) <= best[live]
            live, at = live[on], at[on]
            entry = self.order[at]
            far = parts[live] - self.entries[entry]
            d = np.einsum("ij,ij->i", far, far)
            better = (d < best[live]) | (d == best[live]) & (entry < index[live])
            best[live[better]], index[live[better]] = d[better], entry[better]
            at = at + step
            on = at != end
            live, at = live[on], at[on]


def _width(dim: int) -> int:
    return -(-dim // PARTS)


def integers(rows: DataFrame, scale: int = SCALE) -> tuple[DataFrame, int]:
    """The rows that take part, written, with their vector of 32-bit integers
    ``v`` in place of ``embedding``, and the components of a vector (padded by
    zeros to a multiple of PARTS)."""
    rows = rows.where(whole())
    dim = longest(rows)
    width = _width(dim) * PARTS
    rows = rows.where(F.size("embedding") == dim)
    others = [c for c in rows.columns if c != "embedding"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = floors(batch.column(len(others)), scale).astype(np.int32)
            v = np.pad(v, ((0, 0), (0, width - dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed(v)], names=[*others, "v"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return written(rows.select(*others, "embedding").mapInArrow(task, f"{kinds}, v binary"), "code-vectors"), width


def first_books(table: DataFrame, width: int) -> list[np.ndarray]:
    """Each part of the ENTRIES smallest ids, ascending (null ids last, equal
    ids by their vector)."""
    first = table.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    start = unpacked([bytes(r.v) for r in first], "<i4", width).astype(np.int64) if first else np.zeros((0, width), np.int64)
    return np.split(start, PARTS, axis=1)


def train(table: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of all part positions after ``rounds`` rounds."""
    books = first_books(table, width)
    part_width = width // PARTS
    for _ in range(rounds if width and len(books[0]) else 0):
        now = books

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searches = [Codebook(b) for b in now]
            sums = np.zeros((PARTS, len(now[0]), part_width), np.int64)
            count = np.zeros((PARTS, len(now[0])), np.int64)
            for rows in batches_of(batches, TOGETHER):
                v = unpacked(rows.column(0).to_pylist(), "<i4", width).astype(np.int64)
                for p, part in enumerate(np.split(v, PARTS, axis=1)):
                    entry, _ = searches[p].nearest(part)
                    order = np.argsort(entry, kind="stable")
                    used, first = np.unique(entry[order], return_index=True)
                    sums[p, used] += np.add.reduceat(part[order], first, axis=0)
                    count[p, used] += np.diff(np.append(first, len(order)))
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
                 pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

        each = table.select("v").mapInArrow(task, "part int, entry int, n long, sums array<long>")
        total = (each.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
                 .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")))
        books = [b.copy() for b in books]
        for r in total.collect():
            books[r.part][r.entry, r["at"]] = r.x // r.n
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(table: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """``table`` with code and error in place of ``v``."""
    others = [c for c in table.columns if c != "v"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Codebook(b) for b in books]
        hexes = np.array([f"{i:02x}" for i in range(ENTRIES)], object)
        for rows in batches_of(batches, TOGETHER):
            v = unpacked(rows.column("v").to_pylist(), "<i4", width).astype(np.int64).reshape(rows.num_rows, width)
            found = [s.nearest(p) for s, p in zip(searches, np.split(v, PARTS, axis=1))]
            code = sum((hexes[i] for i, _ in found[1:]), hexes[found[0][0]])
            error = sum(d for _, d in found)
            for batch in rows.select(others).append_column("code", pa.array(code, pa.string())).append_column(
                    "error", pa.array(error)).to_batches():
                yield batch

    kinds = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in others)
    return table.select(*others, "v").mapInArrow(task, f"{kinds}, code string, error long")


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row that takes part: vec_id, code, error, label_error,
    codebooks_sha256.

    Rows whose vector is null, holds null or non-finite components, or is
    shorter than the longest of the others (or empty), take no part. A length that PARTS
    does not divide is padded by zero components. Rows told twice count twice;
    equal ids are ordered by their vector and null ids come last. Null labels
    are one group. With fewer rows than ENTRIES there are fewer entries; an
    empty table gives no rows. Columns besides vec_id, embedding and label are
    not read. A component that does not fit 32 bits raises.
    """
    table, width = integers(embeddings.select("vec_id", "label", "embedding"))
    books = train(table, width, rounds)
    coded = written(encode(table, books, width), "codes")
    # label by label combined before the shuffle; the sums are few or joined by a shuffle
    total = small_or_merge(written(coded.groupBy(F.col("label").alias("of")).agg(
        F.sum("error").alias("label_error")), "code-labels"))
    return coded.join(total, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """DuckDB text: a full search over all entries in place of the sorted one."""
    assign = """a{r} AS MATERIALIZED (
  SELECT x.id, x.part, min(struct_pack(d := list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
         e := c.entry)) AS best
  FROM x JOIN c{r} c USING (part) GROUP BY x.id, x.part)"""
    update = """c{n} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY i) AS v FROM (
      SELECT x.part, a.best.e AS entry, j.i AS i, sum(x.v[j.i])::BIGINT AS s, count(*) AS n
      FROM x JOIN a{r} a USING (id, part), (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM x))) AS i) j
      GROUP BY ALL) GROUP BY ALL) m USING (part, entry))"""
    steps = []
    for r in range(ROUNDS):
        steps += [assign.format(r=r), update.format(r=r, n=r + 1)]
    steps.append(assign.format(r=ROUNDS))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
x AS MATERIALIZED (
  SELECT id, p.part AS part, v[p.part * len(v) // {PARTS} + 1:(p.part + 1) * len(v) // {PARTS}] AS v
  FROM k, (SELECT unnest(range({PARTS})) AS part) p),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, v FROM x WHERE id <= {ENTRIES}),
{''.join(s + ',' + chr(10) for s in steps)}
f AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
      FROM a{ROUNDS} GROUP BY id),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS digest FROM c{ROUNDS})
SELECT k.vec_id, f.code, f.error, sum(f.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       h.digest AS codebooks_sha256
FROM k JOIN f USING (id), h
"""


SQL = _sql()
