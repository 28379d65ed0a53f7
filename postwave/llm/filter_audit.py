"""Filter interaction audit: what five filters remove from documents, alone, in
every order and in the mean over all orders.

Texts are read once, as bytes, by a table-driven transducer. Its state is the
kind of the last byte; a table over (state, kind of the next byte) says what the
step emits: a code point, a capital, a symbol, the start or the end of a word.
Because a state is only the last byte's kind, all steps of a chunk are looked
up at once. The word spans it emits go into an open-addressing hash table. An
occupied slot counts as a hit only if the bytes of both words are the same, so
the number of distinct words is exact; other words move on to the next slot.

Per part the documents are then counted by the set of filters they fail (32
sets, combined before the shuffle). All that an order of filters keeps or
removes follows from the number of documents that pass a set of filters, so the
120 orders cost nothing per document.
"""
from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm import hashing
from postwave.llm.tables import read, small_batches, written

# The filters, and what a byte can be.
FILTERS = "ABCDE"
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#$%&*|"
SPACE, CAPITAL, SYMBOL, LATER, OTHER = range(5)  # LATER: second and further bytes of a code point
POINT, UPPER, MARK, START, STOP = 1, 2, 4, 8, 16
LEAST_WORDS = 200
# Words longer than this many 8-byte steps are compared as a whole.
STEPS = 32
# Bytes of text that a task reads at a time.
CHUNK = 1 << 20


def _kinds() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[list(SPACES)] = SPACE
    kind[ord("A"):ord("Z") + 1] = CAPITAL
    kind[list(SYMBOLS)] = SYMBOL
    kind[0x80:0xC0] = LATER
    return kind


def _emissions() -> np.ndarray:
    """What the step from a state (last kind) to the next kind emits."""
    out = np.zeros((5, 5), np.uint8)
    for last in range(5):
        for now in range(5):
            out[last, now] = ((POINT if now != LATER else 0) | (UPPER if now == CAPITAL else 0)
                              | (MARK if now == SYMBOL else 0) | (START if last == SPACE != now else 0)
                              | (STOP if now == SPACE != last else 0))
    return out


KIND, EMITS = _kinds(), _emissions()


def transduce(data: np.ndarray, ends: np.ndarray):
    """(code points, capitals, symbols per text, starts and stops of all words).
    ``data`` holds the texts, each followed by one space byte; ``ends`` are the
    places after those."""
    kind = KIND[data]
    state = np.empty_like(kind)
    state[:1], state[1:] = SPACE, kind[:-1]
    out = EMITS.ravel()[state * np.uint8(5) + kind]
    begins = np.concatenate(([0], ends[:-1]))

    def per_text(bit: int) -> np.ndarray:
        # runs of the flag: a text has few capitals and symbols
        return np.diff(np.searchsorted(np.flatnonzero(out & bit), np.concatenate((begins, ends[-1:]))))

    # every text but for the space behind it
    points = np.add.reduceat((out & POINT).astype(np.int64), begins) - 1 if len(ends) else np.empty(0, np.int64)
    return points, per_text(UPPER), per_text(MARK), np.flatnonzero(out & START), np.flatnonzero(out & STOP)


class WordTable:
    """Distinct (text, word) spans of a chunk, in open addressing."""

    def __init__(self, data: np.ndarray):
        # eight bytes from any place, the end filled up
        held = np.concatenate((data, np.zeros(8, np.uint8)))
        self.data = data
        self.eight = np.ndarray((len(data) + 1,), "<u8", held, strides=(1,))
        self.held = held

    def hashes(self, start: np.ndarray, stop: np.ndarray, text: np.ndarray) -> np.ndarray:
        """64 bits of each word and its text, eight bytes a step."""
        h = hashing.mix(text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (stop - start).astype(np.uint64))
        at, live = start.copy(), np.arange(len(start))
        while len(live):
            left = stop[live] - at[live]
            h[live] = hashing.mix(h[live] ^ self._bytes(at[live], left))
            at[live] += 8
            live = live[left > 8]
        return h

    def _bytes(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        cut = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
        return (self.eight[at] << cut) >> cut

    def same(self, a: tuple, b: tuple) -> np.ndarray:
        """Whether spans (start, stop) hold the same bytes."""
        equal = a[1] - a[0] == b[1] - b[0]
        long = equal & (a[1] - a[0] > 8 * STEPS)
        for i in np.flatnonzero(long):
            equal[i] = np.array_equal(self.data[a[0][i]:a[1][i]], self.data[b[0][i]:b[1][i]])
        live, off = np.flatnonzero(equal & ~long), 0
        while len(live):
            x, y, left = a[0][live] + off, b[0][live] + off, a[1][live] - a[0][live] - off
            ok = self._bytes(x, left) == self._bytes(y, left)
            equal[live[~ok]] = False
            off += 8
            live = live[ok & (left > 8)]
        return equal

    def distinct(self, start: np.ndarray, stop: np.ndarray, text: np.ndarray, texts: int,
                 hashes: np.ndarray | None = None) -> np.ndarray:
        """Distinct words per text; every hit is verified by its bytes."""
        h = self.hashes(start, stop, text) if hashes is None else hashes
        size = 1 << max(4, int(2 * len(start)).bit_length())
        slots = np.full(size, -1, np.int64)
        at = (h & np.uint64(size - 1)).astype(np.int64)
        # an odd step visits every slot
        step = ((h >> np.uint64(40)).astype(np.int64) << 1 | 1) & (size - 1)
        live, new = np.arange(len(start)), np.zeros(len(start), bool)
        while len(live):
            here = at[live]
            empty = slots[here] < 0
            # of several words that meet at an empty slot one goes in
            slots[here[empty]] = live[empty]
            owner = slots[here]
            new[owner[owner == live]] = True
            known = owner == live
            rest = np.flatnonzero(~known)
            mine, other = live[rest], owner[rest]
            hit = (text[mine] == text[other]) & (h[mine] == h[other])
            hit[hit] = self.same((start[mine[hit]], stop[mine[hit]]), (start[other[hit]], stop[other[hit]]))
            live = mine[~hit]
            at[live] = (at[live] + step[live]) & (size - 1)
        return np.bincount(text[new], minlength=texts).astype(np.int64)


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """words, distinct words, capitals, code points and symbols of each text."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    points, capitals, symbols, start, stop = transduce(data, ends)
    text = np.searchsorted(ends, start, side="right")
    return {"n_words": np.bincount(text, minlength=len(texts)).astype(np.int64),
            "n_distinct": WordTable(data).distinct(start, stop, text, len(texts)),
            "n_capitals": capitals.astype(np.int64), "n_chars": points, "n_symbols": symbols.astype(np.int64)}


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, digest (SHA-256 of the text, null as empty) and the
    counts of every row."""
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "source"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in hashing.text_chunks(batches, limit=CHUNK):
            n = text_counts(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), *(pa.array(n[c]) for c in COUNTS)],
                names=["doc_id", "source", "digest", *COUNTS])

    text = F.coalesce("text", F.lit(""))
    return (small_batches(docs).select("doc_id", "source", F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), "text")
            .mapInArrow(task, f"{kinds}, digest binary, " + ", ".join(f"{c} long" for c in COUNTS)))


def failures(rows: DataFrame) -> Column:
    """The failed filters but for the last as bits, the first filter lowest."""
    fails = (F.col("n_words") < LEAST_WORDS,
             100 * F.col("n_distinct") < 50 * F.col("n_words"),
             100 * F.col("n_capitals") > 2 * F.col("n_chars"),
             F.col("n_symbols") > 0)
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bits of the filters that the row fails), good and toxic of
    every row of ``docs``."""
    rows = written(counted(docs).select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), "digest", failures(docs).alias("fails")), "audit-rows")
    # the smallest id of each text; joined by text and id, so that a text with
    # very many copies is spread over the ids
    first = (rows.where("doc_id is not null").groupBy(F.col("digest").alias("d"))
             .agg(F.min("doc_id").alias("first")))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    last = 1 << (len(FILTERS) - 1)
    again = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (rows.join(first, (F.col("doc_id") == F.col("first")) & (F.col("digest") == F.col("d")), "left")
            .join(marks, F.col("doc_id") == F.col("l"), "left")
            .select("part", (F.col("fails") + F.when(again, last).otherwise(0)).alias("fails"),
                    F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")))


def steps() -> list[dict]:
    """Every step of every order: its filter, and the filters before it and up
    to it as bits."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for i, f in enumerate(order):
            upto = before | 1 << f
            out.append({"filter_order": "".join(FILTERS[g] for g in order), "step": i + 1, "f": f,
                        "before": before, "upto": upto})
            before = upto
    return out


def shapley(passing: Column, f: int) -> Column:
    """What filter ``f`` removes, summed over all orders: a set of k filters
    comes before it in k! (m - 1 - k)! of the m! orders."""
    m = len(FILTERS)
    terms = [math.factorial(k) * math.factorial(m - 1 - k) * (passing[s] - passing[s | 1 << f])
             for s in range(1 << m) if not s >> f & 1 for k in (s.bit_count(),)]
    return sum(terms[1:], terms[0])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order,
    step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null and empty texts have no words and are the same text; a null source is
    the part ''. A row whose doc_id is null is compared with no other text, and
    rows that share id and text are no copies of each other. A document counts
    as good (toxic) if any label row of its id says so; labels without id or
    value count for nothing. Rows told twice count twice; an empty table gives
    no rows. Other columns are not read.
    """
    n_sets, count = 1 << len(FILTERS), F.count(F.lit(1))
    # the 32 sets a row can fail, then for each set of filters the documents that pass all of it
    each = failed(docs, labels).groupBy("part", "fails").agg(
        count.alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    each = each.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(n_sets - 1))))
    passes = F.col("fails").bitwiseAND(F.col("mask")) == 0
    wide = each.groupBy("part", "mask").agg(
        *[F.sum(F.when(passes, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")],
        F.sum(F.when(F.col("fails") == F.col("mask"), F.col("n")).otherwise(0)).alias("exactly"))
    wide = wide.groupBy("part").agg(F.array_sort(F.collect_list(
        F.struct("mask", "n", "good", "toxic", "exactly"))).alias("by"))
    wide = wide.select("part", "by", F.array(*[shapley(F.col("by.n"), f) for f in range(len(FILTERS))]).alias("shapley"))
    kind = "array<struct<filter_order:string,step:int,f:int,before:int,upto:int>>"
    rows = wide.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(steps())), kind)))
    at = lambda c, m: F.col("by")[F.col(f"s.{m}")][c]
    lost = lambda c: at(c, "before") - at(c, "upto")
    own = F.col("by")[F.pow(F.lit(2), F.col("s.f")).cast("int")]
    return rows.select(
        "part", "s.filter_order", "s.step", at("n", "upto").alias("kept"), lost("n").alias("removed"),
        (F.col("by")[0]["n"] - own["n"] - lost("n")).alias("redundant"), own["exactly"].alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.col("shapley")[F.col("s.f")].alias("shapley"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
r AS MATERIALIZED (
  SELECT part, (len(w) < 200)::INT
      + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
      + 4 * (100 * len(regexp_extract_all(d.text, '[A-Z]')) > 2 * length(d.text))::INT
      + 8 * regexp_matches(d.text, '[#$%&*|]')::INT
      + 16 * coalesce(d.doc_id > m.first, false)::INT AS fails,
    coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM d JOIN m USING (text) LEFT JOIN l ON l.doc_id = d.doc_id),
c AS MATERIALIZED (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t
                   FROM r GROUP BY ALL),
o AS (
  SELECT '' AS filter_order, 0 AS step, 0 AS before, 0 AS upto, -1 AS f
  UNION ALL
  SELECT filter_order || chr(65 + b), step + 1, upto, upto + (1 << b), b
  FROM o, (SELECT unnest(range(5))::INT AS b) WHERE step < 5 AND upto & (1 << b) = 0),
e AS MATERIALIZED (
  SELECT w.filter_order, s.step, s.before, s.upto, s.f FROM o w JOIN o s
  ON w.step = 5 AND s.step > 0 AND starts_with(w.filter_order, s.filter_order)),
x AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (fails & upto = 0) AS kept,
    sum(n) FILTER (fails & before = 0 AND fails & (1 << f) > 0) AS removed,
    sum(n) FILTER (fails & before > 0 AND fails & (1 << f) > 0) AS redundant,
    sum(n) FILTER (fails = 1 << f) AS unique_fails,
    sum(g) FILTER (fails & before = 0 AND fails & (1 << f) > 0) AS good_lost,
    sum(t) FILTER (fails & before = 0 AND fails & (1 << f) > 0) AS toxic_lost
  FROM c, e GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM x
"""
