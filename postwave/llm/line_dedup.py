"""Line dedup: later copies of repeated runs of lines are deleted.

The lines of all documents, document after document by id, are one sequence.
Its suffixes are ranked by distributed prefix doubling: the rank of a suffix
over 1, 2, 4, ... lines is the place where that stretch of lines comes first,
and ranks over twice as many lines follow from the pairs of ranks that stand
one stretch apart. Suffixes with the same rank are one interval of the suffix
array whose common prefix has at least that many lines. A suffix whose stretch
occurs nowhere else takes no further part, so each round is smaller than the
one before. Stretches end with their document.

Two stretches of any length are equal if their first and their last 2^k lines
have the same ranks (2^k the largest power that fits). A *run* is worth
deleting from ``MIN_WORDS`` words on. For every line, the shortest stretch with
that many words that begins with it, and the one that ends with it, are looked
up. Those that came before lie in maximal repeated runs, and together they
cover exactly the lines of such runs that have an earlier copy. These are
deleted, so that the first copy of every run stays.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm.hashing import text_chunks
from postwave.llm.tables import SPACES, read, small_batches, small_or_merge, written

MIN_WORDS = 50
DOC = ["doc_id", "content"]
PLACE = [*DOC, "at"]


def _content():
    """Tells rows with the same id apart, unless they are the same row."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("content")


def lines_of(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, content, at, line (its id), ahead and behind: the lines of the
    shortest stretch of ``min_words`` words that begins and ends here, null if
    there is none."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            who, at, ids, ahead, behind = [], [], [], [], []
            for i, text in enumerate(texts):
                lines = text.split(b"\n")
                n = len(lines)
                upto = np.zeros(n + 1, np.int64)
                np.cumsum([len(x.split()) for x in lines], out=upto[1:])
                stop = np.searchsorted(upto, upto[:-1] + min_words, "left")
                start = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
                here = np.arange(n)
                who.append(np.full(n, i))
                at.append(here)
                ids += [hashlib.blake2b(x.strip(), digest_size=16).digest() for x in lines]
                ahead.append(np.where(stop <= n, stop - here, 0))
                behind.append(np.where(start >= 0, here + 1 - start, 0))
            who = pa.array(np.concatenate(who))
            ahead, behind = np.concatenate(ahead), np.concatenate(behind)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(who), part.column(1).take(who),
                 pa.array(np.concatenate(at).astype(np.int32)), pa.array(ids, pa.binary()),
                 pa.array(ahead.astype(np.int32), mask=ahead == 0),
                 pa.array(behind.astype(np.int32), mask=behind == 0)],
                names=["doc_id", "content", "at", "line", "ahead", "behind"])

    return docs.select("doc_id", _content(), "text").mapInArrow(
        task, f"doc_id {kind}, content long, at int, line binary, ahead int, behind int")


def _place():
    """Sorts by id, ids before null."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), *PLACE)


def _first(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` whose key occurs more than once, with ``rank``: the first place of it."""
    seen = rows.groupBy(*key).agg(F.min(_place()).alias("rank"), F.count("*").alias("times"))
    seen = written(seen.where("times > 1").drop("times"), "line-ranks").hint("merge")
    return rows.join(seen, list(key))


def _at(ranks: DataFrame, name: str, shift=0) -> DataFrame:
    """The ranks as ``name``, keyed by the places ``shift`` lines before."""
    return ranks.select(F.struct(*DOC).alias("doc"), (F.col("at") - shift).alias("at"), F.col("rank").alias(name))


def repeated(lines: DataFrame) -> DataFrame:
    """doc_id, content, at, size: stretches of lines that came before.
    ``lines`` is a written table as ``lines_of`` returns it."""
    size = F.explode(F.array_distinct(F.array(
        F.struct(F.col("at"), F.col("ahead").alias("size")),
        F.struct((F.col("at") - F.col("behind") + 1).alias("at"), F.col("behind").alias("size")))))
    stretches = (lines.where("ahead is not null or behind is not null")
                 .select(F.struct(*DOC).alias("doc"), size.alias("x"))
                 .where("x.size is not null").select("doc", "x.at", "x.size"))
    longest = stretches.agg(F.max("size")).first()[0] or 0
    ranks = written(_first(lines.select(*PLACE, "line"), "line").select(*PLACE, "rank"), "line-level")
    found, k = None, 0
    while 1 << k <= longest:
        reach = 1 << k
        level = stretches.where(F.col("size").between(reach, 2 * reach - 1))
        tail = _at(ranks, "tail").withColumnRenamed("at", "last")
        level = (level.distinct().join(_at(ranks, "head"), ["doc", "at"])
                 .withColumn("last", F.col("at") + F.col("size") - reach)
                 .join(tail, ["doc", "last"])
                 .select("doc.*", "at", "size", "head", "tail"))
        later = (_first(written(level, "line-stretches"), "head", "tail", "size")
                 .where(_place() != F.col("rank")).select(*PLACE, "size"))
        later = written(later, "line-later")
        found = later if found is None else found.unionByName(later)
        k += 1
        if 1 << k <= longest:
            pairs = (_at(ranks, "head").join(_at(ranks, "tail", reach), ["doc", "at"])
                     .select("doc.*", "at", "head", "tail"))
            ranks = written(_first(written(pairs, "line-pairs"), "head", "tail").select(*PLACE, "rank"), "line-level")
    return lines.select(*PLACE, F.col("ahead").alias("size")).limit(0) if found is None else found


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, once for rows that share both. Only rows
    told again are shuffled with their text."""
    rows = docs.select("doc_id", "text", F.struct(F.col("doc_id"), _content()).alias("_doc"))
    again = small_or_merge(written(
        rows.groupBy("_doc").count().where("count > 1").select("_doc"), "line-again"))
    told = rows["_doc"].eqNullSafe(again["_doc"])
    more = rows.join(again, told, "left_semi").dropDuplicates(["_doc"])
    return rows.join(again, told, "left_anti").unionByName(more).select("doc_id", "text")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with all columns, ``text`` without later copies,
    and n_lines and n_deleted after them.

    Lines end with \\n and are compared without white space around them; blank
    lines count as lines without words. Earlier means a smaller doc_id (null
    last), then an earlier line; rows that share id and text are one document
    and get the same text. A run that repeats within a text, overlapping itself
    included, is deleted from its second copy on. A text of which all lines are
    deleted becomes empty; null stays null; an empty table gives no rows.
    Columns named n_lines or n_deleted are replaced.
    """
    lines = written(lines_of(_documents(small_batches(docs)), min_words), "lines")
    cuts = (repeated(lines).groupBy(*DOC)
            .agg(F.collect_set(F.struct("at", "size")).alias("cuts"))
            .select(F.struct(*DOC).alias("cut_doc"), "cuts"))
    cuts = written(cuts, "line-cuts").hint("merge")
    # the row as one column, so that no column of it meets one of ours
    rows = docs.select(F.struct(F.col("doc_id"), _content()).alias("doc"), _whole_row(docs).alias("row"))
    # one mark per line: rows without cuts keep their text as it is
    rows = rows.join(cuts, rows["doc"].eqNullSafe(cuts["cut_doc"]), "left").select(
        "row", "cuts", F.split(F.col("row")["text"], "\n").alias("lines"))
    gone = F.array_distinct(F.flatten(F.transform(
        "cuts", lambda c: F.sequence(c["at"], c["at"] + c["size"] - 1))))
    rows = rows.select("row", "lines", gone.alias("gone"))
    left = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"),
        lambda i: F.get("lines", i)), "\n")
    text = F.when(F.size("gone") > 0, left).otherwise(F.col("row")["text"])
    kept = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    return rows.select(*((text if c == "text" else F.col("row")[c]).alias(c) for c in kept),
                       F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                       F.greatest(F.coalesce(F.size("gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_deleted"))


def _whole_row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def left_over(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of ``docs`` after ``dedup_lines``, n_chars told anew, without
    the rows that lost all their words."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None)
    rows = dedup_lines(docs.select("doc_id", "text", row.alias("row")), min_words)
    words = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES)) != ""
    rows = rows.where((F.col("n_deleted") == 0) | words)
    made = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: F.col("row")[c] for c in others}
    if "n_chars" in made:
        made["n_chars"] = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(
            made["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return rows.select(*(made[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
x AS (
  SELECT doc_id, i, regexp_replace(regexp_replace(l[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS line,
         len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM x),
a AS (
  SELECT p.doc_id, p.i AS s, min(q.i) AS e FROM c p JOIN c q ON p.doc_id = q.doc_id AND q.i >= p.i
    AND q.upto - p.upto + p.n >= 50 GROUP BY ALL
  UNION
  SELECT q.doc_id, max(p.i) AS s, q.i AS e FROM c p JOIN c q ON p.doc_id = q.doc_id AND q.i >= p.i
    AND q.upto - p.upto + p.n >= 50 GROUP BY q.doc_id, q.i),
t AS (
  SELECT a.doc_id, s, e, string_agg(line, chr(10) ORDER BY x.i) AS run
  FROM a JOIN x ON x.doc_id = a.doc_id AND x.i BETWEEN s AND e GROUP BY ALL),
f AS (
  SELECT doc_id, s, e FROM (
    SELECT *, row_number() OVER (PARTITION BY run, e - s ORDER BY doc_id, s) AS copy FROM t) WHERE copy > 1),
g AS (
  SELECT x.doc_id, x.i FROM x WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.doc_id = x.doc_id AND x.i BETWEEN s AND e)),
k AS (
  SELECT g.doc_id, string_agg(l[g.i], chr(10) ORDER BY g.i) AS text, count(*) AS n
  FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CASE WHEN l IS NULL THEN NULL ELSE coalesce(text, '') END AS text,
       CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l) - coalesce(n, 0), 0) AS BIGINT) AS n_deleted
FROM d LEFT JOIN k USING (doc_id)
"""
