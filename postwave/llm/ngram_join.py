"""N-gram Jaccard join: all documents whose sets of word shingles overlap by
80 % or more, and the groups they form.

The overlap counts are a sparse matrix product, documents by shingles times
its transpose, done in blocks of the shingle axis and never written out:

1. Documents with the same set are one row of the matrix (a *set*, named by 64
   bits of its content, which are checked to be unique), so copies cost nothing
   further.
2. A task packs the (shingle, set) entries of its texts by block of the
   shingle's hash; the number of blocks follows from the number of entries.
   Each block drops every shingle that occurs in one set alone; these add
   nothing to any overlap. What is left goes on as one row per entry, to its
   set. Shingles that a large share of all sets have are found beforehand and
   go straight to their sets, as they need no count to be known as shared.
3. Per set, what is left bounds every overlap it can have. Sets with less
   than 80 % of their shingles left are discarded by size, which leaves few.
4. Candidates come from the rarest shingles of a set only: of ``n`` shingles
   the first ``n - ceil(0.8 n) + 1`` in the order (sets with it, hash), as two
   sets that link must share one of those (the prefix bound). A pair is
   counted exactly if sizes and places allow 80 %.
5. A shingle in up to ``PAIR_LIST`` sets gives all its pairs. One in more
   gives the pairs with a leader, the set with the fewest shingles of its own.
   Pairs that then are in different components are counted too, except within
   the shingle's largest component. So a large group of near copies takes
   about one pair a member instead of the square, and no link between
   components is missed.

No list, candidate or partner is capped. A shingle stands for its words by 48
bits of its hash within its block: two different shingles of a pair of texts
are taken for one with a chance of 2**-48 for each two of them.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postwave.llm import hashing
from postwave.llm.components import connected
from postwave.llm.tables import read, small_batches, small_or_merge, written

WIDTH = 5
# Links are at least NUM / DEN of the union.
NUM, DEN = 4, 5
PAIR_LIST = 32
# Bytes of text that are packed at a time.
CHUNK = 6 << 20
# Entries of a block, about.
BLOCK = 1 << 20
# Shingles that this share of all sets have, and so many sets, need no block.
HOT_SHARE, HOT_LEAST = 1 / 128, BLOCK // 4
_LOW = np.uint64((1 << 48) - 1)


def _sets(texts: list[bytes], width: int, salt: int = 0):
    """Distinct (hash, text) entries, entries per text, and 128 bits of each
    text's set, of which the first 64 name it."""
    h, owner = hashing.distinct(*hashing.shingles(*hashing.word_hashes(texts), width))
    n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    at = np.cumsum(n) - n
    ids = np.zeros((len(texts), 2), np.uint64)
    for j, key in enumerate((0xA0761D6478BD642F + salt, 0xE7037ED1A0B428DB)):
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(hashing.mix(h ^ np.uint64(key)), out=sums[1:])
        ids[:, j] = hashing.mix(sums[at + n] - sums[at] + n.astype(np.uint64))
    return h, owner, n, ids


def _once(h, owner, ids):
    """The entries of each different set's first text."""
    _, first = np.unique(ids, axis=0, return_index=True)
    once = np.zeros(len(ids), bool)
    once[first] = True
    return h[once[owner]], owner[once[owner]], first


def _frequent(h: np.ndarray, sets: int, share: float) -> list[dict]:
    """Shingles in at least ``share`` of the sets of a chunk, and in eight."""
    found, n = np.unique(h, return_counts=True)
    often = n >= max(8, share * sets)
    return [{"h": int(x), "sets": int(c)} for x, c in zip(found[often].astype(np.int64), n[often])]


def set_ids(docs: DataFrame, width: int = WIDTH, salt: int = 0, hot_share: float = HOT_SHARE) -> DataFrame:
    """doc_id, n_shingles, set (null for a text without words) and 64 more bits
    of its content per row; ``often`` of the first row of a chunk has the
    shingles that are frequent in the chunk."""
    kind = docs.schema["doc_id"].dataType

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in hashing.text_chunks(batches, limit=CHUNK):
            h, owner, n, ids = _sets(texts, width, salt)
            h, _, first = _once(h, owner, ids)
            often = [_frequent(h, len(first), hot_share / 2)] + [None] * (len(n) - 1)
            none = n == 0
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), *(pa.array(ids[:, j].astype(np.int64), mask=none) for j in (0, 1)),
                 pa.array(often, pa.list_(pa.struct([("h", pa.int64()), ("sets", pa.int64())])))],
                names=["doc_id", "n_shingles", "set", "content", "often"])

    return docs.select("doc_id", "text").mapInArrow(
        task, f"doc_id {kind.simpleString()}, n_shingles long, set long, content long, "
              "often array<struct<h:long,sets:long>>")


def hot_shingles(ids: DataFrame, hot_share: float = HOT_SHARE, least: int = HOT_LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (sorted) that at least ``hot_share / 2`` of all sets have, and
    ``least`` of them, with the number of sets as far as it was counted. One
    that ``hot_share`` of them have is always found: half of its sets are in
    chunks where it is frequent. There are at most 2 / hot_share times the mean
    number of shingles."""
    sets = ids.where("set is not null").count()
    found = (ids.where("often is not null").select(F.inline("often")).groupBy("h").agg(F.sum("sets").alias("sets"))
             .where(F.col("sets") >= max(least, hot_share / 2 * sets)).collect())
    h = np.array([r.h for r in found], np.int64).astype(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r.sets for r in found], np.int64)[order]


# A packed part: its sets (name, size, entries), then the entries' 48 bits, by set.
_SET = np.dtype([("set", "<u8"), ("n", "<u4"), ("entries", "<u4")])


def _parts(number: np.ndarray, ids: np.ndarray, n: np.ndarray, h: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The entries packed by ``number``."""
    order = np.lexsort((owner, number))
    number, h, owner = number[order], h[order], owner[order]
    cut = np.flatnonzero(np.diff(number)) + 1
    for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(number)]))):
        if hi > lo:
            first = np.flatnonzero(np.concatenate(([True], owner[lo + 1:hi] != owner[lo:hi - 1])))
            sets = np.empty(len(first), _SET)
            sets["set"], sets["n"] = ids[owner[lo:hi][first]], n[owner[lo:hi][first]]
            sets["entries"] = np.diff(np.append(first, hi - lo))
            low = h[lo:hi]
            yield int(number[lo]), b"".join((
                np.int64(len(sets)).tobytes(), sets.tobytes(), (low & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                (low >> np.uint64(32)).astype("<u2").tobytes()))


def _unpack(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, set, size) of all entries of the parts."""
    hs, sets = [], []
    for b in parts:
        many = int(np.frombuffer(b, "<i8", 1)[0])
        s = np.frombuffer(b, _SET, many, 8)
        e, at = int(s["entries"].sum()), 8 + many * _SET.itemsize
        hs.append(np.frombuffer(b, "<u4", e, at).astype(np.uint64)
                  | np.frombuffer(b, "<u2", e, at + 4 * e).astype(np.uint64) << np.uint64(32))
        sets.append(s)
    sets = np.concatenate(sets)
    return np.concatenate(hs), np.repeat(sets["set"], sets["entries"]), np.repeat(sets["n"], sets["entries"])


def shared_entries(docs: DataFrame, entries: int, hot: tuple[np.ndarray, np.ndarray], width: int = WIDTH,
                   salt: int = 0) -> DataFrame:
    """set, n, shared (hashes of the set's shingles that other sets have too,
    rarest first) and prefix (how many of them give candidates), for the sets
    that size lets link at all. ``entries`` is the number of entries of all
    texts."""
    blocks = max(-(-entries // BLOCK), min(32, -(-entries // 50_000)), 1)
    hot_h, hot_sets = hot
    hot_low = (hot_h & _LOW) if len(hot_h) else hot_h
    by_low = np.argsort(hot_low)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in hashing.text_chunks(batches, limit=CHUNK):
            h, owner, n, ids = _sets(texts, width, salt)
            h, owner, _ = _once(h, owner, ids)  # copies within the chunk are one set
            number = (h >> np.uint64(48)) % np.uint64(blocks)
            if len(hot_h):
                known = hot_h[np.minimum(np.searchsorted(hot_h, h), len(hot_h) - 1)] == h
                number[known] = np.uint64(blocks) + ids[owner[known], 0] % np.uint64(blocks)
            found = list(_parts(number.astype(np.int64), ids[:, 0], n, h & _LOW, owner))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())],
                names=["block", "part"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        """One block of the shingle axis: its entries with the number of sets
        that have their shingle, if there are several."""
        block = int(pdf["block"].iloc[0])
        h, s, n = _unpack(list(pdf["part"]))
        order = np.lexsort((s, h))
        h, s, n = h[order], s[order], n[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        h, s, n = h[new], s[new], n[new]
        if block < blocks:
            start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            many = np.diff(np.append(start, len(h)))
            df = np.repeat(many, many)
            h, s, n, df = h[df > 1], s[df > 1], n[df > 1], df[df > 1]
        else:
            df, block = hot_sets[by_low][np.searchsorted(hot_low[by_low], h)], 0xFFFF
        # a hash of the block's number too: the block holds 48 bits of its own
        h = hashing.mix(h | np.uint64(block & 0xFFFF) << np.uint64(48)) & _LOW
        return pd.DataFrame({"bucket": (s % np.uint64(blocks)).astype(np.int32), "set": s.astype(np.int64),
                             "n": n.astype(np.int32), "df": df.astype(np.int32), "h": h.astype(np.int64)})

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        """The sets of one bucket with all their shared shingles."""
        h, df, s, n = (pdf[c].to_numpy() for c in ("h", "df", "set", "n"))
        order = np.lexsort((h, df, s))
        h, s, n = h[order], s[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        shared, n = np.diff(np.append(at, len(s))), n[at]
        # of the first n - ceil(0.8 n) + 1 shingles, those found in one set alone come first
        prefix = np.minimum(n - -(-NUM * n // DEN) + 1 - (n - shared), shared)
        live = np.flatnonzero(DEN * shared >= NUM * n)
        return pd.DataFrame({
            "set": s[at[live]], "n": n[live],
            "shared": pd.Series([h[at[i]:at[i] + shared[i]] for i in live], dtype=object), "prefix": prefix[live]})

    return (docs.select("text").mapInArrow(pack, "block int, part binary")
            .groupBy("block").applyInPandas(count, "bucket int, set long, n int, df int, h long")
            .groupBy("bucket").applyInPandas(bound, "set long, n long, shared array<long>, prefix long"))


def _possible(a: str, b: str):
    """Whether two sets that first meet at these places can link: what is left
    of both from there on bounds the overlap, and the sizes bound the union."""
    n = lambda x, c: F.col(f"{x}.{c}")
    left = F.least(n(a, "n") - n(a, "place"), n(b, "n") - n(b, "place"))
    return (((NUM + DEN) * left >= NUM * (n(a, "n") + n(b, "n")))
            & (DEN * F.least(n(a, "n"), n(b, "n")) >= NUM * F.greatest(n(a, "n"), n(b, "n"))))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact overlap is NUM / DEN of the union or more."""
    a = sets.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    b = sets.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    overlap = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b")
            .where((NUM + DEN) * overlap >= NUM * (F.col("na") + F.col("nb"))).select("a", "b"))


def linked_sets(sets: DataFrame) -> DataFrame:
    """set, root of the sets that link with another one. ``sets`` is a
    written table as ``shared_entries`` returns it."""
    place = F.posexplode(F.slice("shared", F.lit(1), F.col("prefix").cast("int")))
    entries = (sets.select("set", "n", F.size("shared").alias("m"), place.alias("at", "h"))
               .select("h", "set", "n", (F.col("n") - F.col("m") + F.col("at")).alias("place"),
                       (F.col("m") / F.col("n")).alias("common")))
    # per shingle: the number of sets and the leader, in one aggregate
    lists = entries.groupBy("h").agg(
        F.count("*").alias("sets"), F.max(F.struct("common", "set", "n", "place")).alias("lead"))
    lists = lists.where("sets > 1")
    entries = written(entries.join(lists, "h"), "join-entries")
    short, long = entries.where(F.col("sets") <= PAIR_LIST), entries.where(F.col("sets") > PAIR_LIST)
    pair = [F.col("x.set").alias("a"), F.col("y.set").alias("b")]
    near = (short.alias("x").join(short.alias("y"), (F.col("x.h") == F.col("y.h"))
                                  & (F.col("x.set") < F.col("y.set")) & _possible("x", "y"))
            .select(*pair))
    led = (long.select(F.struct("set", "n", "place").alias("x"), F.col("lead").alias("y"))
           .where((F.col("x.set") != F.col("y.set")) & _possible("x", "y")).select(*pair))
    links = written(_links(near.unionByName(led), sets), "join-links")
    roots = connected(links)

    # long lists: what the leader left in other components than the largest one
    found = long.join(roots.withColumnRenamed("id", "set"), "set", "left").select(
        "h", "set", "n", "place", F.coalesce("root", "set").alias("root"))
    found = written(found, "join-long")
    by_root = found.groupBy("h", "root").agg(F.count("*").alias("members"))
    largest = by_root.groupBy("h").agg(F.max(F.struct("members", "root")).alias("top"),
                                       F.count("*").alias("roots")).where("roots > 1")
    largest = small_or_merge(written(largest.select("h", F.col("top.root").alias("top")), "join-top"))
    open_ = found.join(largest, "h")
    rest = (open_.where("root != top").alias("x")
            .join(open_.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.root") != F.col("y.root"))
                  & _possible("x", "y")).select(*pair))
    more = written(_links(rest, sets), "join-more")
    return connected(links.unionByName(more)).withColumnRenamed("id", "set")


def ngram_join(docs: DataFrame, width: int = WIDTH, hot_share: float = HOT_SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A text with fewer than ``width`` words is one shingle; one without words,
    or null, is its own component. Equal sets are linked, so copies of an id
    or a text share a component. A null id takes part in links and gets the
    smallest id of its component, null if there is none. An empty table gives
    no rows. Columns besides doc_id and text are not read.
    """
    docs, salt = small_batches(docs), 0
    while True:
        ids = written(set_ids(docs, width, salt, hot_share), "join-ids")
        classes = written(ids.where("set is not null").groupBy("set").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("rows"), F.min("content").alias("low"),
            F.max("content").alias("high")), "join-classes")
        if classes.where("low != high").isEmpty():
            break
        salt += 1  # two different sets had one name
    entries = ids.agg(F.sum("n_shingles")).first()[0] or 0
    sets = written(shared_entries(docs, entries, hot_shingles(ids, hot_share, hot_least), width, salt), "join-sets")
    roots = linked_sets(sets)
    # only sets of several documents or with links need an id of their own
    classes = written(classes.join(roots, "set", "left").where("rows > 1 or root is not null")
                      .select("set", "first", F.coalesce("root", "set").alias("root")), "join-classes")
    firsts = written(classes.groupBy("root").agg(F.min("first").alias("component_id")), "join-firsts")
    named = written(classes.join(firsts, "root").select("set", "component_id"), "join-named")
    return ids.join(small_or_merge(named), "set", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each component:
    the one with the smallest id. Of rows that share an id one stays; rows
    without id all stay."""
    found = written(ngram_join(docs, width), "join-components")
    dropped = small_or_merge(written(
        found.where("doc_id != component_id").select("doc_id").distinct(), "join-dropped"))
    again = small_or_merge(written(
        found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"),
        "join-again"))
    kept = docs.join(dropped, "doc_id", "left_anti")
    once = kept.join(again, "doc_id", "left_anti")
    return once.unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(docs.columns)


def one_row_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each component: the
    one with the smallest id (null last), then the smallest hash of its text.

    A document is what shares id and text (null as empty); of its rows one
    stays. Rows that share an id but not the text, and rows without id, are
    documents of their own.
    """
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"),
                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("content"))
    found = written(ngram_join(docs.select(name.alias("doc_id"), "text"), width), "join-components")
    dropped = small_or_merge(written(
        found.where("doc_id != component_id").select(F.col("doc_id").alias("name")).distinct(), "join-dropped"))
    again = small_or_merge(written(
        found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("name")).count().where("count > 1")
        .select("name"), "join-again"))
    # the row as one column, so that no column of it meets one of ours
    rows = docs.select(name.alias("name"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(dropped, "name", "left_anti")
    once = kept.join(again, "name", "left_anti")
    return once.unionByName(kept.join(again, "name", "left_semi").dropDuplicates(["name"])).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE a <> b AND 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""
