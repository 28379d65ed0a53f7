"""Interpolated modified Kneser-Ney bigram model.

Counting is a Spark job: tasks pack the distinct (context, word) pairs of their
texts by shard of the context, each shard adds them up and writes its part of
the model, and a second, small shuffle by word counts the distinct contexts
that each word follows (the lower order's continuation counts). The few
contexts that hold more than ``1 / HOT`` of the tokens are dealt over all
shards by pair, and their totals are added up afterwards.

The model is a folder of sorted hash arrays in the shared folder: pairs with
counts, contexts with their totals and numbers of words seen once, twice and
more, words with continuation counts. Scoring is one pass over the documents
without a shuffle: workers map the arrays into memory, look up the distinct
pairs and words of a piece of text, and read only the pages they touch. If the
shared folder is no mounted path, workers fetch each array into a temporary
file first, which has no name left when it is mapped.

Discounts come from the counts of counts as in Chen and Goodman (1999). The
lowest order is mixed with an even share for every training word and one
unknown word, so the probabilities after any context add up to one.
"""
from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm import hashing
from postwave.llm.tables import read, remainder, small_batches, written
from postwave.session import shared_path

CHUNK = 4 << 20
HOT = 256
# Hashes that stand for the places before and after a text.
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_LOW = np.uint64((1 << 48) - 1)


def sequences(texts: list[bytes]):
    """(context and word hash of every token, tokens per text); the last
    token of each text is END, the context of its first one START."""
    h, first = hashing.word_hashes(texts)
    count = np.diff(first) + 1
    stop = np.cumsum(count) - 1
    word = np.empty(len(h) + len(texts), np.uint64)
    ends = np.zeros(len(word), bool)
    ends[stop] = True
    word[ends] = END
    word[~ends] = h
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[stop - count + 1] = START
    return context, word, count


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return hashing.mix(context * np.uint64(3) + (word & _LOW))


def _sum_by(key: np.ndarray, *values: np.ndarray):
    """Distinct keys in order, and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[start], *(np.add.reduceat(v[order], start) if len(key) else v for v in values), order[start]


def _store(folder: str):
    """The file system of a folder as Python workers reach it, and the path in
    it. Hadoop's names for S3 are those of one store."""
    scheme, mark, rest = folder.partition("://")
    if mark and scheme in ("s3a", "s3n"):
        folder = f"s3://{rest}"
    try:
        return fs.FileSystem.from_uri(folder)
    except (pa.ArrowInvalid, OSError) as e:
        raise ValueError(f"Python workers cannot reach {folder}: name a mounted path, hdfs://, s3a:// or gs:// in "
                         "spark.checkpoint.dir") from e


# One array file: the number of keys, bytes per value, the sorted keys, then columns.
def _save(folder: str, name: str, keys: np.ndarray, *columns: np.ndarray) -> None:
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    wide = max((int(c.max(initial=0)) for c in columns)) >> 32
    part = f"{base}/.{name}.{np.random.default_rng().integers(1 << 62)}"
    with store.open_output_stream(part) as out:
        out.write(np.array([len(keys), 8 if wide else 4], np.int64).tobytes())
        out.write(np.ascontiguousarray(keys, np.uint64).tobytes())
        for c in columns:
            out.write(c.astype(np.uint64 if wide else np.uint32).tobytes())
    # a task that runs again writes the same bytes
    store.move(part, f"{base}/{name}")


class _Arrays:
    """A sorted hash array in memory-mapped form."""

    def __init__(self, folder: str, name: str, columns: int):
        store, base = _store(folder)
        if isinstance(store, fs.LocalFileSystem):
            data = np.memmap(f"{base}/{name}", np.uint8, "r")
        else:
            with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{base}/{name}") as source:
                while block := source.read(1 << 24):
                    copy.write(block)
                copy.flush()
                data = np.memmap(copy, np.uint8, "r")
        n, wide = (int(x) for x in data[:16].view(np.int64))
        self.keys = data[16:16 + 8 * n].view(np.uint64)
        rest = data[16 + 8 * n:].view(np.uint64 if wide == 8 else np.uint32)
        self.columns = [rest[i * n:(i + 1) * n] for i in range(columns)]

    def find(self, keys: np.ndarray) -> list[np.ndarray]:
        """The columns at ``keys``, 0 where a key is missing."""
        if not len(self.keys):
            return [np.zeros(len(keys), np.int64) for _ in self.columns]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return [np.where(hit, c[at].astype(np.int64), 0) for c in self.columns]


def _packed(v: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs in order of their contexts: each context once with its number of
    pairs, then 6 bytes of every word and its count."""
    start = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    runs = np.diff(np.append(start, len(v)))
    return b"".join((np.array([len(start), len(v)], np.int64).tobytes(), v[start].tobytes(),
                     runs.astype(np.uint32).tobytes(), (w & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                     n.astype(np.uint32).tobytes(), (w >> np.uint64(32)).astype(np.uint16).tobytes()))


def _unpacked(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k, n = (int(x) for x in np.frombuffer(b, np.int64, 2))
    v = np.repeat(np.frombuffer(b, np.uint64, k, 16), np.frombuffer(b, np.uint32, k, 16 + 8 * k))
    at = 16 + 12 * k
    w = np.frombuffer(b, np.uint32, n, at).astype(np.uint64)
    w |= np.frombuffer(b, np.uint16, n, at + 8 * n).astype(np.uint64) << np.uint64(32)
    return v, w, np.frombuffer(b, np.uint32, n, at + 4 * n).astype(np.int64)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more. Where a count of counts is 0
    the share is taken as one half; no discount is 0, so that no mass is."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    ratio = [n2 / n1 if n1 else 0.5, n3 / n2 if n2 else 0.5, n4 / n3 if n3 else 0.5]
    return np.array([0.0, *(min(max(k - (k + 1) * y * r, 0.05), k) for k, r in enumerate(ratio, 1))])


@dataclass
class Model:
    """Where the arrays are, and the totals. ``pairs`` and ``conts`` are the
    numbers of pairs with counts 1 to 4 and of words with as many contexts."""
    folder: str
    shards: int
    kept: dict[str, frozenset[int]] = field(default_factory=dict)
    tokens: int = 0
    texts: int = 0
    words: int = 0
    types: int = 0
    pairs: list[int] = field(default_factory=lambda: [0] * 4)
    conts: list[int] = field(default_factory=lambda: [0] * 4)
    conts_more: int = 0
    hot: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)

    def vocabulary(self) -> int:
        """Distinct training tokens, END among them."""
        return self.words + (1 if self.texts else 0)


class _Scorer:
    _kept: dict[str, "_Scorer"] = {}

    def __init__(self, model: Model):
        self.m, self._open = model, {}
        self.d2, self.d1 = discounts(*model.pairs), discounts(*model.conts)
        more = self.d1[1] * model.conts[0] + self.d1[2] * model.conts[1] + self.d1[3] * model.conts_more
        self.even = (more / model.types if model.types else 1.0) / (model.vocabulary() + 1)
        self.hot = np.array(sorted(model.hot), np.uint64)

    @classmethod
    def of(cls, model: Model) -> "_Scorer":
        if model.folder not in cls._kept:
            cls._kept.clear()
            cls._kept[model.folder] = cls(model)
        return cls._kept[model.folder]

    def _find(self, kind: str, columns: int, shard: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        out = [np.zeros(len(keys), np.int64) for _ in range(columns)]
        order = np.lexsort((keys, shard))
        cut = np.searchsorted(shard[order], np.arange(self.m.shards + 1))
        for s in range(self.m.shards):
            at = order[cut[s]:cut[s + 1]]
            if len(at) and s in self.m.kept[kind]:
                if (kind, s) not in self._open:
                    self._open[kind, s] = _Arrays(self.m.folder, f"{kind}-{s}", columns)
                for o, got in zip(out, self._open[kind, s].find(keys[at])):
                    o[at] = got
        return out

    def score(self, texts: list[bytes]):
        """Per text: tokens, known tokens, base score and score."""
        m, shards = self.m, np.uint64(self.m.shards)
        if not m.types:
            count = sequences(texts)[2]
            zero = np.zeros(len(texts))
            return count, zero.astype(np.int64), zero, zero
        context, word, count = sequences(texts)
        owner = np.repeat(np.arange(len(texts)), count)
        names, where = np.unique(word, return_inverse=True)
        contexts, which = np.unique(context, return_inverse=True)
        # counts of words are the totals of their contexts; END is none
        total = self._find("contexts", 4, (hashing.mix(contexts) % shards).astype(np.int64), contexts)
        at = np.searchsorted(self.hot, contexts)
        for i in np.flatnonzero(np.isin(contexts, self.hot)):
            for t, v in zip(total, m.hot[int(self.hot[at[i]])]):
                t[i] = v
        place = np.minimum(np.searchsorted(contexts, names), len(contexts) - 1)
        seen = np.where(contexts[place] == names, total[0][place], 0)
        seen[names == END] = m.texts
        base = np.log10((seen + 0.5) / (m.tokens + 0.5 * (m.vocabulary() + 1)))
        low = names & _LOW
        cont = self._find("words", 1, (low % shards).astype(np.int64), low)[0]
        lower = np.maximum(cont - self.d1[np.minimum(cont, 3)], 0) / m.types + self.even
        pairs, first, back = np.unique(pair_key(context, word), return_index=True, return_inverse=True)
        v = context[first]
        hit = self._find("pairs", 1, _shard(v, pairs, self.hot, self.m.shards), pairs)[0]
        sums, ones, twos, more = (t[which[first]] for t in total)
        rest = self.d2[1] * ones + self.d2[2] * twos + self.d2[3] * more
        p1 = lower[where[first]]
        p = np.where(sums > 0, (np.maximum(hit - self.d2[np.minimum(hit, 3)], 0) + rest * p1)
                     / np.maximum(sums, 1), p1)
        add = lambda x: np.bincount(owner, weights=x, minlength=len(texts))
        return count, add(seen[where] > 0).astype(np.int64), add(base[where]), add(np.log10(p)[back])


def _shard(context: np.ndarray, key: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    by = np.where(np.isin(context, hot), key, hashing.mix(context)) if len(hot) else hashing.mix(context)
    return (by % np.uint64(shards)).astype(np.int64)


def _hot_contexts(docs: DataFrame) -> np.ndarray:
    """Contexts that hold more than 1 / HOT of all tokens: a task names those
    of each piece of text, and only named ones are added up. There are fewer
    than HOT of them, whatever the input."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in hashing.text_chunks(batches, limit=CHUNK):
            context, _, _ = sequences(texts)
            v, n = np.unique(context, return_counts=True)
            named = n * HOT * 2 > len(context)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(v[named], START).astype(np.int64)), pa.array(np.append(n[named], 0)),
                 pa.array(np.append(np.zeros(int(named.sum()), np.int64), len(context)))],
                names=["v", "n", "tokens"])

    seen = written(docs.select("text").mapInArrow(task, "v long, n long, tokens long")
                   .groupBy("v").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens")), "lm-hot")
    tokens = seen.agg(F.sum("tokens")).first()[0] or 0
    rows = seen.where(F.col("n") * HOT > tokens).select("v").collect()
    return np.sort(np.array([r["v"] for r in rows], np.int64).astype(np.uint64))


def train(docs: DataFrame, shards: int | None = None) -> Model:
    """The model of all rows of ``docs`` (text); null texts are empty."""
    spark = docs.sparkSession
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    folder = shared_path(spark, "lm")
    if "://" not in folder and ":/" not in folder:
        folder = f"file://{folder}"
    hot = _hot_contexts(docs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in hashing.text_chunks(batches, limit=CHUNK):
            context, word, _ = sequences(texts)
            key, n, first = _sum_by(pair_key(context, word), np.ones(len(word), np.int64))
            v, w = context[first], word[first] & _LOW
            shard = _shard(v, key, hot, shards)
            order = np.lexsort((v, shard))
            v, w, n = v[order], w[order], n[order]
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = [(s, _packed(v[a:b], w[a:b], n[a:b]))
                    for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                names=["shard", "part"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(b) for b in pdf["part"]]
        v, w, n = (np.concatenate(x) for x in zip(*parts))
        del parts
        key, n, first = _sum_by(pair_key(v, w), n)
        v, w = v[first], w[first]
        s = int(pdf["shard"].iloc[0])
        _save(folder, f"pairs-{s}", key, n)
        sums = _sum_by(v, n, *((n == k).astype(np.int64) for k in (1, 2)), (n > 2).astype(np.int64))[:5]
        split = np.isin(sums[0], hot)
        whole = [x[~split] for x in sums]
        _save(folder, f"contexts-{s}", *whole)
        words, types = _sum_by(w, np.ones(len(w), np.int64))[:2]
        goal = (words % np.uint64(shards)).astype(np.int64)
        order = np.argsort(goal, kind="stable")
        cut = np.searchsorted(goal[order], np.arange(shards + 1))
        to = [(g, words[order[a:b]].tobytes() + types[order[a:b]].astype(np.uint32).tobytes())
              for g, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
        of = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        stats = np.array([[s, int(whole[1].sum()), len(key), int((whole[0] != START).sum()), *of]], np.int64)
        parts_hot = np.column_stack([x[split].astype(np.int64) for x in sums]) if split.any() else np.zeros((0, 5), np.int64)
        return pd.DataFrame({
            "goal": np.array([g for g, _ in to] + [-1] + [-2] * len(parts_hot), np.int32),
            "part": pd.Series([x for _, x in to] + [None] * (1 + len(parts_hot)), dtype=object),
            "numbers": pd.Series([None] * len(to) + list(stats) + list(parts_hot), dtype=object)})

    counted = written(docs.select("text").mapInArrow(pack, "shard int, part binary").groupBy("shard")
                      .applyInPandas(count, "goal int, part binary, numbers array<long>"), "lm-counted")

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        words, types = [], []
        for b in pdf["part"]:
            k = len(b) // 12
            words.append(np.frombuffer(b, np.uint64, k))
            types.append(np.frombuffer(b, np.uint32, k, 8 * k).astype(np.int64))
        words, types = _sum_by(np.concatenate(words), np.concatenate(types))[:2]
        _save(folder, f"words-{int(pdf['goal'].iloc[0])}", words, types)
        of = [int(pdf["goal"].iloc[0]), *((types == k).sum() for k in (1, 2, 3, 4)), (types > 2).sum()]
        return pd.DataFrame({"numbers": pd.Series([np.array(of, np.int64)], dtype=object)})

    followed = written(counted.where("goal >= 0").select("goal", "part").groupBy("goal")
                       .applyInPandas(follow, "numbers array<long>"), "lm-followed")
    model = Model(folder, shards, texts=docs.count(), hot={})
    # a row of totals for each shard, and fewer than HOT rows of contexts
    total = written(counted.where("goal = -1").select("numbers").unionByName(followed), "lm-totals")
    rows = [r["numbers"] for r in total.collect()]
    of, after = [r for r in rows if len(r) == 8], [r for r in rows if len(r) == 6]
    made = frozenset(r[0] for r in of)
    model.kept = {"pairs": made, "contexts": made, "words": frozenset(r[0] for r in after)}
    _, model.tokens, model.types, model.words, *model.pairs = (sum(x) for x in zip(*(of or [[0] * 8])))
    _, *model.conts, model.conts_more = (sum(x) for x in zip(*(after or [[0] * 6])))
    at = lambda i: F.sum(F.get("numbers", F.lit(i))).alias(f"n{i}")
    for r in (counted.where("goal = -2").groupBy(F.get("numbers", F.lit(0)).alias("v"))
              .agg(*(at(i) for i in range(1, 5))).collect()):
        v = int(np.int64(r["v"]).astype(np.uint64))
        model.hot[v] = (r["n1"], r["n2"], r["n3"], r["n4"])
        model.tokens += r["n1"]
        model.words += v != int(START)
    return model


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score and score of every row
    of ``docs`` (text); scores are sums of log10 probabilities."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer.of(model)
        for part, texts in hashing.text_chunks(batches, limit=CHUNK):
            got = scorer.score(texts)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()),
                 pa.array(got[2], pa.float64()), pa.array(got[3], pa.float64())],
                names=[*keep, "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(*keep, "text")
    given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(task, f"{given}, n_tokens long, n_known long, base_score double, score double")


def evaluate(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, perplexity.

    Learns from rows whose crc32(doc_id) modulo 5 is not 1. A null or empty
    text is the end token alone. Rows with the same id are scored one by one.
    Without training texts every token has probability 1. An empty table gives
    no rows. Columns besides doc_id and text are not read.
    """
    rest = remainder(F.col("doc_id"), 5)
    model = train(small_batches(docs).where(rest != 1))
    rows = docs.select("doc_id", (rest == 1).alias("held_out"), "text")
    return score(rows, model, "doc_id", "held_out").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(read(spark, sf_dir, "documents"))
