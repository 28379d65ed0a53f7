"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled sample text knows every
substring of it. A text is parsed, left to right, into the longest phrases the
automaton knows; the fewer phrases a language needs, each told by its place in
the sample, the fewer bits a letter costs. The language with the fewest bits
per letter wins.

A phrase costs log2 of the letters of the language's own sample. Told by a small
sample alone that would be cheap, so a language pays once, for every text, what
its sample lacks to the largest one, and a sample of fewer than ``FEW`` letters
counts as that many in the cost of a phrase. A letter that begins no phrase costs
the same in every language: a phrase of the largest sample, and log2 of the
alphabet. Every language with a letter in its labelled texts is learned.

The one bound of the fit is ``sample_letters``: so many letters of labelled rows are
learned from, shared evenly by the languages and never more than ``LANGUAGE_LETTERS``
(of ``LANGUAGE_ROWS`` rows) each. Rows are taken whole, by the seeded hash of their id, until a language's
share is used up. Of a language whose rows are all longer than a part of its
share, slices of that length from seeded places are taken instead. Every whole
text is predicted. Every letter of a sample has a code, whatever the script. The
sample, not the automata, is sent to the tasks, which build the automata once
each.

Texts are parsed in blocks of ``BLOCK`` letters, all blocks of a batch of texts
side by side in numpy; a phrase ends with its block, in each language alike.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postwave.llm.hashing import text_chunks
from postwave.llm.tables import read, remainder, small_batches, small_or_merge, written

# Letters of labelled rows that are learned from, in all and of one language; a
# row may be up to one of ROW_PART parts of its language's share.
SAMPLE_LETTERS = 8_000_000
LANGUAGE_LETTERS, LANGUAGE_ROWS = 40_000, 250
ROW_PART = 8
FEW = 200
BLOCK = 256
SEED = 11
CHUNK = 3 << 20
# Codes of letters that no sample has, and of everything that is no letter.
UNKNOWN, GAP = 0, 1


def automaton(codes: list[int], letters: int) -> tuple[np.ndarray, np.ndarray]:
    """The edges of the suffix automaton of a sequence: state * letters +
    letter in order, and their targets. 0 is the start and no target."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    keys = np.array([s * letters + c for s, row in enumerate(follow) for c in row], np.int64)
    to = np.array([t for row in follow for t in row.values()], np.int64)
    order = np.argsort(keys)
    # one past the last, so that every search ends at an edge
    return np.append(keys[order], np.iinfo(np.int64).max), np.append(to[order], 0)


def _fold(c: str) -> str:
    """The letter in lower case, itself where that is more than one character."""
    return low if len(low := c.lower()) == 1 else c


class Languages:
    """Automata of all languages over one alphabet. ``samples``: language to
    sample text."""

    _kept: dict[tuple, "Languages"] = {}

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        letters = sorted({_fold(c) for t in samples.values() for c in t if c.isalpha()})
        code = {c: i + 2 for i, c in enumerate(letters)}
        self.code = np.full(0x110000, GAP, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                self.code[i] = code.get(_fold(c), UNKNOWN)
        self.letters = len(letters) + 2
        self.edges, self.first, bits = [], [], []
        for name in self.names:
            seq = self._codes(samples[name].encode()).tolist()
            keys, to = automaton(seq, self.letters)
            n = np.searchsorted(keys, self.letters)
            first = np.zeros(self.letters, np.int64)
            first[keys[:n]] = to[:n]
            self.edges.append((keys, to))
            self.first.append(first)
            bits.append(math.log2(max(len(seq), FEW)))
        self.bits = np.array(bits)
        most = max(bits, default=1.0)
        self.smaller = most - self.bits
        self.letter = most + math.log2(len(letters) + 2)

    @classmethod
    def of(cls, samples: tuple[tuple[str, str], ...]) -> "Languages":
        if samples not in cls._kept:
            cls._kept.clear()
            cls._kept[samples] = cls(dict(samples))
        return cls._kept[samples]

    def _codes(self, text: bytes) -> np.ndarray:
        """The letters of a text; a run of other characters is one GAP."""
        points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        codes = self.code[points]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != GAP) | (codes[:-1] != GAP)
        return codes[keep]

    def phrases(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases of each text in each language, letters of each text)."""
        found, single, letters = self.parse(texts)
        return found + single, letters

    def parse(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases the sample has, letters that begin none, both of each text
        in each language; letters of each text)."""
        each = [self._codes(t) for t in texts]
        letters = np.array([int((c != GAP).sum()) for c in each], np.int64)
        sizes = np.array([len(c) for c in each], np.int64)
        lanes = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(each)), lanes)
        flat = np.concatenate([*each, np.zeros(BLOCK, np.uint32)]).astype(np.int64)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = (np.cumsum(sizes) - sizes)[owner] + index * BLOCK
        count = np.minimum(sizes[owner] - index * BLOCK, BLOCK)
        # long blocks first, so that the blocks still running are a prefix
        order = np.argsort(-count, kind="stable")
        owner, begin, count = owner[order], begin[order], count[order]
        running = np.searchsorted(-count, -np.arange(BLOCK), "left")
        out = np.zeros((2, len(self.names), len(each)), np.int64)
        for k, ((keys, target), first) in enumerate(zip(self.edges, self.first)):
            state = np.zeros(len(owner), np.int64)
            found, single = np.zeros((2, len(owner)), np.int64)
            for step in range(int(count.max(initial=0))):
                n = running[step]
                c = flat[begin[:n] + step]
                s = state[:n]
                edge = s * self.letters + c
                at = np.searchsorted(keys, edge)
                ends = keys[at] != edge
                # a phrase ends before this letter, which begins the next one
                found[:n] += ends & (s != 0)
                again = first[c]
                single[:n] += ends & (again == 0)
                state[:n] = np.where(ends, again, target[at])
            found += state != 0
            for kind, of in enumerate((found, single)):
                out[kind, k] = np.bincount(owner, weights=of, minlength=len(each)).astype(np.int64)
        return out[0], out[1], letters

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and the second best's share of the bits
        of the best two; ``und`` and 0 without letters or languages."""
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        found, single, letters = self.parse(texts)
        bits = found * self.bits[:, None] + single * self.letter + self.smaller[:, None]
        best = bits.argmin(axis=0)
        low = np.sort(bits, axis=0)
        score = np.ones(len(texts)) if len(self.names) == 1 else low[1] / np.maximum(low[0] + low[1], 1e-9)
        names = [self.names[b] if n else "und" for b, n in zip(best, letters)]
        return names, np.where(letters > 0, score, 0.0)


def learn(docs: DataFrame, sample_letters: int = SAMPLE_LETTERS) -> tuple[tuple[str, str], ...]:
    """(language, sample) pairs from the labelled rows of ``docs`` (doc_id,
    text, lang) that have letters: whole texts by the seeded hash of their id,
    those up to a ROW_PART of the language's share first. A longer text gives
    a slice of that length from a seeded place."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    many = written(known.groupBy("lang").agg(F.count("*").alias("n")), "language-rows")
    share = max(min(LANGUAGE_LETTERS, sample_letters // max(many.count(), 1)), FEW)
    most = max(share // ROW_PART, 1)
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.greatest(F.length("text") - most, F.lit(0)) + 1) + 1
    rows = known.select("lang", "text", place.cast("int").alias("place"), F.xxhash64(F.lit(SEED), "doc_id").alias("turn"))
    # a few times the rows that are taken, so that no task gets more however many there are
    few = F.pmod("turn", F.lit(1 << 30)) / float(1 << 30) * F.col("n") <= 4.0 * LANGUAGE_ROWS
    rows = rows.join(small_or_merge(many), "lang").where(few).select(
        "lang", (F.length("text") > most).alias("long"), "turn",
        F.substring(F.col("text"), F.col("place"), F.lit(most)).alias("text"))
    order = Window.partitionBy("lang").orderBy("long", "turn", "text")
    rows = rows.withColumn("i", F.row_number().over(order)).where(F.col("i") <= LANGUAGE_ROWS)
    rows = rows.withColumn("upto", F.sum(F.length("text")).over(order)).where((F.col("upto") <= share) | (F.col("i") == 1))
    found: dict[str, list[str]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["i"])):
        found.setdefault(r["lang"], []).append(r["text"])
    return tuple((k, "\n".join(v)) for k, v in sorted(found.items()))


def identify(docs: DataFrame, sample_letters: int = SAMPLE_LETTERS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from rows whose crc32(doc_id) modulo 5 is not 0 and whose lang is
    not null, up to ``sample_letters`` letters of them; a language without a
    letter in such rows is not learned. Predicts from the text alone. ``und`` with score 0 for a null
    text, one without letters, and all texts if no language was learned. Of
    languages with equal bits the first by name wins. Rows with the same id are
    predicted one by one. An empty table gives no rows. Columns besides doc_id,
    text and lang are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest = remainder(F.col("doc_id"), 5)
    samples = learn(small_batches(docs).where(rest != 0), sample_letters)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = Languages.of(samples)
        for part, texts in text_chunks(batches, limit=CHUNK):
            names, score = languages.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", (rest == 0).alias("held_out"), "text").mapInArrow(
        task, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
