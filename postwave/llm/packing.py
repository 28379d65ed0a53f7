"""Mixture-controlled packing of documents into windows of tokens.

Every source is a queue of documents in seeded order. Windows are filled by
deficit round-robin over the queues: each window credits a queue with its
share of the window, takes whole tokens and carries the broken rest on as the
queue's deficit. As the credit of a queue after ``w`` windows is a fixed
product, the deficits need not be handed from window to window or from task to
task: with the queues in a fixed order, ``total`` tokens in all and ``upto(s)``
tokens in the queues up to ``s``, those together have sent

    sent(s, w) = floor(w * window * upto(s) / total)

tokens after ``w`` windows. Queue ``s`` has sent ``sent(s, w) - sent(s-1, w)``
of them, all queues together fill every window to the last token, and no
queue is ever off its share by more than a token. So the place of any token
follows from its place in its queue, and each task packs its documents alone,
exactly as one sequential run over all windows would.

Target proportions other than the sources' own make queues run out one after the
other. The windows then fall into phases: within one, every queue that is left
sends its share of the rest, and the first to run out ends it. Phases are worked
out from the queues' totals, and the closed form holds within each.

Sources with less than ``LEAST`` tokens a window, told by the bytes of their texts,
are joined into one queue, in one seeded order over all their documents, so that
pieces do not get shorter than that on average. There are at most WINDOW / LEAST
other queues, however many sources there are; only those and their totals come to
the driver. The last window is the only one that may need padding.
"""
from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postwave.llm.hashing import text_chunks
from postwave.llm.tables import read, small_batches, small_or_merge, written
from postwave.llm.tokens import WordTokens

WINDOW = 4096
LEAST = 16
SEED = 29
# The tokenizer file and the id that ends a document.
VOCABULARY = "word_bpe_49k.json"
END = 2
# Documents of a queue that are put in order together, about, and the most
# slices of a queue as a power of two.
BUCKET_ROWS = 4_000
BITS = 20
CHUNK = 3 << 20


def public_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def _source_key():
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("s"), F.col("source").cast("string"))).alias("source")


def _queues(sizes: list[tuple[str, int]], window: int) -> list[list[str]]:
    """The sources of each queue: one, or all that are too small for one."""
    total = sum(n for _, n in sizes)
    ranked = sorted(sizes, key=lambda x: (-x[1], x[0]))
    big = [s for s, n in ranked if n * window >= LEAST * total]
    small = [s for s, _ in ranked[len(big):]]
    if small and big and sum(n for _, n in ranked[len(big):]) * window < LEAST * total:
        # what is left is too little for a queue even together
        small.append(big.pop())
    return [[s] for s in big] + ([small] if small else [])


# In lists of sources: all that are not named.
OTHERS = ""


def queues_of(docs: DataFrame, window: int) -> tuple[list[list[str]], list[int]]:
    """The queues, as lists of sources (OTHERS for all that are in no list), and
    their documents."""
    sizes = written(docs.groupBy(_source_key()).agg(
        F.count("*").alias("rows"), F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("bytes")), "pack-sources")
    total = sizes.agg(F.sum("bytes"), F.sum("rows")).first()
    if not total[0]:
        return [], []
    # no more than window / LEAST of them can have that much
    big = {r["source"]: r for r in sizes.where(F.col("bytes") * window >= LEAST * total[0]).collect()}
    rest = total[0] - sum(r["bytes"] for r in big.values())
    queues = _queues([(s, r["bytes"]) for s, r in big.items()] + ([(OTHERS, rest)] if rest else []), window)
    other = total[1] - sum(r["rows"] for r in big.values())
    return queues, [sum(big[s]["rows"] if s in big else other for s in q) for q in queues]


def _numbered(values: list, of) -> Column:
    """A value by the place in a short list."""
    if not values:
        return F.lit(None).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), of + 1)


def encoded(docs: DataFrame, vocabulary: str, seed: int, queues: list[list[str]], rows: list[int]) -> DataFrame:
    """doc_id, queue, slice of its seeded order, ids (2 or 4 bytes each, with
    the end id), n, wide and ``at``, the ids before the document in its slice.
    Texts are encoded once; only ids are shuffled."""
    number = {s: i for i, q in enumerate(queues) for s in q}
    known = [x for s, i in number.items() if s != OTHERS for x in (F.lit(s), F.lit(i))]
    queue = F.lit(number.get(OTHERS, 0))
    if known:
        queue = F.coalesce(F.element_at(F.create_map(*known), F.col("source")), queue)
    # a power of two of slices per queue, of about BUCKET_ROWS rows each
    bits = [min(BITS, math.ceil(math.log2(max(n / BUCKET_ROWS, 1)))) for n in rows]
    turn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 1)
    queued = docs.select("doc_id", _source_key(), turn.alias("turn"), "text").select(
        "doc_id", "source", "turn", queue.cast("int").alias("queue"), "text").withColumn(
        "bits", _numbered(bits, F.col("queue"))).select(
        "doc_id", "source", "turn", "queue",
        F.expr(f"shiftleft(shiftright(turn, 63 - bits), {BITS} - bits)").cast("long").alias("slice"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens.of(vocabulary)
        for part, texts in text_chunks(batches, limit=CHUNK):
            ids, n = tokens.encode(texts)
            stop = np.cumsum(n)
            end = np.array([END], ids.dtype).tobytes()
            blobs = [ids[e - k:e].tobytes() + end for e, k in zip(stop, n)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:5], pa.array(blobs, pa.binary()), pa.array(n + 1),
                 pa.array(np.full(len(n), ids.itemsize, np.int32))],
                names=["doc_id", "source", "turn", "queue", "slice", "ids", "n", "wide"])

    order = Window.partitionBy("queue", "slice").orderBy("turn", "source", "doc_id", "ids")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (queued.mapInArrow(encode, f"doc_id {_kind(docs)}, source string, turn long, queue int, slice long, "
                                      "ids binary, n long, wide int")
            .select("doc_id", "queue", "slice", "ids", "n", "wide", F.coalesce(before, F.lit(0)).alias("at")))


def phases_of(totals: list[int], shares: list[float] | None, window: int) -> list[tuple[int, list[int]]]:
    """(first window, tokens of each queue) of every phase. Without ``shares``
    (the queues' own proportions) there is one phase."""
    if shares is None:
        return [(0, list(totals))]
    left, found, w = list(totals), [], 0
    while any(left):
        live = [i for i, n in enumerate(left) if n]
        asked = [i for i in live if shares[i] > 0]
        if len(live) == 1 or not asked:
            # the last queue, or those without a share in their own proportions
            found.append((w, left))
            break
        part = {i: shares[i] / sum(shares[j] for j in asked) for i in live}
        n = min(int(left[i] / (part[i] * window)) for i in asked)
        size = max(n, 1) * window
        take = {i: min(left[i], int(part[i] * size)) for i in live}
        for i in sorted(live, key=lambda i: (-part[i], i)):
            more = min(left[i] - take[i], size - sum(take.values()))
            take[i] += more
        found.append((w, [take.get(i, 0) for i in range(len(left))]))
        left = [x - take.get(i, 0) for i, x in enumerate(left)]
        w += max(n, 1)
    return found


def _packed(docs: DataFrame, vocabulary: str | None, window: int, seed: int, targets: dict | None):
    """The encoded documents with their place in their queue, and the phases."""
    queues, many = queues_of(docs, window)
    rows = written(encoded(docs, vocabulary or public_vocabulary(), seed, queues, many), "pack-ids")
    per_slice = written(rows.groupBy("queue", "slice").agg(F.sum("n").alias("n")), "pack-slices")
    totals = {r["queue"]: r["n"] for r in per_slice.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    totals = [totals.get(i, 0) for i in range(len(queues))]
    shares = None
    if targets is not None:
        # of a joint queue: its named sources' targets, and what is left for the rest
        key = {("n" if k is None else f"s{k}"): float(v) for k, v in targets.items()}
        shares = [sum(key.get(s, 0.0) for s in q) for q in queues]
        apart = [i for i, q in enumerate(queues) if OTHERS in q]
        for i in apart:
            named = {s for q in queues for s in q}
            shares[i] += sum(v for s, v in key.items() if s not in named)
    before = F.sum("n").over(Window.partitionBy("queue").orderBy("slice")) - F.col("n")
    starts = written(per_slice.select("queue", "slice", before.alias("begin")), "pack-starts")
    placed = rows.join(small_or_merge(starts), ["queue", "slice"]).select(
        "doc_id", "queue", (F.col("begin") + F.col("at")).alias("at"), "ids", "wide")
    return placed, phases_of(totals, shares, window)


PIECE = "start long, length long, {ids}, doc_tokens long, sequence_id long, offset long"


def pieces(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW,
           seed: int = SEED, targets: dict | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (array), doc_tokens,
    sequence_id, offset.

    A document is its token ids and the end id; a null or empty text is the
    end id alone. Documents are cut wherever a window is full; every id lies in
    exactly one piece. Null source: a queue of its own. Rows with the same id
    are separate documents, in the order of their ids' bytes. An empty table
    gives no rows. Columns besides doc_id, text and source are not read.

    Windows hold the sources in their own proportions, or in those of
    ``targets`` (weights by source) as long as each lasts; sources with no
    weight, or none left over, fill the windows at the end.
    """
    placed, phases = _packed(small_batches(docs), vocabulary, window, seed, targets)
    return placed.mapInArrow(_cutter(phases, window, False), f"doc_id {_kind(docs)}, " + PIECE.format(ids="ids array<int>"))


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _cutter(phases: list[tuple[int, list[int]]], window: int, digest: bool):
    """Cuts documents into pieces, with their ids or, as a ``digest``, the crc32
    of them."""
    bounds = [(w, [0, *accumulate(sizes)]) for w, sizes in phases]
    # of each queue: the tokens before every phase
    before = [list(accumulate((sizes[q] for _, sizes in phases), initial=0)) for q in range(len(phases[0][1]) if phases else 0)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, at, blobs, wide = (c.to_pylist() for c in batch.columns[1:])
            out: list[list] = [[] for _ in range(6)]
            flat, sums = [], []
            for i, blob in enumerate(blobs):
                ids = np.frombuffer(blob, np.uint16 if wide[i] == 2 else np.uint32)
                if digest:
                    ids = ids.astype("<u4")
                else:
                    flat.append(ids.astype(np.int32))
                for piece in _phased_cuts(bounds, before[queue[i]], queue[i], at[i], len(ids), window):
                    if digest:
                        sums.append(zlib.crc32(ids[piece[0]:piece[0] + piece[1]]))
                    for c, v in zip(out, (i, piece[0], piece[1], len(ids), piece[2], piece[3])):
                        c.append(v)
            cuts = np.concatenate(([0], np.cumsum(out[2]))).astype(np.int32)
            # the pieces of a document come one after the other, so the ids need not move
            told = (pa.array(sums, pa.int64()) if digest else
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(flat or [cuts[:0]]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), told, *(pa.array(c, pa.int64()) for c in out[3:])],
                names=["doc_id", "start", "length", "ids_crc32" if digest else "ids", "doc_tokens", "sequence_id", "offset"])

    return cut


def _phased_cuts(bounds, before: list[int], s: int, at: int, n: int, window: int) -> list[tuple[int, int, int, int]]:
    """``_cuts`` over all phases that the document's tokens fall into."""
    found, done = [], 0
    k = bisect_right(before, at) - 1
    while done < n:
        # empty phases of the queue have the same place before and after
        while before[k + 1] <= at + done:
            k += 1
        first, upto = bounds[k]
        take = min(n - done, before[k + 1] - at - done)
        for start, length, w, offset in _cuts(upto, s, at + done - before[k], take, window):
            found.append((done + start, length, first + w, offset))
        done += take
        k += 1
    return found


def _cuts(upto: list[int], s: int, at: int, n: int, window: int) -> list[tuple[int, int, int, int]]:
    """The pieces (start, length, window, offset) of a document of ``n``
    tokens at place ``at`` of queue ``s``."""
    total, low, high = upto[-1], upto[s], upto[s + 1]

    def sent(t: int, w: int) -> int:
        return w * window * t // total if w * window < total else t

    # the window of the first token: the last one that begins at or before it
    w = max(at * total // ((high - low) * window) - 1, 0)
    while sent(high, w + 1) - sent(low, w + 1) <= at:
        w += 1
    found, start = [], 0
    while start < n:
        begin = sent(high, w) - sent(low, w)
        stop = sent(high, w + 1) - sent(low, w + 1)
        take = min(stop - at - start, n - start)
        if take > 0:
            found.append((start, take, w, sent(low, w + 1) - sent(low, w) + at + start - begin))
            start += take
        w += 1
    return found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(read(spark, sf_dir, "documents"))


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``pieces`` with crc32 over each piece's ids in place of the ids."""
    placed, phases = _packed(small_batches(docs), vocabulary, WINDOW, SEED, None)
    return placed.mapInArrow(_cutter(phases, WINDOW, True), f"doc_id {_kind(docs)}, " + PIECE.format(ids="ids_crc32 long"))
