"""Vectorised word hashes: numpy over the bytes of many texts at once, used
inside tasks that Spark has dealt out."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
# the inverse of an odd number modulo 2**64
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * (out[have - 1:have] * base)
        have += more
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, index of the first word of each text and the end).

    Words are the runs of bytes that are no ASCII white space; A-Z count as
    a-z if ``lower``. A word's hash is a polynomial of its bytes in an odd base
    modulo 2**64, mixed with its length."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    if lower:
        data = _LOWER[data]
    gap = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
    start, stop = edge[0::2], edge[1::2]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    h = (sums[stop] - sums[start]) * _powers(_BACK, len(data) + 1)[start]
    h = mix(h + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, np.concatenate(([0], np.searchsorted(start, ends)))


def shingles(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, text of each): windows of ``width`` words, the whole
    sequence for a shorter text, none for a text without words."""
    count = np.diff(first)
    n = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    owner = np.repeat(np.arange(len(count)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][owner]
    last = first[1:][owner]
    out = np.zeros(len(owner), np.uint64)
    for k in range(width):
        inside = at + k < last
        w = np.where(inside, h[np.minimum(at + k, max(len(h) - 1, 0))], np.uint64(0)) if len(h) else out
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + w + np.uint64(k))
    return out, owner


def distinct(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, hash) pairs, by owner and hash."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``limit`` bytes of text (one longer
    text is a slice of its own), and their texts as UTF-8, null as empty."""
    # give memory back when a batch is done, as workers live on beside the JVM
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            column = column.cast(pa.large_binary())
        texts = [x or b"" for x in column.to_pylist()]
        low = size = 0
        for i, t in enumerate(texts):
            if i > low and size + len(t) > limit:
                yield batch.slice(low, i - low), texts[low:i]
                low, size = i, 0
            size += len(t)
        if low < len(texts):
            yield batch.slice(low), texts[low:]
