import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postwave.llm import equal_average, filter_audit, pivot_search
from postwave.llm.vectors import floors, packed, unpacked

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v binary, cell int, code string, d binary, of int"


def vectors(n, dim, seed, groups=6):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.4, (groups, dim))
    return [[float(np.float32(x)) for x in centres[i % groups] + r.normal(0, 0.1, dim)] for i in range(n)]


def vec_row(vec_id, v, label=1):
    return (vec_id, v, label, 1, b"x", 2, "c", b"y", 3)


@pytest.fixture(scope="session")
def odd_vectors():
    v = vectors(150, 8, 3)
    bad = [None, [], [0.5] * 3, [None] + [0.1] * 7, [float("nan")] + [0.1] * 7, [float("inf")] + [0.1] * 7]
    rows = [vec_row(i, x, None if i % 7 == 0 else i % 4) for i, x in enumerate(v)]
    rows += [vec_row(200 + i, x) for i, x in enumerate(bad)]
    # told twice, equal vectors under other ids, a null id, negative ids
    rows += [vec_row(20, v[20], 0), vec_row(20, v[20], 0), vec_row(None, v[3], None), vec_row(-40, v[4], 2)]
    rows += [vec_row(300 + i, v[40], 9) for i in range(40)]
    return rows


def whole(rows, scale):
    """(vec_id, label, integers) of the rows that take part."""
    ok = [r for r in rows if r[1] and len(r[1]) == 8 and all(x is not None and np.isfinite(x) for x in r[1])]
    return [(r[0], r[2], [int(np.floor(scale * np.float64(np.float32(x)))) for x in r[1]]) for r in ok]


def top(rows, k):
    """Rank, id and score per query row by a full search."""
    rows = whole(rows, 64)
    found = []
    for i, (q, _, v) in enumerate(rows):
        if q is None or q % 20:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), x is None, x or 0, x) for j, (x, _, w) in enumerate(rows)
                         if j != i), key=lambda t: t[:3])
        found += [(q, rank, s[3], -s[0]) for rank, s in enumerate(scores[:k], 1)]
    return Counter(found)


@pytest.mark.parametrize("k, blocks", [(20, {}), (3, {"candidates": 7, "queries": 2, "pivots": 5, "sample_rows": 16}),
                                       (400, {"candidates": 16}), (5, {"pivots": 1, "sample_rows": 1})])
def test_search_equals_full_search(spark, odd_vectors, k, blocks):
    table = spark.createDataFrame(odd_vectors, SCHEMA).repartition(5)
    got = pivot_search.search(table, F.col("vec_id") % 20 == 0, top=k, **blocks)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == top(odd_vectors, k)


def test_search_of_few_and_no_vectors(spark):
    for rows in ([], [vec_row(0, None)], [vec_row(20, [0.25, 0.5])], [vec_row(20, [0.0]), vec_row(21, [0.0])]):
        table = spark.createDataFrame(rows, SCHEMA)
        got = [tuple(r) for r in pivot_search.search(table, F.col("vec_id") % 20 == 0).collect()]
        assert got == ([(20, 1, 21, 0)] if len(rows) == 2 else [])
        assert got or pivot_search.search(table, F.lit(False)).count() == 0


def test_bounds_are_never_below_the_score():
    r = np.random.default_rng(1)
    for spread in (1, 40, 3000):
        x = r.integers(-spread, spread + 1, (300, 16)).astype(np.int32)
        marks = pivot_search.spread(x, 12)
        norm = pivot_search._norms(x)
        d = pivot_search._distances(x, norm, marks)
        gap = np.abs(d[:, None] - d[None]).max(axis=2).astype(np.float64)
        reach = np.maximum(d.max(axis=1)[:, None], d.max(axis=1)[None])
        bound = pivot_search._bound(norm[:, None] + norm[None], gap, reach)
        assert (bound >= x.astype(np.int64) @ x.astype(np.int64).T).all()


def test_bounds_leave_out_most_candidates():
    """On grouped vectors few bounds reach the k-th score."""
    x = np.array([[int(64 * c) for c in v] for v in vectors(4000, 16, 9, groups=40)], np.int32)
    norm, marks = pivot_search._norms(x), pivot_search.spread(x, 32)
    rows = {"row": np.arange(len(x)), "norm": norm, "v": x.astype(np.float64),
            "d": pivot_search._distances(x, norm, marks)}
    asked = {k: v[::400] for k, v in rows.items()} | {"floor": np.full(10, -np.inf)}
    bound = pivot_search._bounds(asked, rows, np.ascontiguousarray(rows["d"].T))
    who, place, score = pivot_search.best_of_block(asked, rows, 20)
    full = asked["v"] @ rows["v"].T
    full[np.arange(10), np.arange(0, 4000, 400)] = -np.inf
    assert (score.reshape(10, 20) == -np.sort(-full, axis=1)[:, :20]).all()
    assert (full[who, place] == score).all()
    assert (bound >= score.reshape(10, 20)[:, -1:]).mean() < 0.5


def trained(rows, rounds=4):
    """Codes, errors and codebooks by a full search, in Python integers."""
    rows = sorted(whole(rows, 1024), key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], "<i4").tobytes()))
    w = len(rows[0][2]) // 4
    parts = [[tuple(r[2][p * w:p * w + w]) for r in rows] for p in range(4)]
    books = [p[:256] for p in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            of = defaultdict(list)
            for x in parts[p]:
                of[nearest(x, books[p])[1]].append(x)
            books[p] = [tuple(sum(c) // len(of[i]) for c in zip(*of[i])) if i in of else c for i, c in enumerate(books[p])]
    out = []
    for i, r in enumerate(rows):
        best = [nearest(parts[p][i], books[p]) for p in range(4)]
        out.append((r[0], r[1], "".join(f"{b[1]:02x}" for b in best), sum(b[0] for b in best)))
    total = Counter()
    for r in out:
        total[r[1]] += r[3]
    return Counter((r[0], r[2], r[3], total[r[1]]) for r in out), books


def test_codes_equal_full_search(spark, odd_vectors):
    extra = [vec_row(1000 + i, v, i % 3) for i, v in enumerate(vectors(250, 8, 8))]
    for rows in (odd_vectors, odd_vectors + extra, odd_vectors[:3]):
        want, books = trained(rows)
        got = equal_average.compress(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
        assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
        assert {r.codebooks_sha256 for r in got} == {equal_average.books_digest([np.array(b) for b in books])}


def test_codes_of_no_vectors_and_odd_lengths(spark):
    assert equal_average.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert equal_average.compress(spark.createDataFrame([vec_row(1, None), vec_row(2, [])], SCHEMA)).count() == 0
    # five components: two a part, the last of zeros alone
    got = equal_average.compress(spark.createDataFrame([vec_row(i, [float(i)] * 5) for i in range(3)], SCHEMA)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(i, f"{i:02x}" * 3 + "00", 0) for i in range(3)]


def test_nearest_entry_with_ties():
    r = np.random.default_rng(4)
    for k, w, span in ((256, 4, 3), (7, 1, 5), (1, 3, 2), (256, 16, 400)):
        book, x = r.integers(-span, span + 1, (k, w)), r.integers(-span, span + 1, (500, w))
        index, d = equal_average.Codebook(book).nearest(x)
        full = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (index == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()


def test_too_large_components_raise():
    import pyarrow as pa
    with pytest.raises(OverflowError):
        floors(pa.array([[1e30]], pa.list_(pa.float32())), 64)
    with pytest.raises(OverflowError):
        equal_average.Codebook(np.array([[1 << 31, 0]]))
    x = np.arange(6, dtype=np.int32).reshape(2, 3)
    assert (unpacked(packed(x).to_pylist(), "<i4", 3) == x).all()


def plain_audit(rows, labels):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    docs = []
    for r in rows:
        t, w = r[1] or "", words(r[1] or "")
        fails = {f for f, x in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)), r[0] is not None and first[t] < r[0])) if x}
        said = [x for x in labels if x[0] is not None and x[0] == r[0]]
        docs.append((r[3] or "", fails, any(x[1] == 1 for x in said), any(x[2] == 1 for x in said)))
    out = []
    for part in {d[0] for d in docs}:
        mine, every = [d for d in docs if d[0] == part], []
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [d for d in mine if f in d[1] and not d[1] & before]
                every.append((f, part, order, k + 1, sum(not d[1] & (before | {f}) for d in mine), len(gone),
                              sum(f in d[1] and bool(d[1] & before) for d in mine), sum(d[1] == {f} for d in mine),
                              sum(d[2] for d in gone), sum(d[3] for d in gone)))
        total = Counter()
        for x in every:
            total[x[0]] += x[5]
        out += [(*x[1:], total[x[0]]) for x in every]
    return sorted(out)


def test_audit_equals_plain_counts(spark, odd, odd_rows, none, labels):
    said = [tuple(r) for r in labels.collect()]
    got = filter_audit.audit(odd, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(odd_rows, said)
    assert filter_audit.audit(none, labels).count() == 0
    assert sorted(map(tuple, filter_audit.audit(odd, labels.limit(0)).collect())) == plain_audit(odd_rows, [])


def test_transducer_counts():
    r = random.Random(7)
    alphabet = "aB \t\n\x0b\x0c\r#$é漢\U0001F600\xa0\x85\x1c_Z|"
    texts = ["", " ", "\n\n", "x", "é", "A" * 5000, ("w" * 300 + " ") * 3 + "w" * 299 + "v " + "w" * 300]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(300)]
    n = filter_audit.text_counts([t.encode() for t in texts])
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert tuple(int(n[c][i]) for c in filter_audit.COUNTS) == (
            len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))), t


def test_hits_are_verified_by_bytes():
    """With one hash for all words only their bytes tell them apart."""
    text = b"a b a cc longer-than-eight longer-than-eighT longer-than-eight b "
    data = np.frombuffer(text, np.uint8)
    _, _, _, start, stop = filter_audit.transduce(data, np.array([len(text)]))
    same = np.full(len(start), 12345, np.uint64)
    got = filter_audit.WordTable(data).distinct(start, stop, np.zeros(len(start), np.int64), 1, same)
    assert got.tolist() == [len(set(text.split()))]
