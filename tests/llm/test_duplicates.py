import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from postwave.llm import exact_dedup, line_dedup, ngram_join
from postwave.llm.components import connected
from postwave.llm.tables import written
from tests.llm.conftest import SCHEMA, row, sentence


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def want_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    least = {t: min((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return Counter((r[0], least[norm(r[1])], len(groups[norm(r[1])]),
                    hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows), len(groups)


def check_exact(spark, rows, path, **more):
    got = exact_dedup.exact_dedup(spark, path, **more).collect()
    want, groups = want_exact(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact(spark, odd, odd_rows, tmp_path):
    odd.repartition(4).write.parquet(f"{tmp_path}/d")
    check_exact(spark, odd_rows, f"{tmp_path}/d")
    check_exact(spark, odd_rows, f"{tmp_path}/d", files_per_batch=1)


def test_bytes_decide_under_a_weak_digest(spark, odd, odd_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 2)
    odd.write.parquet(f"{tmp_path}/d")
    check_exact(spark, odd_rows, f"{tmp_path}/d", digest=lambda t: F.length(t) % 3)


def test_state_goes_on_with_new_files(spark, tmp_path):
    d, state = f"{tmp_path}/d", f"{tmp_path}/state"
    first, then = [row(5, "a b"), row(6, "c")], [row(4, "a  b"), row(7, "c"), row(8, "e")]
    spark.createDataFrame(first, SCHEMA).write.parquet(d)
    check_exact(spark, first, d, state=state)
    spark.createDataFrame(then, SCHEMA).write.mode("append").parquet(d)
    check_exact(spark, first + then, d, state=state)


def test_exact_empty_table(spark, none, tmp_path):
    none.coalesce(1).write.parquet(f"{tmp_path}/d")
    assert exact_dedup.exact_dedup(spark, f"{tmp_path}/d").count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def want_join(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                label[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets)))


def test_join(odd, odd_rows, none):
    assert Counter(tuple(r) for r in ngram_join.ngram_join(odd).collect()) == want_join(odd_rows)
    assert ngram_join.ngram_join(none).count() == 0


def test_join_of_many_near_copies(spark, monkeypatch):
    """Long lists: a group whose members link with the leader or only with
    each other, texts at the very bound, and a passage that many share."""
    monkeypatch.setattr(ngram_join, "PAIR_LIST", 3)
    rows, base, passage = [], sentence(50, 100).split(), sentence(51, 40)
    for i in range(60):
        w = list(base)
        for k in range(i % 6):
            w[(7 * i + 19 * k) % 100] = f"new{i}x{k}"
        rows.append(row(1000 + i, " ".join(w)))
    for i in range(40):
        rows.append(row(2000 + i, passage + " " + sentence(100 + i, 8 + i % 25)))
    for i in range(30):
        rows.append(row(3000 + i, " ".join(f"c{k}" for k in range(i, i + 49 + i % 3))))
    want = want_join(rows)
    assert Counter(tuple(r) for r in ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()) == want
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert kept.columns == spark.createDataFrame(rows, SCHEMA).columns


def test_join_with_a_shingle_in_a_third_of_all_sets(spark, monkeypatch):
    """A hot passage in a third of all unlike texts, and near copies among
    them; the hot shingles skip the blocks, in chunks of a few texts too."""
    passage, rows = sentence(60, 9), []
    for i in range(240):
        own = sentence(500 + i, 25)
        rows.append(row(i, f"{passage} {own}" if i % 3 == 0 else own))
        if i % 10 == 0:
            rows.append(row(5000 + i, rows[-1][1] + " end"))
    want, docs = want_join(rows), spark.createDataFrame(rows, SCHEMA).repartition(3)
    for chunk, share in ((1 << 20, 1 / 4), (4000, 1 / 8), (4000, 1e-9)):
        monkeypatch.setattr(ngram_join, "CHUNK", chunk)
        hot = ngram_join.hot_shingles(ngram_join.set_ids(docs, hot_share=share), share, 2)[0]
        assert len(hot) >= 5 and (share < 1e-6 or len(hot) <= 2 / share * 30)
        assert Counter(map(tuple, ngram_join.ngram_join(docs, hot_share=share, hot_least=2).collect())) == want


def test_sets_that_share_a_name_get_new_ones(spark, monkeypatch):
    sets = ngram_join._sets

    def clash(texts, width, salt=0):
        h, owner, n, ids = sets(texts, width, salt)
        if salt < 2:
            ids[:, 0] %= 3
        return h, owner, n, ids

    monkeypatch.setattr(ngram_join, "_sets", clash)
    rows = [row(i, sentence(700 + i // 2, 30) + (" x" if i % 2 else "")) for i in range(20)]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == want_join(rows)


def test_rows_of_each_keep_any_column(spark):
    rows = [(1, sentence(1, 60), "r", 2, "n", (1,)), (2, sentence(1, 60), "s", 3, "m", (2,)), (2, "b", None, 4, "l", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, `a.b` int, name string, row struct<x:int>")
    kept = ngram_join.one_row_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id, r._row, r["a.b"], r.name) for r in kept.collect()) == [(1, "r", 2, "n"), (2, None, 4, "l")]


def test_one_of_each_odd(odd, odd_rows):
    kept = [r.doc_id for r in ngram_join.one_of_each(odd).collect()]
    assert Counter(i for i in kept if i is not None) == Counter(
        {c for i, _, c in want_join(odd_rows) if i == c and i is not None})
    assert kept.count(None) == 2


def test_one_row_of_each(spark, odd):
    """Ids told for several texts, rows without id, and rows told again."""
    a, b, c = (sentence(70 + k, 60) for k in range(3))
    rows = [row(1, a), row(2, a + " end"), row(2, b), row(2, b), row(None, c), row(None, c + " end"), row(None, c),
            row(None, b + " end"), row(3, None), row(None, None), row(3, "own text")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = ngram_join.one_row_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    without = [t for i, t in got if i is None and t]
    assert len(without) == 1 and without[0] in (c, c + " end")
    assert got == Counter([(1, a), (2, b), (None, without[0]), (3, None), (None, None), (3, "own text")])
    assert [r.text for r in ngram_join.one_row_of_each(odd).where("doc_id = 12").orderBy("text").collect()] == [
        "a\n\nb\n\na\n", sentence(4, 60)]


def test_pipeline_keeps_a_row_of_each(spark):
    rows = [row(1, sentence(80, 60)), row(1, sentence(81, 60)), row(None, sentence(82, 60)), row(None, sentence(82, 60))]
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(set(r[:2] for r in rows))


def test_components_of_a_chain(spark):
    links = spark.range(1, 200).select((F.col("id") * 37 % 211).alias("a"), ((F.col("id") + 1) * 37 % 211).alias("b"))
    roots = connected(links.repartition(3))
    assert roots.count() == 200 and roots.select("root").distinct().count() == 1
    assert connected(links.limit(0)).count() == 0


def want_lines(rows, least=50):
    """Each stretch of lines, by brute force over all stretches of all texts."""
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    seen, out = {}, {}
    for d, (_, _, text) in enumerate(order):
        lines = [x.encode().strip() for x in text.split("\n")]
        n = [len(x.split()) for x in lines]
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if sum(n[i:j + 1]) >= least:
                    seen.setdefault(tuple(lines[i:j + 1]), (d, i))
    for d, key in enumerate(order):
        lines = key[2].split("\n")
        flat = [x.encode().strip() for x in lines]
        gone = set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if seen.get(tuple(flat[i:j + 1]), (d, i)) < (d, i):
                    gone |= set(range(i, j + 1))
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)
    return out


def check_lines(docs, rows, least):
    want = want_lines(rows, least)
    got = line_dedup.dedup_lines(docs, least)
    for r in got.collect():
        text, n, gone = want[r.doc_id is None, r.doc_id or 0, r.text_before or ""]
        assert r.n_deleted == gone, (r.doc_id, r.n_deleted, gone)
        assert r.text == (None if r.text_before is None else text)
        assert r.n_lines == (0 if r.text_before is None else n)
    assert got.count() == len(rows)
    return got


def test_lines(spark, odd, odd_rows, none):
    # ties in the order of equal ids follow a hash of the text, so ids told twice are left out here
    rows = [r for r in odd_rows if r[0] not in (12, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("text_before", F.col("text"))
    check_lines(docs, rows, 50)
    check_lines(docs, rows, 2)
    assert line_dedup.dedup_lines(none).count() == 0
    assert line_dedup.dedup_lines(odd).count() == len(odd_rows)


def test_runs_of_lines(spark):
    a, b, c = ([sentence(10 * k + i, 9) for i in range(8)] for k in (1, 2, 3))
    texts = ["\n".join(x) for x in (a + b, c + a, b[2:] + a[:5] + c[:4], ["x"] + a[3:6], c[5:] + ["", "x"] + b,
                                    ["r s t"] * 40, ["y"] + ["r s t"] * 30)]
    rows = [row(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("text_before", F.col("text"))
    check_lines(docs, rows, 20)
    check_lines(docs, rows, 50)
    left = line_dedup.left_over(docs.drop("text_before"), 20)
    assert left.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" boolean", "").replace(
        " int", "").split(", ")
    assert all(r.n_chars == len(r.text) for r in left.collect())


def test_lines_of_a_row_told_again(spark):
    """Copies of a row are one document at every level."""
    lines = [f"w{i}" for i in range(64)]
    rows = [row(1, "\n".join(lines))] * 3 + [row(2, "\n".join(["x", *lines[:55], "y"]))] * 2 + [row(3, "\n".join(lines))]
    rows += [row(4, None)] * 2
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("text_before", F.col("text"))
    check_lines(docs, rows, 50)
    assert line_dedup.repeated(written(line_dedup.lines_of(line_dedup._documents(docs), 50), "lines")).count() < 100


def test_line_dedup_keeps_any_column(spark):
    """Columns with the names of its own are carried, n_lines too by the stage."""
    run = "\n".join(sentence(k, 20) for k in range(900, 903))
    rows = [(1, run, "a", [1], "d", 7, (1,), 3), (2, f"own {sentence(904, 9)}\n{run}", "b", [2], "e", 8, (2,), 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cuts string, lines array<int>, gone string, `a.b` int, "
                                       "row struct<x:int>, n_lines int").withColumnRenamed("gone", "_doc")
    got = sorted(line_dedup.dedup_lines(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.cuts, r.lines, r["_doc"], r["a.b"], r.row.x, r.n_lines, r.n_deleted) for r in got] == [
        ("a", [1], "d", 7, 1, 3, 0), ("b", [2], "e", 8, 2, 4, 3)]
    left = line_dedup.left_over(docs)
    assert left.schema.names == docs.schema.names
    assert sorted((r.doc_id, r.n_lines, r["_doc"], r.text.count("\n")) for r in left.collect()) == [(1, 3, "d", 2), (2, 4, "e", 0)]
