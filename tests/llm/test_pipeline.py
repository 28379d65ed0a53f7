"""The pipeline's stages on a small table, each against brute force on its own
input."""
from collections import Counter

import corpus_pipeline
from postwave.llm import mixing, packing, rule_ensemble
from postwave.llm.tables import written
from tests.llm.conftest import SF
from tests.llm.test_duplicates import want_join, want_lines
from tests.llm.test_text_models import check_windows, plain_ids


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(written(stage(spark, outs[-1], SF), f"test-{name}"))
    assert all(o.columns == columns for o in outs[:-1])
    rows = [[(r.doc_id, r.text) for r in o.select("doc_id", "text").collect()] for o in outs[:-1]]
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in rule_ensemble.classify(docs, marks).collect() if r.predicted}
    assert {i for i, _ in rows[1]} == good
    lines = want_lines(rows[1])
    assert Counter(rows[2]) == Counter(
        (i, lines[False, i, t][0]) for i, t in rows[1] if not lines[False, i, t][2] or lines[False, i, t][0].split())
    assert {i for i, _ in rows[3]} == {c for _, _, c in want_join(rows[2])}
    times = {r.doc_id: r.times for r in mixing.mix(outs[3]).collect()}
    assert Counter(rows[4]) == Counter({x: times[x[0]] for x in rows[3] if times[x[0]]})
    last = outs[-1].collect()
    assert check_windows(last) <= 1
    want = Counter()
    for (i, _), ids in zip(rows[4], plain_ids(t for _, t in rows[4])):
        want[i] += len(ids) + 1
    got = Counter()
    for r in last:
        got[r.doc_id] += r.length
    assert got == want


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert got.where(f"length > {packing.WINDOW}").count() == 0 and got.count() > 0
