"""Replays and archives: compressed files of a bounded number of records."""
import glob

from pyspark.sql import functions as F

from postwave.schemas import POST_SCHEMA
from postwave.session import shared_path
from postwave.sinks.writers import read_jsonl, write_jsonl
from postwave.sources.kafka import read_replay
from postwave.streaming.jobs import archive_job
from postwave.streaming.replay import drain, write_replay


def files(path, suffix):
    found = glob.glob(f"{path.removeprefix('file:')}/part-*")
    assert found and all(f.endswith(suffix) for f in found)
    return found


def test_replay_and_archive_files_are_compressed_and_bounded(spark, monkeypatch):
    from postwave.sinks import writers
    monkeypatch.setitem(writers.RECORD_FILES, "maxRecordsPerFile", "100")
    base = shared_path(spark, "t-files")
    texts = spark.range(0, 1000, 1, 2).select(F.to_json(F.struct(
        F.col("id").cast("string").alias("id"), F.repeat(F.lit("words and more "), 40).alias("content"))).alias("value"))
    write_replay(texts, f"{base}/in")
    assert len(files(f"{base}/in", ".txt.gz")) == 10
    drain(archive_job(read_replay(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt"))
    assert len(files(f"{base}/out", ".txt.gz")) >= 10
    want = sorted(r.value for r in texts.collect())
    for path in (f"{base}/in", f"{base}/out"):
        assert sorted(r.value for r in spark.read.text(path).collect()) == want
    assert read_jsonl(spark, f"{base}/out", POST_SCHEMA).select("id").distinct().count() == 1000


def test_json_lines_are_compressed_and_go_on_beside_plain_ones(spark):
    path = shared_path(spark, "t-jsonl")
    spark.createDataFrame([('{"id":"0","language":null}',)], "value string").write.text(path)
    df = spark.createDataFrame([(str(i), None) for i in range(1, 5)], "id string, language string")
    write_jsonl(df, path, append=True)
    assert glob.glob(f"{path.removeprefix('file:')}/*.json.gz")
    assert [r.id for r in read_jsonl(spark, path, POST_SCHEMA).orderBy("id").collect()] == list("01234")
    assert {r.value for r in spark.read.text(path).where("value like '%1%'").collect()} == {'{"id":"1","language":null}'}
