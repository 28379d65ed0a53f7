"""Declared sinks, delivery outcomes, and plans that read their input once."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from postwave.operators import aggregates as A
from postwave.schemas import COUNTS_SINK, DASHBOARD_SINK
from postwave.session import shared_path
from postwave.sinks.writers import SinkSchemaError, kafka_keyed_frame, publish, typed_frame
from postwave.sources.kafka import read_replay
from postwave.streaming.analyzers import SQLAnalyzer
from postwave.streaming.jobs import window_stream, write_stream
from postwave.streaming.timers import timed_windows

from .conftest import SF_SMALL


def test_declared_sinks_refuse_other_columns_and_types(spark):
    df = spark.createDataFrame([("10:00:00", 3)], "window_end string, post_count long")
    assert typed_frame(df.select("post_count", "window_end"), COUNTS_SINK).columns == ["window_end", "post_count"]
    wrong = df.withColumn("post_count", F.col("post_count").cast("int")).withColumn("more", F.lit(1)).drop("window_end")
    with pytest.raises(SinkSchemaError) as e:
        typed_frame(wrong, COUNTS_SINK)
    assert "window_end: missing" in str(e.value) and "more: not declared" in str(e.value)
    assert "post_count: int, declared bigint" in str(e.value)


def test_the_windowed_jobs_fit_their_declared_sinks(spark):
    base = shared_path(spark, "t-declared")
    spark.createDataFrame([('{"id":"1"}',)], "value string").write.text(f"{base}/in")
    raw = read_replay(spark, f"{base}/in")
    for analysis, schema in (("dashboard", DASHBOARD_SINK), ("count", COUNTS_SINK)):
        assert typed_frame(window_stream(raw, analysis), schema).isStreaming
    with pytest.raises(SinkSchemaError):
        write_stream(window_stream(raw, "language"), "parquet", f"{base}/c", path=f"{base}/o", schema=COUNTS_SINK)
    jobs = {"source": "files", "input_path": f"{base}/in", "sink": "parquet", "output_root": f"{base}/out",
            "trigger": {"availableNow": True}}
    SQLAnalyzer(spark, **jobs).simple_count_analysis().awaitTermination()
    SQLAnalyzer(spark, **jobs).real_time_dashboard_query().awaitTermination()
    for analysis, schema in (("dashboard", DASHBOARD_SINK), ("count", COUNTS_SINK)):
        typed_frame(timed_windows(raw, analysis), schema)
    with pytest.raises(ValueError, match="timers"):
        SQLAnalyzer(spark, timers=True, **jobs)


def test_publishing_tells_what_came_of_it(spark):
    base = shared_path(spark, "t-publish")
    df = spark.range(7).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("v"))
    frame = kafka_keyed_frame(df, topic="t")
    told = publish(frame, "t", send=lambda f, topic: f.write.parquet(f"{base}/{topic}"))
    assert told == {"topic": "t", "outcome": "delivered", "records": 7, "error": None}
    assert spark.read.parquet(f"{base}/t").count() == 7
    # the same folder again is an error of the writer, and so is a broken record in a task
    told = publish(frame, "t", send=lambda f, topic: f.write.parquet(f"{base}/{topic}"))
    assert told["outcome"] == "failed" and told["records"] == 0 and told["error"]
    broken = frame.withColumn("value", F.when(F.col("key") == "3", F.raise_error(F.lit("no such broker"))).otherwise(F.col("value")))
    told = publish(broken, "t", send=lambda f, topic: f.write.format("noop").mode("append").save())
    assert told["outcome"] == "failed"
    assert publish(frame, "t")["outcome"] == "failed"     # no connector here


def test_index_counts_equal_the_upserted_tables(spark):
    from postwave.operators.upsert import upsert_latest
    rows = [("a", 1, True), ("a", 2, False), ("b", 3, None), (None, 4, True), (None, 5, False), (None, 4, True), ("c", 6, False)]
    log = spark.createDataFrame(rows, "id string, seq int, tagged boolean")
    got = {r.index_name: r.doc_count for r in A.index_counts(
        log, "id", ["seq"], {"all": F.lit(True), "tagged": F.col("tagged")}).collect()}
    assert got == {"all": upsert_latest(log, "id", ["seq"]).count(), "tagged": upsert_latest(log.where("tagged"), "id", ["seq"]).count()}
    none = {r.index_name: r.doc_count for r in A.index_counts(log.limit(0), "id", ["seq"], {"all": F.lit(True)}).collect()}
    assert none == {"all": 0}


@pytest.mark.parametrize("key", ["ingest_summary", "index_stats", "split_posts", "split_status"])
def test_input_is_read_once(spark, key):
    plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_id#") and plan.count("Relation [event_id") == 1
