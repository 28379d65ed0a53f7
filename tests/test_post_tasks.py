"""Tasks that make a bounded number of posts as the tables grow."""
import pytest
from pyspark.sql import functions as F

from postwave.operators.joins import LIMIT_CONF
from postwave.session import shared_path
from postwave.sources import posts as S


@pytest.fixture(scope="module")
def tables(spark):
    """4,000 events in one file of one row group, and 40 documents."""
    d = shared_path(spark, "t-tables")
    (spark.range(0, 4000, 1, 1).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(3.5).alias("value"), F.lit('{"k": 7}').alias("props")).write.parquet(f"{d}/events.parquet"))
    (spark.range(0, 40, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 50).alias("text"), F.lit("en").alias("lang"))
     .write.parquet(f"{d}/documents.parquet"))
    return d


def rows_of_tasks(df):
    """Rows of every task of the last step; an action first, so that the plan is final."""
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


@pytest.mark.parametrize("columns,limit", [(S.EVENT_COLUMNS, None), (S.COLUMNS, None), (S.COLUMNS, "0")])
def test_a_task_makes_a_bounded_number_of_posts(spark, tables, monkeypatch, columns, limit):
    monkeypatch.setattr(S, "EVENTS_PER_TASK", 50)
    if limit is not None:
        spark.conf.set(LIMIT_CONF, limit)
    try:
        p = S.posts(spark, tables, columns)
        sizes = rows_of_tasks(p.select("id"))
        assert sum(sizes) == 4000 and len(sizes) >= 80
        # by key: about EVENTS_PER_TASK each; by document, as many as its posts
        assert max(sizes) <= (150 if limit is None else 400)
        if "content" in columns:
            assert p.where("content is null").count() == 0
    finally:
        if limit is not None:
            spark.conf.unset(LIMIT_CONF)


def test_small_inputs_use_the_cores_there_are(spark, tables):
    assert S._tasks(spark, spark.range(10)) == spark.sparkContext.defaultParallelism
