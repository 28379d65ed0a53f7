"""Plan properties that matter at scale, checked on the executed plans."""
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

QUERIES = E.queries()
# queries that run a streaming job or write files when called
SIDE_EFFECT = {k for k in QUERIES if k.startswith("stream_")} | {"jsonl_roundtrip"}
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT))
def test_no_python_udf_or_cartesian(spark, name):
    plan = _plan(spark, name)
    for f in FORBIDDEN:
        assert f not in plan, f"{name}: {f}"


def test_window_query_prunes_document_text(spark):
    plan = _plan(spark, "language_distribution")
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    assert "partial_count" in plan and "partial_sum" in plan


def test_trending_top_k_limited_before_shuffle(spark):
    plan = _plan(spark, "trending_hashtags")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert_combines_partially(spark):
    assert "partial_max_by" in _plan(spark, "upsert_engagement")


def test_time_filter_reaches_scan(spark):
    from postwave.plans.sql import custom_sql
    from postwave.sources.posts import posts
    df = custom_sql(spark, """SELECT id, language FROM mastodon_posts
                              WHERE created_at >= TIMESTAMP_NTZ'2024-01-02 00:00:00'""",
                    posts(spark, SF_SMALL))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan        # pushed into the parquet scan
    assert "text" not in plan.split("documents.parquet")[1].split("\n")[0]  # body not read


def test_document_side_broadcast_only_on_measured_size(spark):
    from postwave.operators import joins
    from postwave.sources.posts import posts
    from postwave.sources.tables import table_path
    docs = spark.read.parquet(table_path(SF_SMALL, "documents")).select("doc_id", "text", "lang")
    measured = joins.decoded_bytes(docs)
    # a bound on what gets broadcast: every text byte plus fixed words per row
    texts = docs.selectExpr("sum(octet_length(text)) + sum(octet_length(lang))").first()[0]
    assert measured >= texts > 0

    def plan():
        df = posts(spark, SF_SMALL).select("id", "content")
        df.write.format("noop").mode("overwrite").save()
        return df._jdf.queryExecution().executedPlan().toString()

    old = spark.conf.get(joins.LIMIT_CONF, None)
    try:
        spark.conf.set(joins.LIMIT_CONF, str(measured))      # fits exactly
        assert "BroadcastHashJoin" in plan()
        spark.conf.set(joins.LIMIT_CONF, str(measured - 1))  # one byte short
        p = plan()
        assert "SortMergeJoin" in p and "BroadcastExchange" not in p
        spark.conf.set(joins.LIMIT_CONF, "1")                # smaller than the files
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.unset(joins.LIMIT_CONF) if old is None else spark.conf.set(joins.LIMIT_CONF, old)


def _final(plan):
    return plan.split("== Initial Plan ==")[0]


def test_semi_anti_sample_meets_one_row_per_user(spark):
    import re
    plan = _final(_plan(spark, "custom_sql_semi_anti"))
    # one semi join on the user and no anti join: NOT EXISTS is a per-user flag
    assert len(re.findall(r"Join \[[^\n]*LeftSemi", plan)) == 1
    assert "LeftAnti" not in plan
    # the user side is combined on the map side before it shuffles
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[\s:|+\-]*(\*\(\d+\)\s*)?"
                     r"HashAggregate\([^\n]*partial_max", plan)


def test_set_operation_sample_dedupes_each_branch_before_shuffling(spark):
    import re
    plan = _final(_plan(spark, "custom_sql_union_intersect_except"))
    pre = re.findall(r"Exchange hashpartitioning\(username[^\n]*\n[\s:|+\-]*(\*\(\d+\)\s*)?"
                     r"HashAggregate\(keys=\[username", plan)
    assert len(pre) >= 4            # every branch, before its first shuffle
