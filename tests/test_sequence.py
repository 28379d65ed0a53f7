"""Chunked per-group sequence operators against Spark's plain windows, with
one (user, day) group holding a third of all posts."""
import pytest
from pyspark.sql import functions as F

from postwave.operators import sequence as S
from postwave.sources.posts import posts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def hot_posts(spark):
    p = posts(spark, SF).select(
        "id", "favourites_count",
        F.col("account.username").alias("username0"), F.col("created_at").alias("ts0"))
    hot = F.xxhash64("id") % 3 == 0
    # a third of the posts move to one user and one day, keeping their time of day
    return p.select(
        "id", "favourites_count",
        F.when(hot, F.lit("hot_user")).otherwise(F.col("username0")).alias("username"),
        F.when(hot, F.timestamp_add("SECOND", F.unix_seconds(F.col("ts0").cast("timestamp")) % 86400,
                                    F.lit("2026-01-27").cast("timestamp_ntz")))
         .otherwise(F.col("ts0")).alias("created_at"),
    ).withColumn("day", F.date_trunc("DAY", "created_at"))


def _plain_lag(p):
    p.createOrReplaceTempView("hot_posts")
    return p.sparkSession.sql("""
SELECT id, lag(created_at) OVER (PARTITION BY username, day ORDER BY created_at, id) AS previous_post,
       CAST(sum(favourites_count) OVER (PARTITION BY username, day ORDER BY created_at, id
                                       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT)
         AS favourites_count_3
FROM hot_posts""")


def _plain_sessions(p):
    p.createOrReplaceTempView("hot_posts")
    return p.sparkSession.sql("""
SELECT username, day, session_window.start AS session_start, session_window.end AS session_end,
       count(*) AS post_count
FROM hot_posts WHERE username IS NOT NULL
GROUP BY username, day, session_window(created_at, '30 minutes')""")


@pytest.mark.parametrize("chunk_rows", [500, 7, 1])
def test_lag_frame_matches_window_with_hot_group(spark, hot_posts, chunk_rows):
    got = S.lag_frame(hot_posts, ["username", "day"], "created_at", "id", "favourites_count",
                      chunk_rows=chunk_rows).select("id", "previous_post", "favourites_count_3")
    want = _plain_lag(hot_posts)
    assert got.count() == want.count() == hot_posts.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("chunk_rows", [500, 3])
def test_sessions_match_session_window_with_hot_group(spark, hot_posts, chunk_rows):
    p = hot_posts.filter("username IS NOT NULL")
    got = S.sessions(p, ["username", "day"], "created_at", "id", 30, chunk_rows=chunk_rows)
    want = _plain_sessions(hot_posts).select(*got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_group_is_cut_into_many_chunks(spark, hot_posts):
    n_hot = hot_posts.filter("username = 'hot_user'").count()
    assert n_hot > hot_posts.count() / 4
    x, cut = S.chunk_groups(hot_posts, ["username", "day"], ["created_at", "id"], chunk_rows=500)
    assert cut
    sizes = [r["n"] for r in x.filter("username = 'hot_user'").groupBy("_c")
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    # the hot group spreads over about n/500 window tasks, none far above 500 rows
    assert len(sizes) >= n_hot // 500 and max(sizes) < 2 * 500
    # a cold group stays whole in chunk 0
    assert x.filter("username <> 'hot_user' AND _c > 0").count() == 0


def test_no_hot_group_is_a_plain_window(spark, hot_posts):
    out = S.lag_frame(hot_posts, ["username", "day"], "created_at", "id", "favourites_count",
                      chunk_rows=10**9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    base = hot_posts._jdf.queryExecution().executedPlan().toString()
    # no chunk or seam join beyond the posts adapter's own
    assert plan.count("Join") == base.count("Join") and "PythonUDF" not in plan


@pytest.fixture(scope="module")
def tied_posts(hot_posts):
    # the hot group's posts all share one timestamp (a burst, or copies)
    return hot_posts.withColumn(
        "created_at", F.when(F.col("username") == "hot_user",
                             F.lit("2026-01-27 12:00:00").cast("timestamp_ntz"))
                       .otherwise(F.col("created_at")))


def test_tied_timestamps_are_still_cut(spark, tied_posts):
    n_hot = tied_posts.filter("username = 'hot_user'").count()
    x, cut = S.chunk_groups(tied_posts, ["username", "day"], ["created_at", "id"], chunk_rows=500)
    sizes = [r["n"] for r in x.filter("username = 'hot_user'").groupBy("_c")
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert cut and len(sizes) >= n_hot // 1000 and max(sizes) < 3 * 500


@pytest.mark.parametrize("chunk_rows", [500, 2])
def test_lag_and_sessions_with_tied_timestamps(spark, tied_posts, chunk_rows):
    got = S.lag_frame(tied_posts, ["username", "day"], "created_at", "id", "favourites_count",
                      chunk_rows=chunk_rows).select("id", "previous_post", "favourites_count_3")
    want = _plain_lag(tied_posts)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    p = tied_posts.filter("username IS NOT NULL")
    got = S.sessions(p, ["username", "day"], "created_at", "id", 30, chunk_rows=chunk_rows)
    want = _plain_sessions(tied_posts).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_exact_copies_are_cut(spark):
    rows = spark.range(0, 6000).select(
        F.lit("u").alias("username"), F.lit("d").alias("day"), F.lit("p1").alias("id"),
        F.lit("2026-01-27 12:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit(3).cast("bigint").alias("favourites_count"))
    x, cut = S.chunk_groups(rows, ["username", "day"], ["created_at", "id"], chunk_rows=500)
    sizes = [r["n"] for r in x.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert cut and len(sizes) >= 6 and max(sizes) < 3 * 500
    out = S.lag_frame(rows, ["username", "day"], "created_at", "id", "favourites_count",
                      chunk_rows=500)
    vals = out.groupBy("favourites_count_3").count().collect()
    assert {r["favourites_count_3"]: r["count"] for r in vals} == {3: 1, 6: 1, 9: 5998}
