"""Structured Streaming behaviour: heartbeat windows, live counters, keyed log."""
import time

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from postwave.session import shared_path
from postwave.sources.kafka import read_replay
from postwave.streaming import keyed
from postwave.streaming.heartbeat import heartbeat
from postwave.streaming.jobs import observe_ingest, window_stream, write_stream
from postwave.streaming.replay import drain


def _write_lines(spark, path, lines):
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1) \
        .write.mode("append").text(path)


def test_heartbeat_closes_processing_time_windows(spark):
    base = shared_path(spark, "t-heartbeat")
    _write_lines(spark, f"{base}/in", ['{"id":"%d"}' % i for i in range(5)])
    out = window_stream(read_replay(spark, f"{base}/in"), "count", time="processing",
                        heartbeat=heartbeat(spark, "proc_time", rows_per_second=5))
    q = write_stream(out, "memory", f"{base}/ckpt", query_name="hb_counts",
                     trigger={"processingTime": "1 second"})
    try:
        total, deadline = 0, time.time() + 60
        while time.time() < deadline:
            total = spark.sql("SELECT coalesce(sum(post_count), 0) AS n FROM hb_counts").first().n
            if total >= 5:
                break
            time.sleep(1)
    finally:
        q.stop()
    assert total == 5      # window emitted although no post arrived after it; heartbeats not counted


def test_observed_ingest_counters(spark):
    base = shared_path(spark, "t-observe")
    _write_lines(spark, f"{base}/in", ['{"id":"1"}', '{"id":"2"}', '{"id":"3"}', "{bad", "[1]"])
    obs = observe_ingest(read_replay(spark, f"{base}/in"))
    q = write_stream(obs, "memory", f"{base}/ckpt", query_name="obs_rows")
    q.processAllAvailable()
    m = q.lastProgress["observedMetrics"]["ingest"]
    q.stop()
    assert (m["records"], m["errors"]) == (5, 2)


def test_keyed_log_latest_wins_and_compaction(spark):
    base = shared_path(spark, "t-keyed")
    st = StructType([StructField("id", StringType()), StructField("v", LongType())])
    rows = [(1, '{"id":"a","v":1}', "t"), (2, '{"id":"b","v":2}', "t"),
            (3, '{"id":"a","v":3}', "t"), (4, '{"id":null,"v":4}', "t")]
    spark.createDataFrame(rows, "seq long, value string, topic string").write.json(f"{base}/in")
    stream = spark.readStream.schema("seq long, value string, topic string").json(f"{base}/in")
    drain(keyed.upsert_job(stream, f"{base}/tables", f"{base}/ckpt", {"t": (st, "tbl")}))
    root = f"{base}/tables/tbl"
    view = sorted((r.id or "", r.v) for r in keyed.read_table(spark, root, "id", ["seq"], st).collect())
    assert view == [("", 4), ("a", 3), ("b", 2)]
    v = keyed.compact(spark, root, "id", ["seq"], st)
    assert v is not None
    again = sorted((r.id or "", r.v) for r in keyed.read_table(spark, root, "id", ["seq"], st).collect())
    assert again == view
    # a retried compaction neither re-reads nor overwrites its own snapshot
    assert keyed.compact(spark, root, "id", ["seq"], st) == v


def test_keyed_log_compacts_every_n_batches(spark):
    base = shared_path(spark, "t-keyed-auto")
    st = StructType([StructField("post_id", StringType()), StructField("v", LongType())])
    src = f"{base}/in"
    batches = [[(1, '{"post_id":"a","v":1}', "t"), (2, '{"post_id":"b","v":2}', "t")],
               [(3, '{"post_id":"a","v":3}', "t")],
               [(4, '{"post_id":"b","v":4}', "t"), (5, '{"post_id":"c","v":5}', "t")]]
    for rows in batches:
        spark.createDataFrame(rows, "seq long, value string, topic string").coalesce(1) \
            .write.mode("append").json(src)
    stream = spark.readStream.schema("seq long, value string, topic string") \
        .option("maxFilesPerTrigger", "1").json(src)
    drain(keyed.upsert_job(stream, f"{base}/tables", f"{base}/ckpt",
                           {"t": (st, "tags", "post_id")}, compact_every=2))
    root = f"{base}/tables/tags"
    assert keyed._versions(spark, root) == [0]   # after batches 0 and 1
    view = sorted((r.post_id, r.v) for r in
                  keyed.read_table(spark, root, "post_id", ["seq"], st).collect())
    assert view == [("a", 3), ("b", 4), ("c", 5)]


def test_heartbeat_top_users(spark):
    base = shared_path(spark, "t-heartbeat-users")
    recs = ['{"id":"%d","account":{"username":"%s","followers_count":%d}}' % (i, u, f)
            for i, (u, f) in enumerate([("ann", 10), ("ann", 21), ("bob", 5)])]
    _write_lines(spark, f"{base}/in", recs)
    out = window_stream(read_replay(spark, f"{base}/in"), "users", time="processing",
                        window_minutes=1,
                        heartbeat=heartbeat(spark, "proc_time", rows_per_second=5))
    q = write_stream(out, "memory", f"{base}/ckpt", query_name="hb_users",
                     trigger={"processingTime": "1 second"})
    try:
        rows, deadline = [], time.time() + 120
        while time.time() < deadline:
            rows = spark.sql("SELECT * FROM hb_users").collect()
            if rows:
                break
            time.sleep(2)
    finally:
        q.stop()
    assert [(r.username, r.post_count, r.avg_followers) for r in rows] == [("ann", 2, 15)]


def test_late_rows_behind_watermark_are_dropped(spark):
    base = shared_path(spark, "t-late")
    rec = '{"id":"%s","language":"en","favourites_count":1,"reblogs_count":0,"created_at":"%s"}'
    src = f"{base}/in"
    _write_lines(spark, src, [rec % ("1", "2026-01-27T10:01:00+00:00"),
                              rec % ("2", "2026-01-27T10:20:00+00:00")])
    out = window_stream(read_replay(spark, src), "language", time="event", window_minutes=5,
                        delay="0 seconds")
    q = write_stream(out, "memory", f"{base}/ckpt", query_name="late_rows")
    try:
        q.processAllAvailable()
        _write_lines(spark, src, [rec % ("3", "2026-01-27T10:21:00+00:00")])
        q.processAllAvailable()
        _write_lines(spark, src, [rec % ("4", "2026-01-27T10:02:00+00:00"),   # late
                                  rec % ("5", "2026-01-27T11:00:00+00:00")])
        q.processAllAvailable()
        _write_lines(spark, src, [rec % ("6", "2026-01-27T12:00:00+00:00")])
        q.processAllAvailable()
    finally:
        q.stop()
    got = {str(r.window_start): r.post_count for r in spark.sql("SELECT * FROM late_rows").collect()}
    assert got["2026-01-27 10:00:00"] == 1          # the 10:02 row arrived behind the watermark
    assert got["2026-01-27 10:20:00"] == 2


def test_streaming_custom_sql_uses_update_mode(spark):
    from postwave.functions.parse import register_source_table
    from postwave.plans.sql import custom_sql, default_output_mode
    base = shared_path(spark, "t-custom-stream")
    _write_lines(spark, f"{base}/in", ['{"id":"1","language":"en"}', '{"id":"2","language":"en"}',
                                       '{"id":"3","language":"fr"}'])
    register_source_table(read_replay(spark, f"{base}/in"))
    df = custom_sql(spark, "SELECT language, count(*) AS n FROM mastodon_posts GROUP BY language")
    assert df.isStreaming and default_output_mode(df) == "update"
    q = write_stream(df, "memory", f"{base}/ckpt", output_mode="update", query_name="custom_stream")
    q.processAllAvailable()
    q.stop()
    got = {r.language: r.n for r in spark.sql("SELECT * FROM custom_stream").collect()}
    assert got == {"en": 2, "fr": 1}


def test_dispatcher_cli_available_now(spark):
    import json as _json
    from postwave.plans.dispatcher import main
    base = shared_path(spark, "t-cli")
    _write_lines(spark, f"{base}/in", [_json.dumps({"id": "1", "favourites_count": 3,
                                                    "reblogs_count": 2})])
    main(["--mode", "stream", "--analysis", "engagement", "--source", "files",
          "--input", f"{base}/in", "--sink", "json", "--output", f"{base}/out",
          "--checkpoint", f"{base}/ckpt", "--available-now"], spark=spark)
    (r,) = spark.read.json(f"{base}/out").collect()
    assert r.id == "1" and r.engagement_score == 7


def test_read_or_empty_on_missing_archive(spark):
    from postwave.schemas import POST_SCHEMA
    from postwave.sinks.writers import path_exists, read_or_empty
    missing = shared_path(spark, "t-missing")
    assert not path_exists(spark, missing)
    df = read_or_empty(spark, missing, POST_SCHEMA)
    assert df.count() == 0 and df.schema == POST_SCHEMA


def test_post_without_user_still_closes_top_user_windows(spark):
    """The NULL-user test must not be pushed below the watermark: a later
    post with no account moves event time on and closes the earlier window."""
    base = shared_path(spark, "t-users-null")
    rec = '{"id":"%s","account":{"username":"ann","followers_count":%d},"created_at":"%s"}'
    src = f"{base}/in"
    _write_lines(spark, src, [rec % ("1", 10, "2026-01-27T10:01:00+00:00"),
                              rec % ("2", 21, "2026-01-27T10:03:00+00:00")])
    out = window_stream(read_replay(spark, src), "users", time="event", window_minutes=10,
                        delay="0 seconds")
    q = write_stream(out, "memory", f"{base}/ckpt", query_name="users_null_close")
    try:
        q.processAllAvailable()
        _write_lines(spark, src, ['{"id":"3","created_at":"2026-01-27T11:00:00+00:00"}'])
        q.processAllAvailable()
        _write_lines(spark, src, ['{"id":"4","created_at":"2026-01-27T11:01:00+00:00"}'])
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.sql("SELECT * FROM users_null_close").collect()
    assert [(r.username, r.post_count, r.avg_followers) for r in rows] == [("ann", 2, 15)]


def test_analyzer_objects_run_the_original_jobs(spark):
    """The analyzer objects (original method names) over a file source."""
    from postwave.streaming.analyzers import SQLAnalyzer, StreamAnalyzer
    base = shared_path(spark, "t-analyzers")
    rec = ('{"id":"%s","language":"%s","favourites_count":%d,"reblogs_count":1,'
           '"tags":["a"],"created_at":"%s"}')
    _write_lines(spark, f"{base}/in", [rec % ("1", "en", 3, "2026-01-27T10:01:00+00:00"),
                                       rec % ("2", "fr", 5, "2026-01-27T10:02:00+00:00"),
                                       rec % ("3", "en", 7, "2026-01-27T10:03:00+00:00"),
                                       rec % ("4", "en", 0, "2026-01-27T11:00:00+00:00")])
    common = dict(source="files", input_path=f"{base}/in", sink="parquet",
                  output_root=f"{base}/out", trigger={"availableNow": True})
    sql = SQLAnalyzer(spark, time="event", **common)
    q = sql.analyze_language_distribution(window_minutes=5)
    q.awaitTermination()
    q = sql.simple_count_analysis()
    q.awaitTermination()
    stream = StreamAnalyzer(spark, **common)
    q = stream.run_full_pipeline()
    q.awaitTermination()
    langs = {(str(r.window_start), r.language): (r.post_count, r.total_engagement)
             for r in spark.read.parquet(f"{base}/out/language_stats").collect()}
    assert langs == {("2026-01-27 10:00:00", "en"): (2, 14), ("2026-01-27 10:00:00", "fr"): (1, 7)}
    counts = {r.window_end: r.post_count for r in spark.read.parquet(f"{base}/out/mastodon-counts").collect()}
    assert counts == {"10:01:10": 1, "10:02:10": 1, "10:03:10": 1}
    eng = {r.id: r.engagement_score for r in spark.read.parquet(f"{base}/out/mastodon-engagement").collect()}
    assert eng == {"1": 5, "2": 7, "3": 9, "4": 2}
    tags = spark.read.parquet(f"{base}/out/mastodon-hashtags").count()
    assert tags == 4


def test_dispatcher_consumer_modes(spark):
    """--mode archive (raw posts -> JSON lines) and --mode index (result
    topics -> keyed tables, latest version wins)."""
    import json as _json
    from postwave.plans.dispatcher import main
    from postwave.schemas import ENGAGEMENT_RECORD_SCHEMA, HASHTAG_RECORD_SCHEMA
    base = shared_path(spark, "t-cli-consumers")
    _write_lines(spark, f"{base}/raw", ['{"id":"1","language":"en"}', "{bad", '{"id":"2"}'])
    main(["--mode", "archive", "--source", "files", "--input", f"{base}/raw",
          "--output", f"{base}/archive", "--checkpoint", f"{base}/ckpt-a", "--available-now"],
         spark=spark)
    assert sorted(r.id for r in spark.read.json(f"{base}/archive").collect()) == ["1", "2"]

    eng = lambda i, s: _json.dumps({"id": i, "engagement_score": s})
    recs = [("mastodon-engagement", eng("1", 5), 1), ("mastodon-engagement", eng("1", 9), 2),
            ("mastodon-hashtags", _json.dumps({"post_id": "1", "hashtag_count": 2}), 3)]
    spark.createDataFrame(recs, "topic string, value string, seq long").write.json(f"{base}/topics")
    main(["--mode", "index", "--source", "files", "--input", f"{base}/topics",
          "--output", f"{base}/index", "--checkpoint", f"{base}/ckpt-i", "--available-now",
          "--compact-every", "1"], spark=spark)
    e = keyed.read_table(spark, f"{base}/index/engagement", "id", ["seq"], ENGAGEMENT_RECORD_SCHEMA)
    assert [(r.id, r.engagement_score) for r in e.collect()] == [("1", 9)]
    h = keyed.read_table(spark, f"{base}/index/hashtags", "post_id", ["seq"], HASHTAG_RECORD_SCHEMA)
    assert [(r.post_id, r.hashtag_count) for r in h.collect()] == [("1", 2)]
    assert keyed._versions(spark, f"{base}/index/engagement") == [0]
    spec = {"engagement": ("id", ["seq"], ENGAGEMENT_RECORD_SCHEMA),
            "hashtags": ("post_id", ["seq"], HASHTAG_RECORD_SCHEMA),
            "not_created": ("id", ["seq"], ENGAGEMENT_RECORD_SCHEMA)}
    stats = {r.index_name: r.doc_count
             for r in keyed.index_stats_at(spark, f"{base}/index", spec).collect()}
    assert stats == {"engagement": 1, "hashtags": 1, "not_created": 0}
    nothing = keyed.index_stats_at(spark, f"{base}/nowhere", {"engagement": spec["engagement"]})
    assert [(r.index_name, r.doc_count) for r in nothing.collect()] == [("engagement", 0)]
