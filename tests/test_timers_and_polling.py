"""Windows that close by timers, polls, duplicates at the source, trending tags
and decoders that tell why they refuse a record."""
import json
import time

import pytest
from pyspark.sql import functions as F

from postwave.functions import parse as P
from postwave.operators import transforms as T
from postwave.plans.dispatcher import main, run_analysis
from postwave.session import shared_path
from postwave.sources.incremental import incremental_since
from postwave.sources.kafka import read_replay
from postwave.streaming import keyed, polling
from postwave.streaming.heartbeat import heartbeat
from postwave.streaming.jobs import decode_job, window_stream, write_stream
from postwave.streaming.replay import drain
from postwave.streaming.timers import timed_windows


def lines(spark, path, texts):
    spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string") \
        .coalesce(1).write.mode("append").text(path)


def until(spark, table, done, seconds=90):
    rows, end = [], time.time() + seconds
    while time.time() < end:
        rows = spark.sql(f"SELECT * FROM {table}").collect()
        if done(rows):
            break
        time.sleep(1)
    return rows


POSTS = [{"id": str(i), "language": ["en", "fr", None][i % 3], "favourites_count": i, "reblogs_count": None if i == 4 else 1,
          "account": {"username": ["ann", "bob"][i % 2], "followers_count": 10 * i}} for i in range(6)]


def test_timers_close_windows_on_a_silent_source(spark):
    """Ten-second windows after the last post, as the heartbeat job gives them."""
    base = shared_path(spark, "t-timers")
    lines(spark, f"{base}/in", POSTS)
    raw = lambda: read_replay(spark, f"{base}/in")
    beat = window_stream(raw(), "count", time="processing", heartbeat=heartbeat(spark, "proc_time", rows_per_second=5))
    trigger = {"processingTime": "1 second"}
    queries = [write_stream(timed_windows(raw(), "count"), "memory", f"{base}/c1", query_name="timed", trigger=trigger),
               write_stream(beat, "memory", f"{base}/c2", query_name="beaten", trigger=trigger)]
    try:
        total = lambda rows: sum(r.post_count for r in rows)
        timed = until(spark, "timed", lambda rows: total(rows) >= 6)
        beaten = until(spark, "beaten", lambda rows: total(rows) >= 6)
        assert total(timed) == total(beaten) == 6
        # more posts open new windows; nothing of the closed ones is told again
        lines(spark, f"{base}/in", POSTS[:2])
        assert total(until(spark, "timed", lambda rows: total(rows) >= 8)) == 8
    finally:
        for q in queries:
            q.stop()


def test_timed_sums_equal_the_batch_functions(spark):
    """The sums of one window, for every analysis, against the batch functions."""
    from postwave.operators import windows as W
    from postwave.streaming import timers
    rows = spark.createDataFrame([(json.dumps(p),) for p in POSTS], "value string")
    at = F.timestamp_seconds(F.lit(1_700_000_030))
    posts = P.source_table(rows, with_proc_time=False).withColumn("proc_time", at)
    for analysis, fn in (("language", lambda p: W.language_distribution(p, "proc_time", 5)),
                         ("users", lambda p: W.top_users(p, "proc_time", 10)),
                         ("engagement", lambda p: W.engagement_metrics(p, "proc_time", 5)),
                         ("dashboard", lambda p: W.dashboard_volume(p, "proc_time")),
                         ("count", lambda p: W.simple_count(p, "proc_time"))):
        minutes, _ = timers.SIZES[analysis]
        seconds = int(round(minutes * 60))
        table = posts.select(F.unix_millis(F.window("proc_time", f"{seconds} seconds").end).alias("window_end_ms"),
                             timers._group(analysis).alias("name"), F.col("favourites_count").alias("favourites"),
                             F.col("reblogs_count").alias("reblogs"), F.col("account.followers_count").alias("followers"),
                             W.sql_engagement().alias("score")).toPandas()
        got = []
        for key, part in table.groupby(["window_end_ms", "name"], dropna=False):
            sums = _Sums(key)
            for half in (part.iloc[:1], part.iloc[1:]):
                if len(half):
                    list(sums.processor.handleInputRows(sums.key, iter([half]), None))
            got += list(sums.processor.handleExpiredTimer(sums.key, None, None))
            assert sums.timers == [key[0]] and not sums.exists()
        import pandas as pd
        summed = spark.createDataFrame(pd.concat(got).astype(object).where(lambda d: d.notna(), None).values.tolist(), timers.RESULT)
        want = fn(posts)
        assert sorted(map(str, timers._columns(summed, analysis, seconds).select(want.columns).collect())) == sorted(
            map(str, want.collect())), analysis


class _Sums:
    """A state value and timers outside of Spark."""

    def __init__(self, key):
        from postwave.streaming.timers import WindowSums
        self.key, self.timers, self.value = (key[0], None if key[1] != key[1] else key[1]), [], None
        self.processor = WindowSums()
        self.processor.init(self)

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def test_overlapping_polls_give_each_post_once(spark):
    base = shared_path(spark, "t-polls")
    schema = "value string, polled_at timestamp"

    def poll(values, hour):
        spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v), f"2031-01-01 {hour:02d}:00:00") for v in values],
                              "value string, t string").select("value", F.col("t").cast("timestamp").alias("polled_at")) \
            .write.mode("append").json(f"{base}/in")
        stream = spark.readStream.schema(schema).json(f"{base}/in")
        # a job of its own for each poll: the state outlives it
        drain(write_stream(polling.each_post_once(stream, 3 * 3600), "parquet", f"{base}/ckpt", path=f"{base}/out"))

    poll([{"id": "1"}, {"id": "2"}, {"id": "2", "edited": 1}, {"x": 1}, "{bad"], 10)
    poll([{"id": "2"}, {"id": "3"}, {"id": 3}, {"x": 1}], 11)
    poll([{"id": "3", "edited": 2}, {"id": "4"}], 12)
    got = spark.read.schema(schema).parquet(f"{base}/out").collect()
    ids = sorted(json.loads(r.value).get("id", "-") if r.value != "{bad" else "bad" for r in got)
    assert [str(i) for i in ids] == ["-", "-", "1", "2", "3", "4", "bad"]
    # forgotten once the watermark has passed its time
    for hour in (20, 21):
        poll([{"id": str(hour)}], hour)
    poll([{"id": "1"}], 22)
    again = [json.loads(r.value) for r in spark.read.schema(schema).parquet(f"{base}/out").where("value != '{bad'").collect()]
    assert [r.get("id") for r in again].count("1") == 2
    table = spark.createDataFrame([('{"id":"1"}', 1), ('{"id":"1"}', 2), ("x", 3)], "value string, n int")
    assert polling.each_post_once(table).count() == 2


def test_polls_go_on_where_they_stopped(spark, monkeypatch):
    base = shared_path(spark, "t-pages")
    table = lambda n: spark.createDataFrame(
        [(str(i), ["news"] if i % 2 else ["x"]) for i in range(n)], "id string, tags array<string>")
    assert polling.poll(spark, table(10), base, first_limit=3, limit=2) == 3
    write, calls = polling.write_part, []

    def crash(*args):
        calls.append(write(*args))
        raise RuntimeError("lost")

    monkeypatch.setattr(polling, "write_part", crash)
    with pytest.raises(RuntimeError):
        polling.poll(spark, table(16), base, first_limit=3, limit=2)
    monkeypatch.setattr(polling, "write_part", write)
    assert polling.poll(spark, table(16), base, first_limit=3, limit=2) == 2
    assert polling.poll(spark, table(16), base, first_limit=3, limit=2) == 0
    pages = sorted((r.page, r.poll_rank, r.id) for r in polling.read_pages(spark, base).collect())
    assert pages == [(0, 1, "5"), (0, 2, "7"), (0, 3, "9"), (1, 1, "13"), (1, 2, "15")]
    want = incremental_since(table(16), "9", "news", 3, 2).collect()
    assert [(r.poll_rank, r.id) for r in sorted(want, key=lambda r: r.poll_rank)] == [p[1:] for p in pages[3:]]


def test_trending_tags_of_final_windows(spark):
    base = shared_path(spark, "t-trending")
    at = lambda h, m, *tags: {"id": f"{h}{m}", "created_at": f"2031-01-01T{h}:{m}:00+00:00", "tags": list(tags)}
    job = lambda: drain(polling.trending_job(read_replay(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt", k=2))
    got = lambda: sorted((str(r.window_start)[11:13], r.rank, r.tag, r.tag_count)
                         for r in polling.read_trending(spark, f"{base}/out").collect())
    lines(spark, f"{base}/in", [at(10, 10, "b", "a"), at(10, 20, "c", "a"), at(10, 30, "b", "d", "d")])
    job()
    assert got() == []
    lines(spark, f"{base}/in", [at(10, 50, "d")])
    lines(spark, f"{base}/in", [at(11, 5)])        # no tags, but time goes on
    job()
    lines(spark, f"{base}/in", [at(11, 30, "z"), at(13, 30)])
    job()
    assert got() == [("10", 1, "d", 3), ("10", 2, "a", 2), ("11", 1, "z", 1)]


BROKEN = [None, "", "[1]", "{bad}", '{"id":"1"} x', "junk", '{"id":"1","account":5}', '{"id":"2","tags":7}', '{"id":"3"}',
          '{"id":"4","account":{"username":"u"},"tags":["a"]}', '{"id":5,"tags":null,"favourites_count":"7"}', '{}']
STATUS = {"id": "9", "created_at": "t", "content": "c", "account": {"username": "u", "display_name": "d", "followers_count": 1}}


@pytest.mark.parametrize("name", ["posts", "declared", "status", "hashtags"])
def test_every_record_is_decoded_or_refused(spark, name):
    texts = BROKEN + [json.dumps(STATUS), json.dumps(STATUS | {"tags": [{"name": "a"}]}), json.dumps(STATUS | {"tags": [{}]}),
                      json.dumps(STATUS | {"account": {"username": "u"}})]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    decoder, decode = {
        "posts": (P.posts_decoder(), lambda: P.parse_posts(df, keep=["n"])),
        "declared": (P.declared_decoder(), lambda: P.source_table(df, keep=["n"], with_proc_time=False).drop("event_time")),
        "status": (P.status_decoder(), lambda: P.project_raw_status(df, keep=["n"])),
        "hashtags": (T.hashtag_decoder(), lambda: T.extract_hashtags_raw(df, keep=["n"]))}[name]
    split = P.split_records(df, decoder, keep=["n"])
    good, bad = P.accepted(split, ["n"]), P.refused(split)
    assert good.schema.names == decode().schema.names
    assert sorted(map(str, good.collect())) == sorted(map(str, decode().collect()))
    assert good.count() + bad.count() == len(texts) and bad.columns == ["n", "value", "reason"]
    why = {r.n: r.reason for r in bad.collect()}
    assert {k: v for k, v in why.items() if k < 6} == {0: "null", 1: "not_an_object", 2: "not_an_object",
                                                       3: "malformed_json", 4: "not_an_object", 5: "not_an_object"}
    more = {k: v for k, v in why.items() if k >= 6}
    if name != "status":
        assert more == {"posts": {6: "account_not_an_object"}, "declared": {},
                        "hashtags": {7: "tags_not_a_list", 10: "tags_not_a_list"}}[name]
    if name == "status":
        assert more[14] == "tags_without_names"
        assert more[15] == "missing:account.display_name,account.followers_count"
        assert more[11].startswith("missing:id,created_at")
    # one parse: as many parse expressions as the decoder itself has
    parses = lambda d: d._jdf.queryExecution().executedPlan().toString().count("parseJson(")
    assert parses(split) == parses(decode()) > 0


def test_decode_job_writes_both_sides(spark):
    base = shared_path(spark, "t-decode")
    for part in (BROKEN[:6], BROKEN[6:]):
        spark.createDataFrame([(i, t) for i, t in enumerate(part)], "seq long, value string").coalesce(1) \
            .write.mode("append").json(f"{base}/in")
        raw = spark.readStream.schema("seq long, value string").json(f"{base}/in")
        drain(decode_job(raw, P.posts_decoder(), f"{base}/out", f"{base}/ckpt"))
    good, bad = keyed.read_rows(spark, f"{base}/out", "decoded"), keyed.read_rejects(spark, f"{base}/out/decoded")
    assert good.count() + bad.count() == len(BROKEN) and {r.reason for r in bad.collect()} == {
        "null", "not_an_object", "malformed_json", "account_not_an_object"}


def test_dispatcher_names_and_jobs(spark):
    raw = spark.createDataFrame([('{"id":"1","language":"fr"}',), ('{"id":"2","language":"de"}',)], "value string")
    by = lambda name: [r.id for r in run_analysis(spark, raw, "stream", name, languages=["fr"]).collect()]
    assert by("language") == by("filter") == ["1"]
    base = shared_path(spark, "t-cli-jobs")
    at = lambda i, h, m: {"id": str(i), "language": "en", "created_at": f"2031-01-01T{h}:{m:02d}:00+00:00"}
    lines(spark, f"{base}/in", [at(1, 10, 1), at(2, 10, 30), at(3, 10, 31)])
    common = ["--mode", "sql", "--source", "files", "--input", f"{base}/in", "--available-now"]
    main([*common, "--analysis", "custom", "--query", "SELECT language, count(*) AS n FROM mastodon_posts GROUP BY language",
          "--changes", "--output", f"{base}/changes", "--checkpoint", f"{base}/c1"], spark=spark)
    from postwave.streaming.changelog import read_changes
    assert [(r.kind, r.language, r.n) for r in read_changes(spark, f"{base}/changes").collect()] == [("+I", "en", 3)]
    late = [*common, "--analysis", "language", "--account-late", "--delay", "5 minutes", "--output", f"{base}/late",
            "--checkpoint", f"{base}/c2"]
    with pytest.raises(ValueError, match="event"):
        main(late, spark=spark)
    main([*late, "--time", "event"], spark=spark)
    from postwave.streaming.late import read_windows
    assert [(str(r.window_start)[11:16], r.post_count) for r in read_windows(spark, f"{base}/late").collect()] == [("10:00", 1)]
