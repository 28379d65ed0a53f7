"""Changes of a query's answer, views kept by signed counts, and windows that
account for every row."""
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postwave.functions.parse import source_table
from postwave.plans.sql import custom_sql
from postwave.session import shared_path
from postwave.streaming import changelog as C
from postwave.streaming import late as L
from postwave.streaming.replay import drain

SOURCE = "seq bigint, value string"


def put(spark, base, records):
    rows = [(s, r if isinstance(r, str) else json.dumps(r)) for s, r in records]
    spark.createDataFrame(rows, SOURCE).coalesce(1).write.mode("append").json(f"{base}/in")


def stream(spark, base):
    return spark.readStream.schema(SOURCE).option("maxFilesPerTrigger", "1").json(f"{base}/in")


def answer(spark, base, query):
    return custom_sql(spark, query, source_table(stream(spark, base), with_proc_time=False))


def test_output_modes_and_groups(spark):
    base = shared_path(spark, "t-modes")
    put(spark, base, [(1, {"id": "1"})])
    of = lambda q: answer(spark, base, q)
    assert C.changes_mode(of("SELECT id FROM mastodon_posts WHERE language = 'en'")) == "append"
    grouped = of("SELECT count(*) AS n, language AS l FROM mastodon_posts GROUP BY language")
    assert (C.changes_mode(grouped), C.group_columns(grouped)) == ("update", ["l"])
    having = of("SELECT language, account.username AS u, count(*) AS n FROM mastodon_posts GROUP BY 1, 2 HAVING count(*) > 1")
    assert (C.changes_mode(having), C.group_columns(having)) == ("complete", ["language", "u"])
    total = of("SELECT count(*) AS n FROM mastodon_posts")
    assert (C.changes_mode(total), C.group_columns(total)) == ("update", [])
    distinct = of("SELECT DISTINCT language, id FROM mastodon_posts")
    assert (C.changes_mode(distinct), C.group_columns(distinct)) == ("update", ["language", "id"])
    with pytest.raises(ValueError, match="key columns"):
        C.group_columns(of("SELECT count(*) AS n FROM mastodon_posts GROUP BY language"))


@pytest.mark.parametrize("most", [C.MOST_KEYS, 1])
def test_changed_keys_are_looked_up(spark, monkeypatch, most):
    """With few changed groups only files that can hold them are read."""
    monkeypatch.setattr(C, "MOST_KEYS", most)
    read, base = [], shared_path(spark, "t-lookups")
    for name in ("lookup", "read_table"):
        def told(*args, _name=name, _fn=getattr(C, name)):
            read.append(_name)
            return _fn(*args)
        monkeypatch.setattr(C, name, told)
    query = "SELECT language, count(*) AS n FROM mastodon_posts GROUP BY language"
    for b in range(4):
        put(spark, base, [(b * 9 + i, {"id": str(i), "language": f"l{(b + i) % 5}"}) for i in range(3)])
        drain(C.changelog_job(answer(spark, base, query), f"{base}/out", f"{base}/ckpt", compact_every=2))
    assert set(read) == ({"lookup"} if most > 1 else {"read_table"}) and len(read) == 4
    now = C.folded(C.read_changes(spark, f"{base}/out").drop("batch"))
    want = {}
    for b in range(4):
        for i in range(3):
            want[f"l{(b + i) % 5}"] = want.get(f"l{(b + i) % 5}", 0) + 1
    assert {r.language: r.n for r in now.collect()} == want


def test_kinds_of_change_with_restarts(spark):
    base = shared_path(spark, "t-kinds")
    query = "SELECT language, count(*) AS n FROM mastodon_posts GROUP BY language HAVING count(*) < 3"
    post = lambda i, language: (i, {"id": str(i), "language": language})
    batches = [[post(1, "en"), post(2, "fr")], [post(3, "en"), post(4, None)], [post(5, "en")], [post(6, "de"), post(7, "fr")]]
    for b in batches:
        put(spark, base, b)
        drain(C.changelog_job(answer(spark, base, query), f"{base}/out", f"{base}/ckpt", compact_every=2))
    got = sorted((r.batch, r.language or "", r.kind, r.n) for r in C.read_changes(spark, f"{base}/out").collect())
    assert got == [(0, "en", "+I", 1), (0, "fr", "+I", 1), (1, "", "+I", 1), (1, "en", "+U", 2), (1, "en", "-U", 1),
                   (2, "en", "-D", 2), (3, "de", "+I", 1), (3, "fr", "+U", 2), (3, "fr", "-U", 1)]
    now = C.folded(C.read_changes(spark, f"{base}/out").drop("batch"))
    assert sorted((r.language or "", r.n) for r in now.collect()) == [("", 1), ("de", 1), ("fr", 2)]


def test_rows_without_aggregation_are_new(spark):
    base = shared_path(spark, "t-append")
    put(spark, base, [(1, {"id": "a", "language": "en"}), (2, {"id": "b"})])
    query = "SELECT id FROM mastodon_posts WHERE language = 'en'"
    drain(C.changelog_job(answer(spark, base, query), f"{base}/out", f"{base}/ckpt"))
    put(spark, base, [(3, {"id": "b", "language": "fr"})])
    drain(C.changelog_job(answer(spark, base, query), f"{base}/out", f"{base}/ckpt"))
    assert [tuple(r) for r in C.read_changes(spark, f"{base}/out").collect()] == [(0, "+I", "a")]


def test_broken_off_batch_tells_its_changes_once(spark, monkeypatch):
    base = shared_path(spark, "t-once")
    query = "SELECT language, count(*) AS n FROM mastodon_posts GROUP BY language"
    put(spark, base, [(1, {"id": "1", "language": "en"})])
    write, calls = C.write_part, []

    def crash(spark, root, name, *rest):
        calls.append(name)
        if name == "last" and calls.count("last") == 1:
            raise RuntimeError("lost")
        return write(spark, root, name, *rest)

    monkeypatch.setattr(C, "write_part", crash)
    job = lambda: drain(C.changelog_job(answer(spark, base, query), f"{base}/out", f"{base}/ckpt"))
    with pytest.raises(StreamingQueryException):
        job()
    job()
    assert [tuple(r) for r in C.read_changes(spark, f"{base}/out").collect()] == [(0, "+I", "en", 1)]


def test_views_when_posts_are_replaced(spark):
    base = shared_path(spark, "t-views")
    post = lambda i, score, language="en", tags=("x",), hour="10": {
        "id": i, "favourites_count": score, "reblogs_count": 0, "language": language, "tags": list(tags),
        "created_at": f"2031-01-01T{hour}:30:00+00:00"}
    batches = [
        [(1, post("a", 50)), (2, post("b", 7, "fr", ("x", "y"))), (3, "{bad"), (4, post(None, 1, None, ()))],
        [(6, post("a", 3, "fr", ("y",), "11")), (7, post("b", None, "fr"))],     # the maximum is replaced
        [(5, post("a", 99)), (8, post("c", 4)), (9, post("c", 5, "de"))],        # 5 comes late: 6 is newer
        [(10, post(None, 1, None, ())), (11, post("c", 5, "de"))]]
    want = [
        ({"en": 1, "fr": 1, None: 1}, {"x": 2, "y": 1}, (3, 3, 50, 58), 1),
        ({"fr": 2, None: 1}, {"x": 1, "y": 1}, (3, 2, 3, 4), 2),
        ({"fr": 2, None: 1, "de": 1}, {"x": 2, "y": 1}, (4, 3, 5, 9), 2),
        ({"fr": 2, None: 2, "de": 1}, {"x": 2, "y": 1}, (5, 4, 5, 10), 2)]
    for rows, (languages, tags, total, hours) in zip(batches, want):
        put(spark, base, rows)
        drain(C.views_job(stream(spark, base), f"{base}/out", f"{base}/ckpt", compact_every=2))
        v = C.read_views(spark, f"{base}/out")
        assert {r.language: r.post_count for r in v["language_share"].collect()} == languages
        assert sum(r.share for r in v["language_share"].collect()) == pytest.approx(1)
        assert {r.tag: r.tag_count for r in v["top_hashtags"].collect()} == tags
        assert v["volume_over_time"].count() == hours
        (e,) = v["engagement"].collect()
        assert (e.posts, e.scored_posts, e.max_engagement, e.total_engagement) == total
        assert e.avg_engagement == pytest.approx(total[3] / total[1])


def post_at(i, time, language="en"):
    return (i, {"id": str(i), "language": language, "created_at": time, "favourites_count": 1, "reblogs_count": 0})


def test_every_row_is_counted_or_late(spark, monkeypatch):
    base = shared_path(spark, "t-account")
    at = lambda h, m: f"2031-01-01T{h:02d}:{m:02d}:00+00:00"
    batches = [
        [post_at(1, at(10, 1)), post_at(2, at(10, 20)), (3, {"id": "3"}), (4, "{bad")],
        [post_at(5, at(10, 2)), post_at(6, at(10, 21)), post_at(7, "noon")],   # 5: its window ended at 10:05
        [post_at(8, at(10, 16)), post_at(9, at(12, 0))],                       # 8: its window is open until 10:22
        [post_at(10, at(11, 50)), post_at(11, at(11, 56)), post_at(12, at(12, 1), "fr")]]
    for i, rows in enumerate(batches):
        put(spark, base, rows)
        job = lambda: drain(L.accounted_windows_job(stream(spark, base), "language", f"{base}/out",
                                                    f"{base}/ckpt", window_minutes=5, delay_seconds=120))
        if i == 2:
            write = L.write_part

            def crash(spark, root, name, *rest):
                if name == "windows":
                    raise RuntimeError("lost")
                return write(spark, root, name, *rest)

            monkeypatch.setattr(L, "write_part", crash)
            with pytest.raises(StreamingQueryException):
                job()
            monkeypatch.setattr(L, "write_part", write)
        job()
    before = {str(r.window_start)[11:16]: r.post_count for r in L.read_windows(spark, f"{base}/out").collect()}
    assert before == {"10:00": 1, "10:15": 1, "10:20": 2}
    L.finish(spark, f"{base}/out", "language", 5)
    windows = {(str(r.window_start)[11:16], r.language): r.post_count for r in L.read_windows(spark, f"{base}/out").collect()}
    assert windows == {("10:00", "en"): 1, ("10:15", "en"): 1, ("10:20", "en"): 2, ("11:55", "en"): 1,
                       ("12:00", "en"): 1, ("12:00", "fr"): 1}
    late = {r.id: (r.reason, r.window_end and str(r.window_end)[11:16]) for r in L.read_late(spark, f"{base}/out").collect()}
    assert late == {"3": (L.NO_TIME, None), "7": (L.NO_TIME, None), "5": (L.BEHIND, "10:05"), "10": (L.BEHIND, "11:55")}
    assert sum(windows.values()) + len(late) == 11
    L.finish(spark, f"{base}/out", "language", 5)
    assert sum(r.post_count for r in L.read_windows(spark, f"{base}/out").collect()) + len(late) == 11


def test_closing_opens_only_files_that_reach_into_it(spark):
    base = shared_path(spark, "t-prune")
    for day in range(1, 5):
        put(spark, base, [post_at(day * 10 + k, f"2031-01-0{day}T10:0{k}:00+00:00") for k in range(3)])
    drain(L.accounted_windows_job(stream(spark, base), "count", f"{base}/out", f"{base}/ckpt"))
    from postwave.streaming.manifest import ManifestLog
    files = ManifestLog(spark, f"{base}/out").state()["tables"]["open"]["files"]
    # only the last day's file still waits
    assert len(files) == 1 and L.read_windows(spark, f"{base}/out").count() == 9 + 2


def test_row_sides_of_a_change(spark):
    new = spark.createDataFrame([("a", (1,)), ("b", (2,)), ("c", (3,))], "key string, row struct<v:int>")
    old = spark.createDataFrame([("b", (9,)), ("c", (3,)), ("d", (4,))], "key string, row struct<v:int>")
    told = lambda complete: sorted((r.key, r.kind, r.row.v) for r in C.signed(new, old, complete).collect())
    assert told(False) == [("a", "+I", 1), ("b", "+U", 2), ("b", "-U", 9)]
    assert told(True) == [*told(False), ("d", "-D", 4)]
    changes = spark.createDataFrame([("+I", 1), ("+I", 1), ("-U", 1), ("+U", 2), ("-D", 2)], "kind string, v int")
    assert [r.v for r in C.folded(changes).collect()] == [1]
    assert C.folded(changes.select("kind", F.col("v").alias("a.b"))).columns == ["a.b"]
