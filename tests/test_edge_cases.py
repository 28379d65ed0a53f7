"""Edge-case records: missing vs null, malformed input, typed counters."""
import pytest

from postwave.functions.parse import parse_posts, project_raw_status, quarantine, source_table
from postwave.operators import windows as W
from postwave.operators.transforms import engagement_score, extract_hashtags, extract_hashtags_raw

EDGE = [
    ("a", '{"id":"a"}'),
    ("b", '{"id":"b","language":null}'),
    ("c", '{"id":"c","language":"unknown"}'),
    ("d", '{"id":"d","account":null}'),
    ("e", '{"id":"e","account":{}}'),
    ("f", '{"id":"f","favourites_count":null,"reblogs_count":3}'),
    ("g", '{"id":"g","favourites_count":"10"}'),
    ("h", '{"id":"h","tags":null}'),
    ("i", '{"id":"i","tags":[]}'),
    ("7", '{"id":7}'),
    ("arr", "[1,2]"),
    ("num", "7"),
    ("junk", "junk"),
    ("empty", ""),
    ("nullv", None),
    ("j", '{"id":"j"} trailing'),
    ("k", '{"id":"k","language":"en","language":"fr"}'),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(EDGE, "tag string, value string")


@pytest.fixture(scope="module")
def parsed(raw):
    rows = engagement_score(parse_posts(raw, keep=["tag"])).collect()
    return {r.tag: r for r in rows}


def test_dropped_records(parsed):
    assert set(parsed) == {"a", "b", "c", "e", "f", "g", "h", "i", "7", "k"}


def test_missing_defaults(parsed):
    a = parsed["a"]
    assert (a.content, a.language, a.username, a.followers_count, a.favourites_count,
            a.reblogs_count, a.tags, a.created_at) == ("", "unknown", "", 0, 0, 0, [], "")
    assert a.engagement_score == 0


def test_null_is_not_missing(parsed):
    assert parsed["b"].language is None
    assert parsed["c"].language == "unknown"
    assert parsed["e"].username == "" and parsed["e"].followers_count == 0
    assert parsed["f"].favourites_count is None and parsed["f"].engagement_score is None
    assert parsed["g"].favourites_count is None and parsed["g"].engagement_score is None
    assert parsed["h"].tags is None and parsed["i"].tags == []


def test_numeric_id_and_duplicate_keys(parsed):
    assert parsed["7"].id == "7"
    assert parsed["k"].language == "fr"


def test_hashtag_records(raw):
    recs = {r.post_id: r for r in extract_hashtags_raw(raw).collect()}
    assert "h" not in recs
    assert recs["i"].hashtag_count == 0
    assert recs["d"].hashtag_count == 0          # account is not looked at here
    assert recs["b"].language is None and recs["a"].language == "unknown"
    parsed = parse_posts(raw)
    assert "h" not in {r.post_id for r in extract_hashtags(parsed).collect()}


def test_source_table_semantics(raw):
    t = {r.id: r for r in source_table(raw, with_proc_time=False).collect()}
    assert set(t) == {"a", "b", "c", "d", "e", "f", "g", "h", "i", "7", "k"}
    assert t["d"].account is None and t["e"].account.username is None
    assert t["g"].favourites_count is None


def test_null_and_unknown_language_stay_two_groups(raw):
    t = source_table(raw, with_proc_time=False)
    from pyspark.sql import functions as F
    t = t.withColumn("ts", F.lit("2026-01-27 10:00:00").cast("timestamp"))
    rows = W.language_distribution(t, "ts", 5).filter("language = 'unknown'").collect()
    assert sorted(r.post_count for r in rows) == [1, 9]


def test_quarantine(raw):
    q = {r.tag: r.reason for r in quarantine(raw).collect()}
    assert q == {"arr": "not_an_object", "num": "not_an_object", "junk": "not_an_object",
                 "empty": "not_an_object", "nullv": "null", "j": "not_an_object"}


def test_raw_status_required_keys(spark):
    base = ('{"id":"%s","created_at":"2026-01-27T10:00:00+00:00","content":"x",'
            '"account":{"username":"u","display_name":"U","followers_count":1}%s}')
    rows = [("ok", base % ("1", ',"tags":[{"name":"a"}]')),
            ("notags", base % ("2", "")),
            ("nulltags", base % ("3", ',"tags":null')),
            ("noname", base % ("4", ',"tags":[{"x":1}]')),
            ("nouser", '{"id":"5","created_at":"t","content":"x","account":{"display_name":"U","followers_count":1}}')]
    df = spark.createDataFrame(rows, "tag string, value string")
    out = {r.tag: r for r in project_raw_status(df, keep=["tag"]).collect()}
    assert set(out) == {"ok", "notags"}
    assert out["ok"].tags == ["a"] and out["notags"].tags == []
    assert out["ok"].favourites_count == 0 and out["ok"].language is None


# A record must be exactly one JSON value: Python's json.loads rejects extra
# data after it, so these records are dropped by every decoder.
EXTRA_DATA = [
    ("two_objects", '{"id":"x1"}{"id":"x2"}'),
    ("two_lines", '{"id":"x3"}\n{"id":"x4"}'),
    ("comma", '{"id":"x5"},{"id":"x6"}'),
    ("brace_garbage", '{"id":"x7"} junk}'),
    ("bracket_garbage", '{"id":"x8"}]z}'),
    ("nan", '{"id":"x9","favourites_count":NaN}'),
    ("blanks_ok", '  {"id":"ok1","tags":["a"]}  \n'),
    ("brackets_in_text_ok", '{"id":"ok2","content":"a ]} [{ b","tags":[]}'),
]


def test_extra_data_after_the_object_drops_the_record(spark):
    df = spark.createDataFrame(EXTRA_DATA, "tag string, value string")
    kept = {r.tag for r in parse_posts(df, keep=["tag"]).collect()}
    assert kept == {"blanks_ok", "brackets_in_text_ok"}
    assert {r.tag for r in source_table(df, keep=["tag"]).collect()} == kept
    assert {r.tag for r in extract_hashtags_raw(df, keep=["tag"]).collect()} == kept
    q = {r.tag: r.reason for r in quarantine(df).collect()}
    assert set(q) == {t for t, _ in EXTRA_DATA} - kept
    assert q["two_objects"] == "malformed_json" and q["brace_garbage"] == "malformed_json"


FORGED = [
    ("f1", '{"id":"f1"},0]'),                    # closes the wrapper itself
    ("f2", '{"id":"f2"},0] {"x":1}'),
    ("f3", '{"id":"f3"} , -0 ]'),
    ("f4", '{"id":"f4"},"0"]'),                  # a string is not the sentinel
    ("f5", '{"id":"f5"},0.0]'),
    ("f6", '{"id":"f6"},{},0]}'),
    ("ok0", '{"id":"ok0","content":"x,0]y","tags":["a"]}'),
    ("ok1", '{"id":"ok1","n":[1,0],"m":[0 ]}'),
]


def test_forged_wrapper_close_is_not_one_object(spark):
    raw = spark.createDataFrame(FORGED, "tag string, value string")
    kept = {r.tag for r in parse_posts(raw, keep=["tag"]).collect()}
    assert kept == {"ok0", "ok1"}
    assert {r.tag for r in source_table(raw, keep=["tag"]).collect()} == {"ok0", "ok1"}
    bad = {r.tag: r.reason for r in quarantine(raw).collect()}
    assert set(bad) == {"f1", "f2", "f3", "f4", "f5", "f6"}
    assert bad["f1"] == "not_an_object" and bad["f6"] == "malformed_json"
