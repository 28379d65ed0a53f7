"""A record is one JSON object to its end, told without patterns over the text."""
from postwave.functions.parse import MARK, MARK_2, parse_posts, quarantine

MARKED = [
    ("m1", '{"id":"m1"},%s]' % MARK),
    ("m2", '{"id":"m2"} , %s ] junk' % MARK),
    ("m3", '{"id":"m3"},%s]' % MARK_2),
    ("m4", '{"id":"m4"},"%s"]' % MARK),
    ("m5", '{"id":"m5"},%s.0]' % MARK),
    ("m6", '{"id":"m6"},7.352619840112233E15]'),
    ("m7", '{"id":"m7"},%s,%s]' % (MARK, MARK_2)),
    ("ok0", '{"id":"ok0","content":"x,%s]y"}' % MARK),
    ("ok1", ' \n{"id":"ok1","n":[1,%s],"m":%s} ' % (MARK, MARK_2)),
    ("ok2", '{}'),
    ("bad0", "{"), ("bad1", "}"), ("bad2", "{}{}"), ("bad3", ""), ("bad4", "\t{bad}"),
]


def test_a_text_with_the_closing_mark_is_read_to_its_end(spark):
    raw = spark.createDataFrame(MARKED, "tag string, value string")
    kept = {r.tag for r in parse_posts(raw, keep=["tag"]).collect()}
    assert kept == {"ok0", "ok1", "ok2"}
    bad = {r.tag: r.reason for r in quarantine(raw).collect()}
    assert set(bad) == {t for t, _ in MARKED} - kept
    assert bad["bad0"] == bad["bad1"] == bad["m1"] == "not_an_object"
    assert bad["bad2"] == bad["bad4"] == "malformed_json"


def test_valid_records_meet_no_pattern_over_the_whole_text(spark):
    """A text is looked at by patterns only where its first character leaves it open."""
    raw = spark.createDataFrame([("{}",)], "value string")
    plan = parse_posts(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "StartsWith" in plan and "Contains" in plan
