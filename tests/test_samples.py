"""The three sample posts and hand-derived goldens."""
import json

import pytest
from pyspark.sql import functions as F

from postwave.functions.parse import parse_posts, source_table
from postwave.operators import aggregates as A
from postwave.operators import transforms as T
from postwave.operators import windows as W
from postwave.plans.pipelines import engagement_pipeline, full_pipeline

SAMPLES = [
    {"id": "901", "created_at": "2031-05-04T08:12:30Z",
     "content": "Rye bread, slowly fermented, keeps for a week.",
     "account": {"username": "mira_bakes", "display_name": "Mira", "followers_count": 212},
     "language": "de", "favourites_count": 7, "reblogs_count": 4, "replies_count": 1,
     "url": "https://posts.example/901", "tags": ["baking", "rye", "slowfood"]},
    {"id": "902", "created_at": "2031-05-04T08:13:05Z",
     "content": "The night train to Lisbon came two hours late and was still worth every minute of it",
     "account": {"username": "kestrel", "display_name": "K.", "followers_count": 3450},
     "language": "en", "favourites_count": 31, "reblogs_count": 12, "replies_count": 9,
     "url": "https://posts.example/902", "tags": ["trains"]},
    {"id": "903", "created_at": "2031-05-04T08:21:47Z", "content": "Le phare est rouvert",
     "account": {"username": "mira_bakes", "display_name": "Mira", "followers_count": 213},
     "language": "fr", "favourites_count": 0, "reblogs_count": 3, "replies_count": 0,
     "url": "https://posts.example/903", "tags": ["rye", "bretagne"]},
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(json.dumps(p),) for p in SAMPLES], "value string")


@pytest.fixture(scope="module")
def table(raw):
    return source_table(raw, with_proc_time=False)


def _by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_scores_as_emitted_and_documented(raw):
    assert _by_id(engagement_pipeline(raw), "engagement_score") == {"901": 15, "902": 55, "903": 6}
    doc = T.engagement_score(parse_posts(raw), include_replies=True)
    assert _by_id(doc, "engagement_score") == {"901": 16, "902": 64, "903": 6}


def test_language_filter(raw):
    p = parse_posts(raw)
    assert sorted(r.id for r in T.language_filter(p).collect()) == ["902", "903"]
    assert [r.id for r in T.language_filter(p, ["de"]).collect()] == ["901"]
    assert T.language_filter(p, []).count() == 2


def test_hashtags(raw):
    eng, tags = full_pipeline(raw)
    assert {r.post_id: r.hashtag_count for r in tags.collect()} == {"901": 3, "902": 1, "903": 2}
    freq = {r[0]: r.tag_count for r in A.hashtag_frequency(parse_posts(raw)).collect()}
    assert freq == {"rye": 2, "baking": 1, "slowfood": 1, "trains": 1, "bretagne": 1}


def test_language_distribution(table):
    rows = W.language_distribution(table, "event_time", 5).collect()
    got = {(str(r.window_start), r.language): (r.post_count, r.total_engagement) for r in rows}
    assert got == {("2031-05-04 08:10:00", "de"): (1, 15), ("2031-05-04 08:10:00", "en"): (1, 55),
                   ("2031-05-04 08:20:00", "fr"): (1, 6)}


def test_top_users(table):
    assert W.top_users(table, "event_time", 10).count() == 0
    (r,) = W.top_users(table, "event_time", 30).collect()
    assert (r.username, r.post_count, r.avg_followers) == ("mira_bakes", 2, 212)


def test_engagement_metrics(table):
    got = {str(r.window_start)[11:16]: (r.total_posts, r.avg_favourites, r.avg_reblogs, r.max_engagement)
           for r in W.engagement_metrics(table, "event_time", 5).collect()}
    assert got == {"08:10": (2, 19.0, 8.0, 55), "08:20": (1, 0.0, 3.0, 6)}


def test_dashboard_and_simple_count(table):
    d = W.dashboard_volume(table, "event_time").collect()
    assert len(d) == 3 and all(r.metric_value == 1.0 and r.metric_type == "volume" for r in d)
    c = {r.window_end: r.post_count for r in W.simple_count(table, "event_time").collect()}
    assert c == {"08:12:40": 1, "08:13:10": 1, "08:21:50": 1}


def test_content_preview(table):
    got = {r.id: r.p for r in table.select("id", T.content_preview().alias("p")).collect()}
    assert got["901"] == "Rye bread, slowly fermented, keeps for a week."
    assert got["902"] == "The night train to Lisbon came two hours late and ..."
