"""DuckDB SQL counterparts of the registered queries (the correctness oracle).

``POSTS_CTE`` is the same posts adapter as ``sources.posts.posts`` written in
DuckDB's dialect over the pre-registered ``events`` and ``documents`` views.
Window starts use ``epoch_us // W * W`` (Spark aligns tumbling windows to the
epoch; DuckDB's ``time_bucket`` does not).
"""

from __future__ import annotations

POSTS_CTE = """posts AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id,
         e.event_id AS seq,
         e.ts AS created_at,
         d.text AS content,
         CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE 'user' || CAST(e.user_id AS VARCHAR) END AS username,
         'User ' || CAST(e.user_id AS VARCHAR) AS display_name,
         CAST((e.user_id * 37 + e.event_id) % 5000 AS BIGINT) AS followers_count,
         CASE WHEN e.event_id % 17 = 0 THEN NULL
              WHEN e.event_id % 29 = 0 THEN 'unknown' ELSE d.lang END AS language,
         CASE WHEN e.event_id % 31 = 0 THEN NULL ELSE CAST(floor(e.value) AS BIGINT) END AS favourites_count,
         TRY_CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS reblogs_count,
         CAST(e.event_id % 7 AS BIGINT) AS replies_count,
         'https://social.example/@user' || CAST(e.user_id AS VARCHAR) || '/' || CAST(e.event_id AS VARCHAR) AS url,
         CASE WHEN e.event_id % 5 = 0 THEN CAST([] AS VARCHAR[])
              ELSE [e.event_type, 'k' || regexp_extract(e.props, '([0-9]+)', 1)] END AS tags,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS created_iso
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
)"""

# Parsed (stream-operator) view of the raw JSON posts: broken records gone,
# the dropped "language" key read back as 'unknown'.
PARSED_CTE = """parsed AS (
  SELECT id, seq, content,
         CASE WHEN seq % 19 = 0 THEN 'unknown' ELSE language END AS language,
         username, followers_count, favourites_count, reblogs_count, replies_count,
         tags, created_iso AS created_at
  FROM posts WHERE seq % 97 <> 0
)"""

# Post log: posts tagged 'click' are re-emitted once with 5 more favourites.
LOG_CTE = """post_log AS (
  SELECT * FROM posts
  UNION ALL
  SELECT * REPLACE (favourites_count + 5 AS favourites_count, seq + 10000000 AS seq)
  FROM posts WHERE list_contains(tags, 'click')
)"""


def with_posts(body: str, *extra: str) -> str:
    ctes = ",\n".join([POSTS_CTE, *extra])
    return f"WITH {ctes}\n{body}"


def wstart(col: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({col}) // {us}) * {us})"


def wend(col: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({col}) // {us}) * {us} + {us})"
