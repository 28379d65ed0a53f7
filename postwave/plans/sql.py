"""Guarded analyst SQL over the post table (custom query entry point).

The analyst's text is wrapped as a subquery, ``SELECT * FROM (<text>) q``,
and handed to Spark's own parser: anything that is not a single query
(DDL, DML, several statements) fails to parse and is rejected. Batch
tables get Spark's full SQL surface; over a streaming table the same text
becomes a streaming query (plain ``ORDER BY`` is refused by Spark there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the name of the post table in analysts' queries.
POSTS_VIEW = "mastodon_posts"


class CustomQueryError(ValueError):
    pass


def custom_sql(spark: SparkSession, query: str, posts: DataFrame | None = None,
               view: str = POSTS_VIEW) -> DataFrame:
    """Run one SELECT over ``view`` (registered from ``posts`` if given)."""
    if posts is not None:
        posts.createOrReplaceTempView(view)
    text = query.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise CustomQueryError("empty query")
    try:
        return spark.sql(f"SELECT * FROM (\n{text}\n) q")
    except Exception as e:  # parse / analysis errors surface as one type
        raise CustomQueryError(str(e).splitlines()[0]) from e


def default_output_mode(df: DataFrame) -> str:
    """Output mode for a streaming custom query: ``update`` if a node of its
    plan aggregates (``GROUP BY``, ``DISTINCT``), else ``append``."""
    def aggregates(node) -> bool:
        if node.nodeName() in ("Aggregate", "Distinct", "Deduplicate"):
            return True
        below = node.children()
        return any(aggregates(below.apply(i)) for i in range(below.size()))
    return "update" if aggregates(df._jdf.queryExecution().analyzed()) else "append"
