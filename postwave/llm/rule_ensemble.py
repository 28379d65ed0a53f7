"""Quality classifier: a sparse ensemble of rules.

Statistics of a text are plain column expressions. Small trees are grown on
the labelled rows, and every path from a root to a node becomes a conjunctive
rule over the statistics. A logistic regression with an L1 penalty over the
rules leaves few of them with a weight. Those are compiled back into one
Spark column, so scoring is a projection without a model object.

Trees and weights are fitted by Spark's own distributed learners on at most
``TRAIN_ROWS`` labelled rows (a documented bound of the fit alone: of each label
the rows with the smallest seeded hash of their id, half of the bound and what
the other label leaves of its half); every document is scored.
"""
from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm.tables import SPACES, read, remainder, word_count, written

TRAIN_ROWS = 40_000
TREES, DEPTH = 12, 3
PENALTY = 0.001
# The classes of characters that are counted.
SYMBOLS = "#*$%&|<>{}[]\\^~=_+@/"
MARKS = "!?"
STOPS = ".,;:"
DIGITS = "0123456789"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

Rule = tuple[tuple[str, str, float], ...]


def statistics(text: Column) -> list[Column]:
    """The statistics, each defined for null, empty and any other text."""
    t = F.coalesce(text, F.lit(""))
    return [t.alias("t"), word_count(t).cast("double").alias("words"),
            F.split(t, "\n").alias("lines"),
            F.split(F.btrim(F.translate(t, SPACES, " " * len(SPACES)), F.lit(" ")), " +").alias("split")]


FEATURES = ("log_words", "word_length", "symbols", "marks", "stops", "digits", "capitals",
            "dup_lines", "variety", "next_same", "short_lines")


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and FEATURES of every row of ``docs`` (doc_id, text)."""
    base = docs.select(*keep, *statistics(F.col("text")))
    n = F.greatest(F.col("words"), F.lit(1.0))
    chars = F.length(F.translate("t", SPACES, "")).cast("double")
    of = lambda cs: (F.length("t") - F.length(F.translate("t", cs, ""))).cast("double")
    lines = F.greatest(F.size("lines"), F.lit(1)).cast("double")
    filled = F.filter("lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")
    same = F.size(F.filter("split", lambda w, i: (i > 0) & (w == F.get("split", i - 1))))
    return base.select(
        *keep, F.log1p("words").alias("log_words"), (chars / n).alias("word_length"),
        (of(SYMBOLS) / n).alias("symbols"), (of(MARKS) / n).alias("marks"), (of(STOPS) / n).alias("stops"),
        (of(DIGITS) / n).alias("digits"), (of(CAPITALS) / F.greatest(chars, F.lit(1.0))).alias("capitals"),
        ((F.size(filled) - F.size(F.array_distinct(filled))) / lines).alias("dup_lines"),
        # of growing texts the distinct words grow as a power of all words
        (F.log(F.size(F.array_distinct("split")).cast("double")) / F.log(n + 1)).alias("variety"),
        (same / n).alias("next_same"),
        (F.size(F.filter("lines", lambda x: F.length(x) < 20)) / lines).alias("short_lines"))


def paths(debug: str) -> list[Rule]:
    """The conjunctions that lead to the nodes of the trees described by
    Spark's ``toDebugString``: one line per branch, nested by indentation."""
    found: dict[Rule, None] = {}
    stack: list[tuple[int, tuple[str, str, float]]] = []
    for line in debug.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dE]+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (FEATURES[int(m[2])], m[3], float(m[4]))))
        found[_tidy(tuple(c for _, c in stack))] = None
    return list(found)


def _tidy(rule: Rule) -> Rule:
    """The same rule with one bound per statistic and side, in a fixed order."""
    bounds: dict[tuple[str, str], float] = {}
    for name, side, value in rule:
        tight = min if side == "<=" else max
        bounds[name, side] = tight(bounds.get((name, side), value), value)
    return tuple(sorted((n, s, v) for (n, s), v in bounds.items()))


def holds(rule: Rule) -> Column:
    parts = [(F.col(n) <= v) if s == "<=" else (F.col(n) > v) for n, s, v in rule]
    return reduce(lambda a, b: a & b, parts)


class RuleModel:
    """``weights``: rules with their weight; ``bias``: the rest."""

    def __init__(self, weights: list[tuple[Rule, float]], bias: float):
        self.weights, self.bias = weights, bias

    def score(self) -> Column:
        """The probability of label 1, over the FEATURES columns."""
        total = F.lit(float(self.bias))
        for rule, w in self.weights:
            total = total + F.when(holds(rule), w).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.4f} if " + " and ".join(f"{n} {s} {v:g}" for n, s, v in rule)
                for rule, w in sorted(self.weights, key=lambda x: -abs(x[1]))]


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY,
        train_rows: int = TRAIN_ROWS, seed: int = 7) -> RuleModel:
    """The model for ``rows``: doc_id, FEATURES and ``label`` (0 or 1). Without
    rows every score is 0.5; with one label only it is that label's smoothed
    share."""
    rows = written(rows.select(F.xxhash64(F.lit(seed), "doc_id").alias("turn"), *FEATURES, "label"), "rules-known")
    by = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    most = {k: max(train_rows // 2, train_rows - by.get(1 - k, 0)) for k in (0, 1)}
    first = [rows.where(F.col("label") == k).orderBy("turn", *FEATURES).limit(n) for k, n in most.items()]
    rows = written(first[0].unionByName(first[1]).drop("turn"), "rules-train")
    by = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(by) < 2:
        ones, zeros = by.get(1, 0) + 1.0, by.get(0, 0) + 1.0
        return RuleModel([], math.log(ones / zeros))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="v",
                                    featureSubsetStrategy="onethird", maxBins=64)
    rules = paths(forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="v")
                             .transform(rows)).toDebugString)
    cols = [f"r{i}" for i in range(len(rules))]
    marked = rows.select("label", *(holds(r).cast("double").alias(c) for r, c in zip(rules, cols)))
    weight = F.when(F.col("label") == 1, sum(by.values()) / (2 * by[1])).otherwise(sum(by.values()) / (2 * by[0]))
    marked = written(VectorAssembler(inputCols=cols, outputCol="v")
                     .transform(marked.withColumn("w", weight)).select("label", "w", "v"), "rules-marked")
    lasso = LogisticRegression(featuresCol="v", weightCol="w", elasticNetParam=1.0, regParam=penalty,
                               maxIter=60, standardization=False)
    found = lasso.fit(marked)
    return RuleModel([(r, float(w)) for r, w in zip(rules, found.coefficients.toArray()) if w],
                     float(found.intercept))


def training_rows(docs: DataFrame, labels: DataFrame, *where: Column) -> DataFrame:
    known = labels.where("quality is not null")
    for w in where:
        known = known.where(w)
    known = known.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("label"))
    return docs.join(known, "doc_id").select("doc_id", *FEATURES, "label")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from ``labels`` (doc_id, quality) of documents whose crc32(doc_id)
    modulo 3 is not 1; those of remainder 1 are held out. Several labels of a
    document count as the lowest. Null and empty texts have the statistics of
    a text without words and are scored like any other. Rows with the same id
    are scored one by one. Empty documents: no rows. Empty labels: score 0.5.
    Columns besides doc_id and text are not read.
    """
    rest = remainder(F.col("doc_id"), 3)
    stats = written(with_statistics(docs, "doc_id"), "rules-stats")
    model = fit(training_rows(stats, labels, rest != 1))
    return stats.select("doc_id", (rest == 1).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as label 1, with all
    their columns. It learns as in ``classify`` and scores in one projection."""
    known = labels.where(remainder(F.col("doc_id"), 3) != 1)
    model = fit(training_rows(with_statistics(docs, "doc_id"), known))
    kept = [F.col(c) for c in docs.columns]
    row = docs.select(F.struct(*kept).alias("row"), "text")
    # a filter would be pushed below the statistics and work them out once per rule;
    # a generator of one or no element is not
    passed = F.explode(F.when(model.score() >= 0.5, F.array(F.lit(1))))
    return with_statistics(row, "row").select("row", passed.alias("_")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
