"""Quality rules with risk-controlled cutoffs.

Each rule compares one statistic of a text with a cutoff; a document at or
above the cutoff is rejected. The cutoffs are chosen per stratum (language)
on a labelled holdout, so that with confidence ``1 - DELTA`` over all strata
and rules together at most ``RISK`` of the good documents of any stratum are
rejected by the rules:

- the risk is split evenly over the rules, the confidence (Bonferroni) over
  strata times rules;
- a cutoff passes when the exact binomial probability of seeing as few false
  rejections as the holdout shows, were the true rate the allowed one, is no
  more than its share of ``DELTA`` (the Clopper-Pearson bound turned round);
- false rejections only grow as the cutoff falls, so testing from the highest
  cutoff down and ending at the first failure needs no further correction;
- of the cutoffs that pass, the one with most bad minus good rejections is
  taken, the highest of those, and none if that difference is not positive.

A stratum with too few good labels gets no cutoffs, as nothing can be
guaranteed there.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postwave.llm.tables import SPACES, read, small_or_merge, words, written

RISK = 0.10
DELTA = 0.05
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Statistics in thousandths; their cutoffs are the multiples of STEP up to EVEN
# steps, and beyond that FINE steps for each doubling, without an end.
STEP, EVEN, FINE = 50, 256, 32
RULES = ("symbols", "capitals", "repeats", "dup_lines", "word_length")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every text. ``n_repeat_words`` counts the
    words inside three-word windows that the text holds twice or more: the
    windows' hashes are sorted with their places, and equal neighbours show
    the repeated ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", "lang", text.alias("text"), words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    windows = F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size("words") - 2),
        lambda i: F.xxhash64(F.get("words", i - 1), F.get("words", i), F.get("words", i + 1))))
    base = base.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", CAPITALS, ""))).cast("long").alias("n_capitals"),
        lines.alias("lines"), windows.alias("windows"))
    # without a repeated window there is nothing to sort
    placed = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    base = base.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        placed.alias("placed"))
    again = F.filter("placed", lambda x, k: (F.get("placed", k - 1)["h"] == x["h"])
                     | (F.get("placed", k + 1)["h"] == x["h"]))
    covered = F.array_distinct(F.flatten(F.transform(
        again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return base.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")).withColumn(
        "n_repeat_words", F.greatest("n_repeat_words", F.lit(0).cast("long"))).drop("placed")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def graded(v: Column) -> Column:
    """Whole steps up to EVEN; of larger ones the leading bits: EVEN is a power of
    two, and each doubling from there has FINE steps. Order is kept, so a
    cutoff of grades is a cutoff of steps, however large they are."""
    bits = F.length(F.bin(v))
    low, fine = EVEN.bit_length(), FINE.bit_length()
    leading = F.call_function("shiftright", v, (bits - fine).cast("int"))
    return F.when(v < EVEN, v).otherwise(EVEN + FINE * (bits - low) + leading - FINE).cast("int")


def rule_steps() -> dict[str, Column]:
    """Each rule's statistic in graded steps; 0 where its divisor is 0."""
    per = lambda a, b: F.when(F.col(b) > 0, F.floor(1000 * F.col(a) / (F.col(b) * STEP))).otherwise(0)
    found = {"symbols": per("n_symbols", "n_words"), "capitals": per("n_capitals", "word_chars"),
             "repeats": per("n_repeat_words", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"),
             "word_length": per("word_chars", "n_words")}
    return {k: graded(v.cast("long")) for k, v in found.items()}


def log_gamma(x: Column) -> Column:
    """log(gamma(x)) for x >= 1 by Stirling's series at x + 8."""
    y = x + 8
    series = (1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
              - 1 / (1680 * F.pow(y, F.lit(7))))
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float, terms: int = 4000) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), and 1 once k reaches n * p.

    The terms from k down are summed; beyond ``terms`` of them the rest is at
    most a geometric series, which is added whole, so that the result errs
    only upwards."""
    at = lambda i: F.exp(log_gamma(n + 1.0) - log_gamma(i + 1.0) - log_gamma(n - i + 1.0)
                         + i * math.log(p) + (n - i) * math.log1p(-p))
    low = F.greatest(k - terms + 1, F.lit(0).cast("long"))
    summed = F.aggregate(F.sequence(low, k), F.lit(0.0), lambda s, i: s + at(i))
    ratio = low * (1 - p) / ((n - low + 1) * p)
    rest = F.when(low > 0, at(low) * ratio / (1 - ratio)).otherwise(0.0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(summed + rest)


def cutoffs(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cutoff (in steps) from ``labelled``: stratum, good
    (boolean) and a column of steps for each rule."""
    step = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES)))
    counts = (labelled.select("stratum", "good", step.alias("x"))
              .groupBy("stratum", "x.rule", "x.step")
              .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    group = Window.partitionBy("stratum", "rule")
    down = group.orderBy(F.col("step").desc())
    tests = (labelled.select("stratum").distinct().count() or 1) * len(RULES)
    tried = counts.select(
        "stratum", "rule", "step", F.sum("good").over(group).alias("n"),
        F.sum("good").over(down).alias("k"), F.sum("bad").over(down).alias("hits"))
    # a step nobody reached rejects what the next one up rejects, so these are all cutoffs there are
    passed = tried.where("step > 0").where(
        binomial_tail(F.col("k"), F.col("n"), risk / len(RULES)) <= delta / tests)
    gain = F.struct((F.col("hits") - F.col("k")).alias("gain"), "step")
    return (passed.groupBy("stratum", "rule").agg(F.max(gain).alias("best"))
            .where("best.gain > 0").select("stratum", "rule", F.col("best.step").alias("cutoff")))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: the counts, base_failed and kept.

    ``labels`` (doc_id, quality) is the holdout; nothing else is fitted to it.
    Several labels of a document count as the lowest; a null label or a label
    of an unknown document counts nothing. Null language: a stratum of its own. Null
    or empty text: no words, base_failed. Rows with the same id are judged one
    by one. Empty tables: no rows, or no cutoffs. Extra columns are not read.
    """
    stats = written(statistics(docs), "quality-rules").withColumn("base_failed", base_failed())
    stratum = F.concat(F.lit("lang="), F.coalesce(F.col("lang").cast("string"), F.lit(""))).alias("stratum")
    rows = stats.select("*", stratum, *(v.alias(k) for k, v in rule_steps().items()))
    known = (labels.where("quality is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    good = (F.col("quality") > 0).alias("good")
    found = written(cutoffs(
        rows.where("not base_failed").select("doc_id", "stratum", *RULES)
        .join(known, "doc_id").select("stratum", good, *RULES), risk, delta), "quality-cutoffs")
    # one row per stratum
    found = found.groupBy("stratum").agg(*(
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES))
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(r) >= F.col(f"cut_{r}"), F.lit(False))
    return rows.join(small_or_merge(found), "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"), "n_capitals", "n_lines")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT row, i, CAST([words[i], words[i + 1], words[i + 2]] AS VARCHAR) AS gram
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
r AS (
  SELECT row, count(DISTINCT j) AS n FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS j FROM (
      SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS c FROM w) WHERE c > 1)
  GROUP BY row),
s AS (
  SELECT row, doc_id, 'lang=' || coalesce(lang, '') AS stratum, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r USING (row)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
x AS (
  SELECT *, CASE WHEN steps < 256 THEN steps
                 ELSE 256 + 32 * (length(bin(steps)) - 9) + (steps >> (length(bin(steps)) - 6)) - 32 END AS step
  FROM (SELECT *, unnest([
    {'rule': 1, 'steps': CASE WHEN n_words > 0 THEN CAST(floor(1000 * n_symbols / (n_words * 50)) AS BIGINT) ELSE 0 END},
    {'rule': 2, 'steps': CASE WHEN word_chars > 0 THEN CAST(floor(1000 * n_capitals / (word_chars * 50)) AS BIGINT) ELSE 0 END},
    {'rule': 3, 'steps': CASE WHEN n_words > 0 THEN CAST(floor(1000 * n_repeat_words / (n_words * 50)) AS BIGINT) ELSE 0 END},
    {'rule': 4, 'steps': CASE WHEN n_lines > 0 THEN CAST(floor(1000 * n_dup_lines / (n_lines * 50)) AS BIGINT) ELSE 0 END},
    {'rule': 5, 'steps': CASE WHEN n_words > 0 THEN CAST(floor(1000 * word_chars / (n_words * 50)) AS BIGINT) ELSE 0 END}],
    recursive := true) FROM b)),
l AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
c AS (
  SELECT stratum, rule, step, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM x JOIN l USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
n AS (SELECT greatest(1, count(DISTINCT stratum)) AS strata FROM c),
t AS (
  SELECT stratum, rule, step, sum(good) OVER (PARTITION BY stratum, rule)::BIGINT AS n,
         sum(good) OVER down::BIGINT AS k, sum(bad) OVER down::BIGINT AS hits
  FROM c WINDOW down AS (PARTITION BY stratum, rule ORDER BY step DESC)),
p AS (
  SELECT stratum, rule, max({'gain': hits - k, 'step': step}) AS best FROM t, n
  WHERE step > 0 AND k < n * 0.02 AND list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98)))) <= 0.05 / (strata * 5)
  GROUP BY stratum, rule),
v AS (
  SELECT x.row, bool_or(x.step >= p.best.step) AS rejected
  FROM x JOIN p ON x.stratum = p.stratum AND x.rule = p.rule AND p.best.gain > 0 GROUP BY x.row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept, n_capitals, n_lines
FROM b LEFT JOIN v USING (row)
"""
