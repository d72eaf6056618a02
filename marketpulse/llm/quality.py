"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics are Spark column expressions. A random forest over a bounded sample
of labelled rows proposes rules, the conjunctions along its paths; logistic
regression with an L1 penalty weighs them and drops most. The rules that remain
are compiled into one Spark column, so scoring is a scan without a shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import BLANK, stored, table, whole

#: Labelled rows that are learned from at most, those with the smallest hash of doc_id
SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
TREES, DEPTH, SEED = 30, 3, 7
L1 = 0.0005
#: Documents that score below are rejected.
LEAST_SCORE = 0.3

Rule = tuple[tuple[int, float, float], ...]  # (statistic, low, high): low < x <= high

STATISTICS = ("log_chars", "log_words", "word_length", "distinct_words", "distinct_parts", "letters", "capitals", "digits",
              "symbols", "exclamations", "stops", "lines", "parts")


def with_statistics(docs: DataFrame, text: str = "text", kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``kept`` and the ``STATISTICS`` of whole texts. Shares of nothing are 0."""
    def left(pattern: str) -> Column:  # code points outside the pattern
        return F.char_length(F.regexp_replace("s_text", pattern, "")).cast("double")

    def share(part: Column, of: str) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), F.col(of)), F.lit(0.0))

    rows = docs.select(*kept, whole(F.col(text)).alias("s_text")).select(
        "*", F.char_length("s_text").cast("double").alias("s_n"),
        F.filter(F.split("s_text", BLANK + "+"), lambda w: w != "").alias("s_words"),
        F.filter(F.split("s_text", r"[.!?\n]+[\x20\x09-\x0D]*"), lambda w: w != "").alias("s_parts"))
    rows = rows.select(
        *kept, "s_n", F.size("s_words").cast("double").alias("s_n_words"), F.size(F.array_distinct("s_words")).alias("s_distinct"),
        F.size("s_parts").cast("double").alias("s_n_parts"), F.size(F.array_distinct("s_parts")).alias("s_distinct_parts"),
        left(BLANK + "+").alias("s_solid"), left(r"\P{L}+").alias("s_letters"), left(r"\P{Lu}+").alias("s_capitals"), left("[^0-9]+").alias("s_digits"),
        left(r"[\p{L}\p{N}\x20\x09-\x0D.,;:!?'\"()-]+").alias("s_symbols"), left("[^!]+").alias("s_exclamations"),
        left("[^.]+").alias("s_stops"), left("[^\n]+").alias("s_lines"))
    values = (F.log1p("s_n"), F.log1p("s_n_words"), share(F.col("s_solid"), "s_n_words"), share(F.col("s_distinct"), "s_n_words"),
              share(F.col("s_distinct_parts"), "s_n_parts"), share(F.col("s_letters"), "s_n"), share(F.col("s_capitals"), "s_n"),
              share(F.col("s_digits"), "s_n"), share(F.col("s_symbols"), "s_n"), share(F.col("s_exclamations"), "s_n"),
              share(F.col("s_stops"), "s_n"), share(F.col("s_lines"), "s_n"), share(F.col("s_n_parts"), "s_n_words"))
    return rows.select(*kept, *[v.alias(s) for v, s in zip(values, STATISTICS)])


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def tree_rules(tree_text: str) -> list[Rule]:
    """The path to every node but the root of one tree, as printed by Spark ML."""
    rules, path = [], []
    for indent, feature, sign, at in re.findall(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", tree_text, re.M):
        while path and path[-1][0] >= len(indent):
            path.pop()
        path.append((len(indent), int(feature), sign, float(at)))
        bounds: dict[int, list[float]] = {}
        for _, f, s, x in path:
            low_high = bounds.setdefault(f, [-math.inf, math.inf])
            low_high[s == "<="] = min(low_high[1], x) if s == "<=" else max(low_high[0], x)
        rules.append(tuple((f, *lh) for f, lh in sorted(bounds.items())))
    return rules


def rule_column(rule: Rule) -> Column:
    held = F.lit(True)
    for f, low, high in rule:
        x = F.col(STATISTICS[f])
        held = held & (x > low if low > -math.inf else F.lit(True)) & (x <= high if high < math.inf else F.lit(True))
    return held.cast("double")


class RuleEnsemble:
    """``intercept + sum(weight of each rule that holds)`` as a log-odds."""

    def __init__(self, intercept: float, weights: list[tuple[Rule, float]]):
        self.intercept, self.weights = intercept, weights

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + rule_column(rule) * weight
        return 1.0 / (1.0 + F.exp(-total))

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
        """From at most ``SAMPLE`` labelled rows outside the held-out fold. Without
        labels of both classes every score is the share of label 1 (no labels: 0.5)."""
        known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).dropna().where(fold(F.col("doc_id")) != HELD_OUT)
        # of a large table, first those whose hash is low enough for somewhat more than the sample
        share = min(1.0, 1.2 * SAMPLE / max(1, known.count()))
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
        chosen = known.where(drawn < F.lit(int(share * (1 << 40)))).orderBy(drawn, "doc_id", "label").limit(SAMPLE)
        # the sample's size is bounded, so it can be broadcast
        known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        sample = stored(with_statistics(known, kept=("doc_id", "label")), "quality-sample").orderBy("doc_id", "label", *STATISTICS).coalesce(1).cache()
        n, ones = sample.agg(F.count("*"), F.sum("label")).first()
        if not n or ones in (0, n):
            sample.unpersist()
            share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
            return cls(math.log(share / (1 - share)), [])
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", maxBins=64)
        trees = forest.fit(VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)).trees
        rules = sorted({r for t in trees for r in tree_rules(t.toDebugString)})
        held = sample.select("label", F.array(*map(rule_column, rules)).alias("rules"))
        held = held.select("label", *[F.col("rules")[i].alias(f"r{i}") for i in range(len(rules))])
        lasso = LogisticRegression(regParam=L1, elasticNetParam=1.0, maxIter=60)
        fitted = lasso.fit(VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held).select("label", "features").cache())
        sample.unpersist()
        return cls(float(fitted.intercept), [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray()) if w])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Null and empty texts get a score from statistics that are all 0; texts of any
    length are read whole. Rows of ``docs`` need not have a label. Labels that are
    null count as none, repeated ones as often as they come. An empty table gives an
    empty result. Only ``text`` enters a score; other columns aren't looked at."""
    model = RuleEnsemble.fit(docs, labels)
    return with_statistics(docs).select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= LEAST_SCORE).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``LEAST_SCORE``."""
    model = RuleEnsemble.fit(docs, labels)
    rows = docs.select(F.struct("*").alias("s_doc"), "text")
    return with_statistics(rows, kept=("s_doc",)).where(model.score() >= LEAST_SCORE).select("s_doc.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
