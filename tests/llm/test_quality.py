import math
import random
import re
import zlib

import pytest
import regex
from pyspark.sql import functions as F

from marketpulse.llm.quality import STATISTICS, RuleEnsemble, keep_good, scored, tree_rules, with_statistics
from tests.llm.odd import SCHEMA, frame, odd_rows

SF = "/root/testdata/sf0.01"
TREE = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=13
  If (feature 3 <= 0.5)
   If (feature 8 <= 0.25)
    Predict: 1.0
   Else (feature 8 > 0.25)
    Predict: 0.0
  Else (feature 3 > 0.5)
   If (feature 3 <= 0.75)
    Predict: 1.0
   Else (feature 3 > 0.75)
    Predict: 0.0
"""


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, score double")


def test_paths_become_rules():
    inf = math.inf
    assert tree_rules(TREE) == [((3, -inf, 0.5),), ((3, -inf, 0.5), (8, -inf, 0.25)), ((3, -inf, 0.5), (8, 0.25, inf)),
                                ((3, 0.5, inf),), ((3, 0.5, 0.75),), ((3, 0.75, inf),)]


def test_statistics_equal_brute_force(spark):
    got = with_statistics(frame(spark, odd_rows())).where("doc_id is not null and doc_id <> 9").collect()
    texts = {i: t or "" for i, t, _ in odd_rows()}
    for r in got:
        t = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = max(1, len(t))
        assert math.isclose(r.log_chars, math.log1p(len(t))) and math.isclose(r.log_words, math.log1p(len(words)))
        assert math.isclose(r.distinct_words, len(set(words)) / max(1, len(words)))
        assert math.isclose(r.word_length, sum(map(len, words)) / max(1, len(words)))
        assert math.isclose(r.stops, t.count(".") / n) and math.isclose(r.lines, t.count("\n") / n) and math.isclose(r.exclamations, t.count("!") / n)


def plain_statistics(text):
    """The statistics of a text, counted in Python."""
    t = text or ""
    words, parts = re.findall(r"[^\x20\x09-\x0D]+", t), [p for p in re.split(r"[.!?\n]+[\x20\x09-\x0D]*", t) if p]
    n, n_words = len(t), len(words)

    def share(part, of):
        return part / of if of else 0.0
    symbols = len(regex.sub(r"[\p{L}\p{N}\x20\x09-\x0D.,;:!?'\"()-]", "", t))
    return (math.log1p(n), math.log1p(n_words), share(sum(map(len, words)), n_words), share(len(set(words)), n_words), share(len(set(parts)), len(parts)),
            share(len(regex.findall(r"\p{L}", t)), n), share(len(regex.findall(r"\p{Lu}", t)), n), share(len(re.findall("[0-9]", t)), n), share(symbols, n),
            share(t.count("!"), n), share(t.count("."), n), share(t.count("\n"), n), share(len(parts), n_words))


def test_scores_equal_rules_held_by_hand(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs.unionByName(frame(spark, odd_rows()).where("doc_id is not null and doc_id <> 9").select(F.col("doc_id") - 1000, "text").toDF("doc_id", "text"))
    model = RuleEnsemble.fit(docs, labels)
    assert len(model.weights) > 3
    got = {r.doc_id: r.score for r in scored(docs, labels).collect()}
    texts = docs.collect()
    assert len(texts) == len(got) > 1000
    for doc_id, text in texts:
        x = plain_statistics(text)
        odds = model.intercept + sum(w for rule, w in model.weights if all(low < x[f] <= high for f, low, high in rule))
        assert math.isclose(got[doc_id], 1 / (1 + math.exp(-odds)), rel_tol=1e-9), doc_id


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert not [r for r in rows if r.quality == 1 and not r.predicted]


def test_odd_rows_and_filter(spark):
    rnd = random.Random(1)
    rows = [(1000 + i, " ".join("*%$#"[:rnd.randint(1, 4)] if i % 4 == 0 else f"w{rnd.randrange(500)}" for _ in range(40)), "a") for i in range(300)]
    docs = frame(spark, rows + odd_rows())
    labels = labels_frame(spark, [(i, int(i % 4 != 0), 0, "x", 0.0) for i, _, _ in rows] + [(None, 1, 0, "x", 0.0), (1, None, 0, "x", 0.0), (1001, 1, 0, "x", 0.0)])
    got = scored(docs, labels).collect()
    assert len(got) == docs.count() and all(r.score is not None for r in got)
    right = [r.predicted == int(r.doc_id % 4 != 0) for r in got if r.doc_id and 1000 <= r.doc_id < 2000 and r.held_out]
    assert sum(right) >= 0.95 * len(right)
    kept = keep_good(docs, labels)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in got)


@pytest.mark.parametrize("rows, score", [([], 0.5), ([(7, 1, 0, "", 0.0), (8, 1, 0, "", 0.0)], 1.0), ([(7, 0, 0, "", 0.0), (8, 0, 0, "", 0.0)], 0.0)])
def test_labels_of_one_class(spark, rows, score):
    got = scored(frame(spark, odd_rows()), labels_frame(spark, rows)).collect()
    assert len(got) == len(odd_rows()) and all(abs(r.score - score) < 1e-3 for r in got)


def test_only_the_text_enters_a_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = RuleEnsemble(0.1, [(((0, -math.inf, 7.0), (8, 0.001, math.inf)), 1.5), (((3, 0.4, 0.9),), -2.0)])
    assert set(with_statistics(docs).columns) == {"doc_id", *STATISTICS}
    a = with_statistics(docs).select("doc_id", model.score().alias("s"))
    b = with_statistics(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))).select("doc_id", model.score().alias("s"))
    assert a.exceptAll(b).count() == 0


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scored(empty, labels_frame(spark, [])).count() == 0 and keep_good(empty, labels_frame(spark, [(1, 1, 0, "", 0.0)])).count() == 0
