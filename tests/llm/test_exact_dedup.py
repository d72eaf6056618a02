import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marketpulse.llm.exact_dedup import chunks_of, drop_exact_copies, exact_classes, normalised
from tests.llm.odd import SCHEMA, frame, odd_rows

ROWS = odd_rows() + [(30, "a" * 9000, "a"), (31, "a" * 4096 + " " + "a" * 4904, "a"), (32, "a" * 9001, "a")]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t, _ in rows:
        g = sorted(groups[normal(t)], key=lambda x: x[:3])
        out.append((i, g[0][3], len(g), hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("bits", [64, 1])  # one bit: nearly every chunk's hash clashes
def test_classes_equal_brute_force(spark, bits):
    got = exact_classes(frame(spark, ROWS), bits).collect()
    want, n_groups = expected(ROWS)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == n_groups  # one row of a class, repeated rows included
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_chunks_follow_the_content(spark):
    """All chunks together are the text, and behind an insertion at its start most stay as they
    were: with sentence marks, without any, and in another script."""
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdefghij") for _ in range(60_000)), "".join(chr(0x4E00 + rnd.randrange(300)) for _ in range(60_000)),
             "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.choice([1, 1, 1, 2]) + ("." if rnd.random() < 0.01 else "") for _ in range(60_000)),
             "".join(chr(0x3042 + i % 50) + ("\u3002" if rnd.random() < 0.01 else "") for i in range(60_000)), "ab" * 9000, "\n" + "x" * 5000, ""]
    rows = [(2 * i + j, (["", "inserted,"][j] + t)) for i, t in enumerate(texts) for j in (0, 1)]
    got = {r.doc_id: (r.n, r.c) for r in spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", normalised(F.col("text")).alias("n"), chunks_of(normalised(F.col("text"))).alias("c")).collect()}
    assert all("".join(c) == n and all(len(x) <= 4096 for x in c) for n, c in got.values())
    for i in range(4):
        (_, a), (_, b) = got[2 * i], got[2 * i + 1]
        assert len(a) > 10 and len(set(a) & set(b)) >= 0.7 * len(a), (i, len(a), len(set(a) & set(b)))


def test_filter_keeps_one_row_of_each_class_with_all_columns(spark):
    docs = frame(spark, ROWS)
    kept = drop_exact_copies(docs)
    assert kept.schema == docs.schema
    assert len({normal(r.text) for r in kept.collect()}) == kept.count() == expected(ROWS)[1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_classes(empty).count() == 0 and drop_exact_copies(empty).count() == 0
