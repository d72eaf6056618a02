import math
import random

import numpy as np

from marketpulse.llm.near_dedup import BANDS, ROWS, SKETCH_BITS, SLACK, WordHashes, near_components, one_of_each, shingle_set, signature
from tests.llm.odd import LONG, SCHEMA, frame, odd_rows
from tests.llm.test_linking import roots


def sets_of(rows, width):
    out = []
    for i, text, _ in rows:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        out.append((i, frozenset(tuple(words[j:j + k]) for j in range(len(words) - k + 1)) if words else frozenset()))
    return out


def expected(rows, width, percent=80):
    sets = [(i, s) for i, s in sets_of(rows, width) if i is not None and s]
    edges = [(i, j) for a, (i, s) in enumerate(sets) for j, t in sets[a + 1:] if 100 * len(s & t) >= percent * len(s | t)]
    return roots(edges)


def copies(n):
    """A large group around one text with few to many edits, so links form chains."""
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(300)}" for _ in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randrange(0, 14)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10 ** 6)}"
        out.append((1000 + i, " ".join(words), "a"))
    return out


def test_components_equal_brute_force(spark):
    rows = odd_rows() + copies(260) + [(3000, "One Two", "a"), (3001, "one\ttwo", "b"), (3002, "two one", "b")]
    want = expected(rows, 2)
    got = near_components(frame(spark, rows), width=2).collect()
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == sorted((i, len(s)) for i, s in sets_of(rows, 2) if i is not None)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want.get(r.doc_id, r.doc_id) and r.kept == (r.component_id == r.doc_id)
    assert want[12] == want[13] == 12 and len({want.get(i, i) for i in range(1000, 1260)}) < 200


def test_one_of_each_group_stays(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    out = one_of_each(docs)
    assert out.schema == docs.schema
    want = expected(rows, 5)
    kept = [r.doc_id for r in out.collect()]
    assert sorted(map(repr, kept)) == sorted(repr(i) for i, _, _ in rows if i is None or want.get(i, i) == i)


def test_signature_estimates_similarity():
    hashes = WordHashes()
    a = shingle_set(" ".join(f"a{i}" for i in range(1000)), 2, hashes)
    b = shingle_set(" ".join(f"a{i}" for i in range(200, 1200)), 2, hashes)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, 2048) == signature(b, 2048)).mean() - true) < 0.04
    assert len(shingle_set(LONG, 5, hashes)) > 20_000


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_components(empty).count() == 0 and one_of_each(empty).count() == 0


def test_two_texts_of_one_id(spark):
    """One is a copy of a smaller id's text, the other is its own: only the copy goes."""
    rnd = random.Random(12)
    one, two = (" ".join(f"w{rnd.randrange(5000)}" for _ in range(60)) for _ in range(2))
    rows = [(1, one, "a"), (5, one, "b"), (5, two, "c"), (5, None, "d"), (6, two + " end", "e"), (7, one, "f")]
    assert sorted(r.source for r in one_of_each(frame(spark, rows)).collect()) == ["a", "c", "d"]


def test_sketches_lose_less_than_the_bands():
    """At the threshold, by the binomial tail: a bit of the sketch differs in a tenth of the cases."""
    p = (1 - 0.8) / 2
    most = int(SKETCH_BITS * p + SLACK * (SKETCH_BITS * p * (1 - p)) ** 0.5)
    tail = sum(math.comb(SKETCH_BITS, k) * p ** k * (1 - p) ** (SKETCH_BITS - k) for k in range(most + 1, SKETCH_BITS + 1))
    assert tail < 1e-6 < (1 - 0.8 ** ROWS) ** BANDS
