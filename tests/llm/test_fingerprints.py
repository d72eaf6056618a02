import hashlib

from pyspark.sql import functions as F

from marketpulse.llm.fingerprints import combine, fingerprint_state, fingerprint_text, fingerprinted, likeness, remove
from tests.llm.odd import SCHEMA, frame, odd_rows


def test_edited_texts_and_equal_texts(spark):
    rows = [r for r in odd_rows() if r[0] != 9] + [(9, odd_rows()[9][1], "c")]
    got = fingerprinted(frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = []
    for i, t in enumerate(texts):
        k = len(t) // 3
        e = t[:len(t) - k] + texts[(i + 1) % len(texts)][:k]
        want.append((order[i][0], len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    by_text = {}
    own = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t, _ in rows:
        if i is not None:
            by_text.setdefault(t or "", set()).add(own[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for fs in by_text.values() for f in fs}) == len(by_text)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert own[12].near_edited > 0.35 and own[19].near_edited > 0.3 and own[19].near_next < 0.2


def test_paragraphs_are_a_multiset(spark):
    df = spark.createDataFrame([("one two\nthree\nfour five six", "four five six\none two\n\nthree", "three", "one two\nfour five six", "one two\nthree\nthree\nfour five six")],
                               "a string, b string, c string, rest string, twice string")
    state = {c: fingerprint_state(F.col(c)) for c in df.columns}
    text = {c: fingerprint_text(s) for c, s in state.items()}
    r = df.select(
        (text["a"] == text["b"]).alias("any_order"), (fingerprint_text(remove(state["a"], state["c"])) == text["rest"]).alias("deleted"),
        (fingerprint_text(combine(state["rest"], state["c"])) == text["a"]).alias("inserted"), (text["a"] != text["twice"]).alias("counted"),
        likeness(state["a"], state["b"]).alias("same")).first()
    assert r.any_order and r.deleted and r.inserted and r.counted and r.same == 1.0


def test_likeness_estimates_shared_pieces(spark):
    lines = [" ".join(f"l{i}w{j}" for j in range(8)) for i in range(600)]
    df = spark.createDataFrame([("\n".join(lines[:400]), "\n".join(lines[200:]))], "a string, b string")
    near = df.select(likeness(fingerprint_state(F.col("a")), fingerprint_state(F.col("b")))).first()[0]
    assert abs(near - 200 / 600) < 0.12


def test_empty_and_single(spark):
    assert fingerprinted(spark.createDataFrame([], SCHEMA)).count() == 0
    r = fingerprinted(frame(spark, [(3, "a b\nc", None)])).first()
    assert r.edited_sha256 == hashlib.sha256(b"a b\na").hexdigest()
    assert fingerprinted(frame(spark, [(None, None, None), (None, "x", None)])).count() == 2


def test_sparse_and_crowded_ids(spark):
    ids = [*range(300), 10 ** 15, -10 ** 15, *range(5 * 10 ** 9, 5 * 10 ** 9 + 300)]
    got = fingerprinted(frame(spark, [(i, f"{i:030d}", None) for i in ids])).collect()
    order = sorted(ids, reverse=True)
    want = {i: f"{i:030d}"[:20] + f"{order[(k + 1) % len(order)]:030d}"[:10] for k, i in enumerate(order)}
    assert {r.doc_id: r.edited_sha256 for r in got} == {i: hashlib.sha256(e.encode()).hexdigest() for i, e in want.items()}
