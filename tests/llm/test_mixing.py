import math
import re
from collections import defaultdict

from marketpulse.llm.mixing import mix, mixed
from tests.llm.odd import SCHEMA, frame, odd_rows


def targets(sizes):
    """Resharing by rounds."""
    sources = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    left, open_, out = 1.5 * sum(sizes.values()), set(sources), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
        open_ -= full
    return out


def check(rows, got):
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    for (_, _, s), n in zip(rows, size):
        sizes[s] += n
        most[s] = max(most[s], n)
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert r.taken >= math.floor(r.target / max(1, r.source_size)) * r.size  # complete epochs first
        taken[r.source] += r.taken
    assert sorted(r.size for r in got) == sorted(size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= most[s] + 1e-6, s


def test_odd_rows_reach_their_targets(spark):
    rows = odd_rows()
    check(rows, mixed(frame(spark, rows)).collect())


def test_many_documents_come_near_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 90)), f"s{min(i % 7, 4)}") for i in range(3000)]
    first = mixed(frame(spark, rows)).collect()
    check(rows, first)
    again = mixed(frame(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_quality_raises_the_chance(spark):
    rows = [(i, " ".join(["word" if i % 2 else "*&%$"] * 20), "abc"[i // 2 % 3]) for i in range(6000)]
    taken = defaultdict(int)
    for r in mixed(frame(spark, rows)).collect():
        if r.source == "b":
            taken[r.doc_id % 2] += r.taken
    assert taken[1] > 1.2 * taken[0]


def test_the_mix_has_a_row_for_each_time(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    out = mix(docs)
    assert out.schema == docs.schema
    n = {}
    for r in mixed(docs).where("size > 0 and doc_id is not null and doc_id <> 9").collect():
        n[r.doc_id] = r.taken // r.size
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert all(got[i] == k for i, k in n.items())


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixed(empty).count() == 0 and mix(empty).count() == 0
    assert [r.target for r in mixed(frame(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0.0, 0.0]
