import random

import numpy as np
import pytest

from marketpulse.llm.near_dedup import WordHashes, shingle_set
from marketpulse.llm.parity_join import join_keys, linked_sets, most_apart, parity_bits, schemes
from tests.llm.odd import SCHEMA, frame, odd_rows
from tests.llm.test_linking import roots


def near_rows():
    rnd = random.Random(12)
    out, base = [], {}
    for g in range(30):
        base[g] = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([3, 4, 5, 9, 10, 24, 40, 90, 160, 400]))]
        for k in range(rnd.choice([1, 2, 3, 12])):
            words = list(base[g])
            for _ in range(k % 4):
                at = rnd.randrange(len(words))
                words[at:at + rnd.choice([0, 1])] = rnd.choice([[], [f"e{rnd.randrange(10 ** 6)}"]])
            out.append((1000 + len(out), " ".join(words).upper() if k % 2 else "\n".join(words), "a"))
    chain = [f"c{i}" for i in range(120)]
    for i in range(25):  # each is near the next, the ends aren't near each other
        out.append((5000 - i, " ".join(chain[i * 2:] + [f"d{j}" for j in range(i * 2)]), "b"))
    return out


def brute(rows, width, percent):
    hashes = WordHashes()
    sets = [set(shingle_set(t, width, hashes).tolist()) for _, t, _ in rows]
    live = [i for i, (d, _, _) in enumerate(rows) if d is not None and sets[i]]
    links = [(a, b) for x, a in enumerate(live) for b in live[x + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = roots(links)
    least = {}
    for i in live:
        r = root.get(i, i)
        least[r] = min(least.get(r, 1 << 63), rows[i][0])
    return sorted(((d, len(sets[i]), None if d is None else least[root.get(i, i)] if sets[i] else d) for i, (d, _, _) in enumerate(rows)), key=repr), links


@pytest.mark.parametrize("width,percent", [(4, 85), (2, 80), (5, 95), (1, 100)])
def test_components_equal_brute_force(spark, width, percent):
    rows = odd_rows() + near_rows()
    want, links = brute(rows, width, percent)
    assert links
    got = linked_sets(frame(spark, rows), width, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want


@pytest.mark.parametrize("percent", [80, 85, 93, 100])
def test_linked_sets_share_a_key(percent):
    """Every pair at the bound, at all sizes: a key in common, and parities within the bound."""
    rng = np.random.default_rng(percent)
    for n in [*range(1, 90), 128, 129, 255, 256, 257, 700, 3000]:
        own = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for apart in {0, most_apart(2 * n, percent)}:
            for lost in {0, apart // 2, apart}:
                other = np.unique(np.concatenate([own[lost:], rng.integers(0, 1 << 63, apart - lost).astype(np.uint64)]))
                shared = len(np.intersect1d(own, other))
                if len(other) and 100 * shared >= percent * (len(own) + len(other) - shared):
                    assert len(np.intersect1d(join_keys(own, percent), join_keys(other, percent)))
                    x, y = parity_bits(own), parity_bits(other)
                    x, y = (z if len(z) == min(len(x), len(y)) else z[:len(z) // 2] ^ z[len(z) // 2:] for z in (x, y))
                    bits = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
                    assert bits <= len(own) + len(other) - 2 * shared <= most_apart(len(own) + len(other), percent)


def test_keys_stay_in_proportion():
    for n in range(30, 5000, 61):
        assert sum(words for _, words, _ in schemes(n, 85)) <= 0.9 * n


def test_empty_table_and_bounds(spark):
    assert linked_sets(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in linked_sets(frame(spark, [(1, None, None)])).collect()] == [(1, 0, 1)]
    with pytest.raises(ValueError):
        linked_sets(frame(spark, []), percent=50)
