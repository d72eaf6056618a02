import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketpulse.llm.packing import CAPACITY, TextIds, lower_bound, pack_histogram, packed
from tests.llm.odd import SCHEMA, frame, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def fewest(items, cap):
    best, items = len(items), sorted(items, reverse=True)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j, load in enumerate(bins):
            if load + items[i] <= cap and load not in bins[:j]:
                go(i + 1, bins[:j] + [load + items[i]] + bins[j + 1:])
        go(i + 1, bins + [items[i]])
    go(0, [])
    return best


def test_search_is_valid_and_near_the_optimum():
    rnd, missed = random.Random(0), 0
    for _ in range(200):
        cap = rnd.choice([10, 20, 30])
        items = [rnd.randint(1, cap) for _ in range(rnd.randint(0, 9))]
        counts = np.bincount(items, minlength=cap + 1) if items else np.zeros(cap + 1, int)
        patterns = pack_histogram(counts, cap)
        used = np.zeros(cap + 1, int)
        for pattern, times in patterns:
            assert sum(pattern) <= cap and times > 0
            for s in pattern:
                used[s] += times
        assert (used == counts).all()
        n = sum(t for _, t in patterns)
        assert n >= lower_bound(counts, cap)
        missed += n - fewest(items, cap)
    assert missed <= 6


def test_large_histogram_meets_the_bound():
    rnd = np.random.default_rng(1)
    counts = np.bincount(rnd.integers(1, CAPACITY + 1, 200_000), minlength=CAPACITY + 1)
    bins = sum(t for _, t in pack_histogram(counts))
    assert bins <= lower_bound(counts, CAPACITY) * 1.001
    assert sum(t for _, t in pack_histogram(np.where(np.arange(CAPACITY + 1) == 500, 10 ** 12, 0))) == 5 * 10 ** 11


def test_ids_are_the_tokenizers(tokenizer):
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "a", "B", "é", "9", "٣", "!", "'s", "'", "...", "中", "😀", "́", "½", "\x00", "<|endoftext|>", "the ", "ﬁ"]
    rnd, ids = random.Random(3), TextIds(PATH)
    assert ids.encoding
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert ids.of(text) == np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    other = TextIds(public_tokenizers.path("word_bpe_49k.json"))
    assert other.encoding is None and other.of("hello")


def test_pieces_and_places(spark, tokenizer):
    rows = odd_rows() + [(100 + i, "word " * (i % 5), "a") for i in range(600)]  # a very common length too
    got = packed(frame(spark, rows)).collect()
    want = []
    for i, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        start, first = 0, len(ids) % CAPACITY or CAPACITY
        for piece, stop in enumerate(range(first, len(ids) + 1, CAPACITY)):
            want.append((i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
            start = stop
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= CAPACITY
    assert len(sequences) <= -(-sum(r.length for r in got) // CAPACITY) + 2


def test_empty(spark):
    assert packed(spark.createDataFrame([], SCHEMA)).count() == 0
