import random

import public_tokenizers

from marketpulse.llm.token_counts import LongestMatch, byte_pieces, token_counts
from tests.llm.odd import SCHEMA, frame, odd_rows


def greedy(word, pieces, longest):
    n = at = 0
    while at < len(word):
        to = next((k for k in range(min(len(word), at + longest), at, -1) if word[at:k] in pieces), None)
        if to is None:
            return 1
        at, n = to, n + 1
    return n


def test_automaton_equals_greedy_matching():
    rnd = random.Random(1)
    for _ in range(3000):
        pieces = {bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 9))}
        word = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 12)))
        assert LongestMatch(pieces).count(word) == greedy(word, pieces, 5), (pieces, word)


def test_counts_of_odd_rows(spark):
    pieces = byte_pieces(public_tokenizers.path("byte_bpe_50k.json"))
    known, longest = set(pieces), max(map(len, pieces))
    want = []
    for i, text, _ in odd_rows():
        words = (text or "").encode().split()
        want.append((i, len(words), sum(greedy(b" " + w, known, longest) for w in words)))
    got = token_counts(frame(spark, odd_rows()), pieces).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    assert token_counts(spark.createDataFrame([], SCHEMA), pieces).count() == 0
