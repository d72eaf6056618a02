"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Where the next byte has no edge, greedy
matching would cut the longest pieces off the front of what was read and go on
with the rest: a failure link leads straight to the node of that rest, and a
number stored with it tells how many pieces were popped. So a word is counted in
one pass over its bytes, without building a piece or starting over.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketpulse.llm.common import table
from marketpulse.llm.packing import byte_alphabet

#: Words whose count a worker keeps at hand; beyond, new ones are counted each time.
CACHED = 1_000_000
COUNTED = "doc_id long, n_words long, n_tokens long"


class LongestMatch:
    """Counts the pieces of greedy longest matching from the left.

    A word that can't be matched to its end is one unknown token."""

    def __init__(self, pieces: Iterable[bytes]):
        #: node << 8 | byte -> node; node 0 is the root
        self.edges: dict[int, int] = {}
        ends, parents = [False], [(0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                node = self.edges.get(key, 0)
                if not node:
                    node = self.edges[key] = len(ends)
                    ends.append(False)
                    parents.append((key >> 8, byte))
            if node:
                ends[node] = True
        #: where to go on, -1: nowhere; pieces popped on the way
        self.failure, self.popped = [-1] * len(ends), [0] * len(ends)
        children: dict[int, list[int]] = {}
        for node, (parent, _) in enumerate(parents[1:], 1):
            children.setdefault(parent, []).append(node)
        queue = deque(children.get(0, ()))
        while queue:
            node = queue.popleft()
            queue.extend(children.get(node, ()))
            parent, byte = parents[node]
            if ends[node]:
                self.failure[node], self.popped[node] = 0, 1
                continue
            at, popped = self.failure[parent], self.popped[parent]
            while at >= 0 and at << 8 | byte not in self.edges:
                popped += self.popped[at]
                at = self.failure[at]
            if at >= 0:
                self.failure[node], self.popped[node] = self.edges[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        edges, failure, popped = self.edges, self.failure, self.popped
        node = n = 0
        for byte in word:
            while (to := edges.get(node << 8 | byte)) is None:
                n += popped[node]
                node = failure[node]
                if node < 0:
                    return 1
            node = to
        while node > 0:
            n += popped[node]
            node = failure[node]
        return n if node == 0 else 1


def byte_pieces(path: str) -> list[bytes]:
    """The vocabulary of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = byte_alphabet()
    return [bytes(byte[c] for c in token) for token in vocab]


def token_counts(docs: DataFrame, pieces: list[bytes]) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_tokens``.

    Words are parted at ASCII white space and read with a space before them, as
    byte-level vocabularies write the start of a word. Null, empty and blank texts
    have none. Texts of any length are read whole. An empty table gives an empty
    result; columns other than ``doc_id`` and ``text`` are not looked at. What is
    broadcast is the vocabulary's automaton, whose size the vocabulary bounds."""
    automaton = docs.sparkSession.sparkContext.broadcast(LongestMatch(pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, known = automaton.value.count, {}

        def tokens(words: list[bytes]) -> int:
            n = 0
            for w in words:
                k = known.get(w)
                if k is None:
                    k = of(b" " + w)
                    if len(known) < CACHED:
                        known[w] = k
                n += k
            return n

        for batch in batches:
            n_words, n_tokens = [], []
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(1).slice(at, 256).to_pylist():
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    n_words.append(len(words))
                    n_tokens.append(tokens(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(count, COUNTED)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), byte_pieces(public_tokenizers.path("byte_bpe_50k.json")))
