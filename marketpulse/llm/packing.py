"""Best-fit packing of documents into token sequences by bin completion.

A document's tokens are cut into pieces of the sequence length (the first piece
may be shorter). Sequences only depend on how many pieces have which length, so
the search runs on a histogram with an entry per length, at most the capacity's
number of rows however large the corpus is: it branches on the undominated
fillings around the largest length, prunes by waste, and starts from the best
fit as incumbent. Its result, filling patterns with multiplicities, is dealt out
to the pieces by their rank within their length. Ranks come from counts per
(length, block of ids), so no task holds all pieces of a length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from marketpulse.llm.common import stored, table

CAPACITY = 1024
END_ID = 2
#: Fillings that the search may try after the incumbent before it settles.
NODE_LIMIT = 3_000
#: Tokens that a filling may waste for having fewer items, in the incumbents
SLACKS = (0, 1, 2, 3, 5, 8, 12, 16, 20, 32)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1
    ones stand for themselves, the others count up from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TextIds:
    """Ids of texts as little-endian bytes, by the tokenizer in a file.

    For a plain byte-level BPE whose merges are numbered in their order, tiktoken
    gives the same ids from the same vocabulary, some four times as fast; any other
    tokenizer, and a text that holds a special token's string, go to tokenizers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges, before = spec["model"].get("vocab"), spec["model"].get("merges"), spec.get("pre_tokenizer") or {}
        self.encoding = None
        if (spec["model"]["type"], before.get("type"), before.get("use_regex"), before.get("add_prefix_space"), spec.get("normalizer"), spec.get("post_processor")) == (
                "BPE", "ByteLevel", True, False, None, None) and not spec["model"].get("ignore_merges"):
            made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
            if made == sorted(made) and len(vocab) == len(made) + 256:
                byte = byte_alphabet()
                ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
                self.encoding = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> bytes:
        if self.encoding and not any(s in text for s in self.special):
            ids = self.encoding.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = TextIds(tokenizer_path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    data = ids.of(text or "") + end
                    total = len(data) // 4
                    start = 0
                    first = total % capacity or capacity
                    for piece, stop in enumerate(range(first, total + 1, capacity)):
                        row = (doc_id, piece, start, stop - start, zlib.crc32(memoryview(data)[4 * start:4 * stop]))
                        for column, value in zip(out, row):
                            column.append(value)
                        start = stop
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Martello and Toth's L2: no packing has fewer bins."""
    sizes = np.arange(capacity + 1)
    number, words = np.cumsum(counts), np.cumsum(counts * sizes)
    half, best = capacity // 2, 0
    for small in range(half + 1):
        large = int(number[capacity] - number[half])
        mid_words = int(words[capacity - small] - words[half])
        mid = int(number[capacity - small] - number[half])
        low_words = int(words[half] - (words[small - 1] if small else 0))
        best = max(best, large + max(0, -(-(low_words - (mid * capacity - mid_words)) // capacity)))
    return best


def completions(counts: np.ndarray, room: int, slack: int = 0, most: int = 6) -> list[tuple[int, ...]]:
    """Fillings of ``room``, best first. Of up to three items, those that no filling
    of fewer items with at least their sum dominates; fillings of many items start
    with the best fit until three more can end them. A filling that wastes up to
    ``slack`` is not searched beyond: fewer items are worth that much. Of equal
    sums the one whose smallest item is largest comes first, as small items fit
    anywhere later."""
    sizes = np.flatnonzero(counts[:room + 1])
    sizes = sizes[sizes > 0]
    if not len(sizes):
        return [()]
    below = np.zeros(room + 1, np.int64)  # the largest size there is, at most x
    below[sizes] = sizes
    below = np.maximum.accumulate(below)
    head: list[int] = []
    left = room
    while left > 3 * below[left] > 0 and counts[below[left]] > head.count(int(below[left])):
        head.append(int(below[left]))
        left -= head[-1]
    if head:
        rest = counts.copy()
        np.subtract.at(rest, head, 1)
        return [(*head, *tail) for tail in completions(rest, left, slack, most)]

    def ranked(total: np.ndarray, last: np.ndarray, least: int) -> np.ndarray:
        """The best few by sum, then by smallest item, that have over ``least``."""
        top = np.flatnonzero(total > max(least, np.partition(total, -min(len(total), 4 * most))[-min(len(total), 4 * most)] - 1))
        return top[np.lexsort((-last[top], -total[top]))][:most]

    found: list[tuple[int, ...]] = [(int(below[room]),)]
    best = int(below[room])
    a = sizes[::-1]
    if room - best > slack:
        b = below[np.minimum(room - a, a)]
        total = np.where((b > 0) & ((a != b) | (counts[a] > 1)), a + b, 0)
        found = [(int(a[i]), int(b[i])) for i in ranked(np.minimum(total, room - slack) if total.max() >= room - slack else total, b, best)] + found
        best = max(map(sum, found))
    if room - best > slack:
        x, y = (m.ravel() for m in np.meshgrid(a, a, indexing="ij"))
        rest = room - x - y
        z = np.where((rest > 0) & (y <= x), below[np.clip(np.minimum(rest, y), 0, room)], 0)
        repeated = 1 + (x == y) + (y == z) * np.where(x == y, 1, 0)
        total = np.where((z > 0) & (counts[y] >= np.maximum(repeated, 1 + (y == z))) & (counts[x] >= repeated), x + y + z, 0)
        found = [(int(x[i]), int(y[i]), int(z[i])) for i in ranked(total, z, best)] + found
    return found[:most]


def _search(counts: np.ndarray, capacity: int, slack: int, bound: int, most_bins: float, node_limit: int) -> list | None:
    """Depth first over fillings around the largest size left; the best packing of
    under ``most_bins`` that is met within ``node_limit`` fillings, the first dive
    not counted. Ends at ``bound``. Prunes where even without further waste no
    fewer bins come out."""
    sizes = np.arange(capacity + 1)
    best, nodes = None, 0
    # (counts left, bins so far, fillings so far as a linked list)
    stack: list[tuple[np.ndarray, int, tuple | None]] = [(counts, 0, None)]
    dived = False
    while stack and nodes <= node_limit and most_bins > bound:
        left, bins, path = stack.pop()
        nodes += dived
        if bins + -(-int((left * sizes).sum()) // capacity) >= most_bins:
            dived = True
            continue
        filled = np.flatnonzero(left)
        if not len(filled):
            most_bins, best, dived = bins, path, True
            continue
        largest = int(filled[-1])
        rest = left.copy()
        rest[largest] -= 1
        for filling in reversed(completions(rest, capacity - largest, slack)):  # the best one is popped first
            pattern = (largest, *filling)
            times = min(int(left[s]) // pattern.count(s) for s in set(pattern))
            after = left.copy()
            for s in pattern:
                after[s] -= times
            stack.append((after, bins + times, (path, pattern, times)))
    out = []
    while best:
        best, pattern, times = best
        out.append((pattern, times))
    return out[::-1] or None


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY, node_limit: int = NODE_LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """``counts[s]`` items of size ``s`` -> filling patterns (sizes from the largest)
    and how many bins each fills; as few bins as the search finds.

    A pattern is applied as often as the counts allow at once. Best-fit packings
    with different slack are the incumbents; branch and bound goes on from the best
    slack. It ends at the lower bound, or after ``node_limit`` more fillings."""
    counts = np.asarray(counts, np.int64)
    bound, best, bins, by = lower_bound(counts, capacity), [], float("inf"), 0
    for slack in SLACKS:
        found = _search(counts, capacity, slack, bound, bins, 0)
        if found:
            best, bins, by = found, sum(n for _, n in found), slack
    found = _search(counts, capacity, by, bound, bins, node_limit)
    return found or best


def packed(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text is an empty one: its only token is the end. Texts of any length
    are read whole and cut, never dropped. Rows of one id are separate documents.
    An empty table gives an empty result; columns other than ``doc_id`` and
    ``text`` are not looked at. Null ids stay null."""
    spark = docs.sparkSession
    pieces = stored(pieces_of(docs, tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"), capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # a row per length, so at most `capacity`
        counts[r["length"]] = r["count"]
    slots, bins, used = [], 0, np.zeros(capacity + 1, np.int64)
    for pattern, times in pack_histogram(counts, capacity):
        offset = 0
        for size in pattern:
            slots.append((size, int(used[size]), int(used[size]) + times, bins, offset))
            used[size] += times
            offset += size
        bins += times
    slots_df = spark.createDataFrame(slots, "s_length long, from_rank long, to_rank long, first_bin long, offset long")

    n_blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(n_blocks)).cast("int"))
    up_to = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (keyed.groupBy("length", "block").agg(F.count("*").alias("n"))
              .select(F.col("length").alias("b_length"), F.col("block").alias("b_block"), F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before")))
    in_block = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (keyed.withColumn("nth", F.row_number().over(in_block))
              .join(before, (F.col("length") == F.col("b_length")) & (F.col("block") == F.col("b_block")))
              .withColumn("rank", F.col("before") + F.col("nth") - 1))
    # the slots are bounded by the capacity alone: patterns of at most that many lengths
    there = (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    return ranked.join(F.broadcast(slots_df), there).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_bin") + F.col("rank") - F.col("from_rank")).alias("sequence_id"), "offset")


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
