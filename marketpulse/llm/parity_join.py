"""Jaccard join on word shingles by parity sketches.

Every shingle of a document's set is XORed into one word of a bit sketch. What two
sets share cancels, so the number of words in which two sketches differ, and of bits in
which their parities differ, never exceeds the size of the sets' symmetric difference.
That size is bounded by the similarity asked for, so of more words than the bound at
least one agrees (pigeonhole): words are the join keys. A scheme of words exists for
each band of set sizes, and one for pairs on either side of an edge between bands.
Candidates pass the parity bound and are verified on their full sets.

Words without a shingle say nothing and are no keys. A scheme has some words to spare
for them; a set that leaves more words empty is sketched anew with another seed as
well, until one seed does. Of a pair, the one that is done first has at least one
word in common with the other that isn't empty, so no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import discard, stored, table
from marketpulse.llm.components import components
from marketpulse.llm.linking import pairs_across, with_details, with_parts
from marketpulse.llm.near_dedup import WordHashes, confirmed, full_sets, links_in_cells, shingle_set

WIDTH, PERCENT = 4, 85
#: Each band's sizes reach up to about so many times its least
BAND = 2
#: Least bits of the parity that candidates are held against; large sets have half as many as shingles or more,
#: so that unlike sets differ in more bits than the bound
PARITY_BITS = 256
#: Similarities for which the sizes of a band leave more shingles than words
PERCENTS = range(80, 101)

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, parity array<long>"


def most_apart(both: int, percent: int) -> int:
    """The largest symmetric difference of linked sets whose sizes sum to ``both``."""
    return both * (100 - percent) // (100 + percent)


def _words(apart: int, least: int) -> tuple[int, int]:
    """Words of a scheme for sets of ``least`` shingles or more that are up to
    ``apart`` apart, and how many of them may stay empty."""
    spare = 0
    for _ in range(20 if apart else 0):
        empty = (apart + 1 + spare) * math.exp(-least / (apart + 1 + spare))
        spare = min(math.ceil(empty + 2 * empty ** 0.5), least - apart - 1)
    return apart + 1 + spare, spare


@lru_cache(maxsize=1 << 16)
def schemes(n: int, percent: int) -> list[tuple[int, int, int]]:
    """Of a set of ``n`` shingles: (number, words, words that may stay empty) of its
    band's scheme and of those for the edges that lie within reach of its size."""
    edges = [1]
    while edges[-1] * percent <= n * 100:
        edges.append(max(edges[-1] + 1, edges[-1] * BAND))
    found = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        if low <= n < high:
            found.append((2 * i, *_words(most_apart(2 * (high - 1), percent), low)))
        least, most = -(-high * percent // 100), (high - 1) * 100 // percent
        if least <= n <= most:  # pairs of fewer than ``high`` shingles with as many or more
            found.append((2 * i + 1, *_words(most_apart(high - 1 + most, percent), least)))
    return found


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch_words(shingles: np.ndarray, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a set's sketch that hold a shingle, and their XORs."""
    own = np.sort(_mixed(shingles, seed))
    at = ((own >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first], np.bitwise_xor.reduceat(own, first)


def join_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Signed 64-bit keys of a non-empty set; linked sets share one at least."""
    out = []
    for number, words, spare in schemes(len(shingles), percent):
        seed = 0
        while True:
            at, parity = sketch_words(shingles, words, seed)
            out.append(_mixed(parity ^ _mixed(at, 2 * number), 2 * seed + 1))
            if words - len(at) <= spare:
                break
            seed += 1
    return np.concatenate(out).view(np.int64)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit, as signed 64-bit numbers.
    A power of two of them; XORing the halves gives the parity of half as many bits."""
    bits = max(PARITY_BITS, (1 << (len(shingles) - 1).bit_length()) >> 1)
    odd = np.bincount((_mixed(shingles, 0) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per document its set's size, digest, join keys and parity."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
        names = [f.split()[0] for f in SIGNED.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    found = shingle_set(text, width, hashes)
                    if len(found):
                        d1, d2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                        rows.append((doc_id, len(found), int(d1), int(d2), join_keys(found, percent), parity_bits(found)))
                    else:
                        rows.append((doc_id, 0, 0, 0, [], []))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED)


def _bits_apart(a: str, b: str) -> Column:
    """Bits in which two parities differ; of linked sets one has at most twice as many as the other."""
    x, y = F.col(f"{a}.parity"), F.col(f"{b}.parity")
    size = F.least(F.size(x), F.size(y))

    def folded(z: Column) -> Column:
        halves = F.zip_with(F.slice(z, F.lit(1), size), F.slice(z, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(z) > size, halves).otherwise(z)

    differ = F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(differ, F.lit(0), lambda n, d: n + d)


def _alike(a: str, b: str, percent: int) -> Column:
    """What every linked pair fulfils: sizes near each other, and parities no further
    apart than the symmetric difference may be."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (_bits_apart(a, b) * (100 + percent) <= (n_a + n_b) * (100 - percent))


def _starred(members: DataFrame, details: DataFrame, alike) -> DataFrame:
    """Of every node that is alike the first one of a bucket, the likeliest such pair (``a``, ``b``)."""
    firsts = members.groupBy(F.col("key").alias("f_key")).agg(F.min("node").alias("first"))
    pairs = members.join(firsts, F.col("key") == F.col("f_key")).where("node <> first").select("node", "first").distinct()
    pairs = with_details(with_details(pairs, details, "node", "a"), details, "first", "b").where(alike("a", "b"))
    best = pairs.groupBy("node").agg(F.min_by(F.struct("a", "b"), F.struct(_bits_apart("a", "b"), "first")).alias("pair"))
    return best.select("pair.*")


def linked_sets(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``, the smallest id
    reachable over links between shingle sets of Jaccard similarity ``percent`` or more.

    Null, empty and blank texts have no shingles and are linked with nothing; texts of
    fewer than ``width`` words are one shingle. A row without an id takes no part: its
    component is null. Of rows that repeat an id, each follows its own text's links. An
    empty table gives an empty result; columns other than ``doc_id`` and ``text`` aren't
    looked at. The join is exact but for collisions of 64-bit hashes. Equal sets are one
    node, keys that one node alone has are dropped, and a large group is linked by
    stars before what still lies across components is confirmed, all of it."""
    if percent not in PERCENTS:
        raise ValueError("similarities of 80 to 100 per cent")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = stored(signed(docs, width, percent), "sketches")
    rows = stored(sketched.select("doc_id", "n_shingles", "d1", "d2"), "rows")
    # keys and parities are moved once, and of copies that a task reads only one
    sets_of = sketched.where("doc_id is not null and n_shingles > 0").groupBy("d1", "d2").agg(
        F.min_by(F.struct(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "keys", "parity"), "doc_id").alias("first"))
    nodes = stored(sets_of.select("first.*", "d1", "d2"), "nodes")
    discard(sketched)
    entries = nodes.select(F.explode("keys").alias("key"), "node")
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(entries.join(shared, "key"), "members")
    details = stored(nodes.drop("keys", "d2").join(members.select("node").distinct(), "node", "left_semi"), "paired")
    ids = stored(nodes.select("node", "d1", "d2"), "node-ids")
    discard(nodes)

    def alike(a: str, b: str) -> Column:
        return _alike(a, b, percent)

    # as many as there are near copies in the corpus: not to be broadcast at any size
    wanted = details.select(F.col("node").alias("w")).distinct().hint("merge")
    sets = stored(full_sets(docs.join(wanted, F.col("doc_id") == F.col("w"), "left_semi"), width), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, sets, percent)

    # round by stars: what is alike hangs together afterwards, and most of what is linked
    pairs = stored(_starred(members, details, alike), "pairs")
    links = stored(confirm(pairs), "links")
    parts = components(links)
    # then all that buckets still hold across parts: within a cluster in cells, else pair by pair
    own = with_parts(members, parts)
    mixed = own.groupBy(F.col("key").alias("m_key")).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("m_key")
    own_members = stored(own.join(mixed, F.col("key") == F.col("m_key")).drop("m_key"), "mixed-members")
    tested = pairs.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()
    clusters = stored(components(tested), "clusters")
    lone = own_members.join(clusters.select(F.col("node").alias("c_node"), "component"), F.col("node") == F.col("c_node"), "left")
    lone = lone.select("key", "node", "part", F.coalesce("component", "node").alias("cluster"))
    across = stored(pairs_across(lone, details, tested, alike, unless="cluster"), "pairs")
    rest = stored(links_in_cells(own_members, clusters, sets, percent).unionByName(confirm(across)), "links")
    final = parts if rest.isEmpty() else components(links.unionByName(rest))
    own = ids.join(final.withColumnRenamed("node", "p_node"), F.col("node") == F.col("p_node"), "left").select(
        F.col("d1").alias("n_d1"), F.col("d2").alias("n_d2"), F.coalesce("component", "node").alias("component"))
    own = stored(own, "components")
    discard(ids, members, details, sets, pairs, links, parts, own_members, clusters, across, rest, final)
    return (rows.join(own, (F.col("d1") == F.col("n_d1")) & (F.col("d2") == F.col("n_d2")) & (F.col("n_shingles") > 0), "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def op12_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_sets(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS shingles FROM w),
e AS (SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS shingle FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, r.seen FROM r JOIN l ON l.u = r.node),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id FROM s JOIN c ON c.node = doc_id
"""
