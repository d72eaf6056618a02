"""Near-duplicate documents by circulant MinHash.

A document's set holds the hashes of its word shingles. Two permutations of the
hash universe make all coordinates of its signature: the first scatters the set,
the second is applied after a circular shift by 0, 1, 2, ..., and each shift's
smallest value is a coordinate. Documents of equal sets become one node. Nodes that
share a band of coordinates are candidates; links between them are confirmed on
the full sets.
``linking`` sees to it that large groups of copies aren't paired in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import discard, stored, table
from marketpulse.llm.components import components
from marketpulse.llm.linking import linked_components, pairs_across, with_partner

#: Bands of coordinates. Of documents at a similarity of 0.8, 1 - (1 - 0.8**5)**28, all but 1.5 in 100,000, share a band.
ROWS, BANDS = 5, 28
WIDTH, PERCENT = 5, 80
#: Coordinates whose lowest bit is kept, and by how many standard deviations they may fall short of
#: what the similarity makes likely before a pair is not tested (5.5: at the threshold 2 in ten million, by the binomial tail)
SKETCH_BITS, SLACK = 512, 5.5
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: Words whose hash a worker keeps at hand
CACHED = 100_000
#: Sets on either side of a cell, and shingles that a cell looks at in one go
BLOCK, SLICE = 128, 32_768

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, " + ", ".join(f"{s} long" for s in SKETCH)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED:
            self[word] = value
        return value


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words (A-Z in
    lower case); of fewer words, one of all; of none, empty. ``bytes.split`` parts
    words at ASCII white space, ``bytes.lower`` changes A-Z alone."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[i:len(words) - width + 1 + i]
    return np.unique(out)


def _permuted(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, n: int = max(ROWS * BANDS, SKETCH_BITS)) -> np.ndarray:
    """The ``n`` coordinates of a non-empty set."""
    scattered = _permuted((shingles >> np.uint64(32)).astype(np.uint32), 0x21F0AAAD, 0xD35A2D97)
    shifts = np.arange(n, dtype=np.uint32)[:, None]
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), 512):  # so that a block stays in the processor's cache
        np.minimum(least, _permuted(scattered[None, at:at + 512] + shifts, 0x7FEB352D, 0x846CA68B).min(axis=1), out=least)
    return least


def _bands(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least[:ROWS * BANDS].reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + column
    return ((keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[list[list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield [c.to_pylist() for c in batch.slice(at, rows).columns]


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Per document its set's size, digest, band keys and sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for ids, texts in _slices(batches):
            rows = []
            for doc_id, text in zip(ids, texts):
                found = shingle_set(text, width, hashes)
                if not len(found):
                    rows.append((doc_id, 0, 0, 0, [], *[0] * len(SKETCH)))
                    continue
                least = signature(found)
                d1, d2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                sketch = np.packbits((least[:SKETCH_BITS] & np.uint32(1)).astype(np.uint8)).view(np.int64)
                rows.append((doc_id, len(found), int(d1), int(d2), _bands(least), *sketch.tolist()))
            columns = list(zip(*rows))
            types = [pa.int64()] * 4 + [pa.list_(pa.int64())] + [pa.int64()] * len(SKETCH)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in SIGNED.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED)


def with_digest(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, text, d1, d2``, the digest that ``signed`` gives."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for ids, texts in _slices(batches):
            sets = [shingle_set(text, width, hashes) for text in texts]
            pairs = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist() if len(s) else (0, 0) for s in sets]
            columns = (ids, texts, [d for d, _ in pairs], [d for _, d in pairs])
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "text", "d1", "d2"])

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id long, text string, d1 long, d2 long")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, d1, shingles`` (sorted 64-bit hashes as bytes)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for ids, texts in _slices(batches):
            rows = []
            for doc_id, text in zip(ids, texts):
                data = shingle_set(text, width, hashes).tobytes()
                row = (doc_id, int(np.frombuffer(xxhash.xxh3_128_digest(data), np.int64)[0]), data)
                if row[:2] not in seen:  # repeated rows
                    seen.add(row[:2])
                    rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "d1", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(sets, "doc_id long, d1 long, shingles binary")


def _bits_apart(a: str, b: str) -> Column:
    apart = F.lit(0)
    for s in SKETCH:
        apart = apart + F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}")))
    return apart


def _alike(a: str, b: str, percent: int) -> Column:
    """What sets of that similarity must show: sizes near each other, and
    sketches that differ in no more bits than ``SLACK`` allows."""
    off = (1 - percent / 100) / 2
    most = SKETCH_BITS * off + SLACK * (SKETCH_BITS * off * (1 - off)) ** 0.5
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (_bits_apart(a, b) <= int(most))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``: structs of ``node`` and ``d1``) whose full sets are
    similar: 100 * intersection >= percent * union."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for us, vs, xs, ys in _slices(batches, 64):
            keep = []
            for x, y in zip(xs, ys):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([pa.array([u for u, k in zip(us, keep) if k], pa.int64()),
                                              pa.array([v for v, k in zip(vs, keep) if k], pa.int64())], ["u", "v"])

    def with_set(df: DataFrame, end: str) -> DataFrame:
        own = sets.select(F.col("doc_id").alias("o_id"), F.col("d1").alias("o_d1"), F.col("shingles").alias(f"set_{end}"))
        return df.join(own, (F.col(f"{end}.node") == F.col("o_id")) & (F.col(f"{end}.d1") == F.col("o_d1"))).drop("o_id", "o_d1")

    return (with_set(with_set(pairs, "a"), "b").select(F.col("a.node").alias("u"), F.col("b.node").alias("v"), "set_a", "set_b")
            .mapInArrow(similar, "u long, v long"))


def _cell_links(cell: pa.Table, percent: int) -> pa.Table:
    """Links between the two sides of a cell, across parts: all intersections by
    matrix products over slices of the shingles that occur."""
    sets = [np.frombuffer(x, np.uint64) for x in cell["shingles"].to_pylist()]
    node, part, left = (cell[c].to_numpy() for c in ("node", "part", "left_side"))
    left = left.astype(bool)
    sizes = np.array([len(x) for x in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    shared = np.zeros((left.sum(), (~left).sum()), np.float32)
    for first in range(0, int(place[-1]) + 1, SLICE):
        span = slice(*np.searchsorted(place, (first, first + SLICE)))
        there = np.zeros((len(sets), SLICE), np.float32)
        there[row[span], place[span] - first] = 1
        shared += there[left] @ there[~left].T
    union = sizes[left][:, None] + sizes[~left][None] - shared
    x, y = np.nonzero((100 * shared >= percent * union) & (part[left][:, None] != part[~left][None]))
    return pa.table({"u": pa.array(node[left][x], pa.int64()), "v": pa.array(node[~left][y], pa.int64())})


def links_in_cells(own: DataFrame, clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across the parts of each cluster. A cluster's nodes are dealt into blocks
    of about ``BLOCK``; the nodes outside its largest part meet every block, a
    cell at a time, so a task holds two blocks and no pairs are listed."""
    nodes = own.select("node", "part").distinct().join(clusters.select(F.col("node").alias("c_node"), F.col("component").alias("cluster")), F.col("node") == F.col("c_node")).drop("c_node")
    nodes = stored(nodes, "crowds")
    by_part = nodes.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    crowds = by_part.groupBy(F.col("cluster").alias("l_cluster")).agg(
        F.max_by("part", F.struct("n", "part")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"), F.count("*").alias("parts")).where("parts > 1")
    n_all, n_few = F.ceil(F.col("all") / BLOCK).cast("int"), F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int")
    at = F.abs(F.xxhash64("node") % (1 << 31)).cast("int")
    dealt = nodes.join(crowds, F.col("cluster") == F.col("l_cluster")).select(
        "cluster", "node", "part", (at % n_few).alias("few_block"), (at % n_all).alias("block"), n_few.alias("n_few"), n_all.alias("n_all"),
        (F.col("part") != F.col("largest")).alias("few"))
    with_sets = dealt.join(sets.select(F.col("doc_id").alias("o_id"), "shingles"), F.col("node") == F.col("o_id"))
    as_few = F.when(F.col("few"), F.transform(F.sequence(F.lit(0), F.col("n_all") - 1), lambda j: F.struct(F.col("few_block").alias("i"), j.alias("j"), F.lit(1).alias("left_side"))))
    as_one = F.transform(F.sequence(F.lit(0), F.col("n_few") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(0).alias("left_side")))
    cells = with_sets.select("cluster", "node", "part", "shingles", F.inline(F.concat(F.coalesce(as_few, F.array().cast("array<struct<i:int,j:int,left_side:int>>")), as_one)))
    return cells.groupBy("cluster", "i", "j").applyInArrow(lambda cell: _cell_links(cell, percent), "u long, v long")


def near_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, digests: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their shingle sets have a Jaccard similarity of
    ``percent`` or more; ``component_id`` is the smallest id reachable over links,
    and the document of that id is kept. Null, empty and blank texts have no
    shingles and are linked with nothing. A row without an id takes no part: its
    component is null and it is kept. Ids should be unique: of rows that repeat one,
    each follows its own text's links, and texts with the same smallest id count as
    linked. With ``digests`` also ``d1, d2``, the digest of the row's set. An empty table gives an empty result; columns other than ``doc_id`` and
    ``text`` aren't looked at."""
    docs = docs.select("doc_id", "text")
    rows = stored(signed(docs, width), "signatures")
    in_play = rows.where("doc_id is not null and n_shingles > 0")
    nodes = stored(in_play.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(a) for c, a in (("n_shingles", "n"), ("bands", "bands"), *zip(SKETCH, SKETCH))]), "nodes")
    entries = nodes.select(F.explode("bands").alias("key"), "node")
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    details = nodes.drop("bands", "d2")

    def alike(a: str, b: str) -> Column:
        return _alike(a, b, percent)

    entries_shared = stored(entries.join(shared, "key"), "bucket-members")
    members = stored(with_partner(entries_shared, details, alike), "members")
    paired = stored(details.join(members.select("node").distinct(), "node", "left_semi"), "paired")
    # as many as there are near copies in the corpus: not to be broadcast at any size
    wanted = paired.select(F.col("node").alias("w")).distinct().hint("merge")
    sets = stored(full_sets(docs.join(wanted, F.col("doc_id") == F.col("w"), "left_semi"), width), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, sets, percent)

    def confirm_across(own: DataFrame, tested: DataFrame) -> DataFrame:
        clusters = stored(components(tested), "clusters")  # what is alike hangs together, linked or not
        lone = own.join(clusters.select(F.col("node").alias("c_node"), "component"), F.col("node") == F.col("c_node"), "left")
        lone = lone.select("key", "node", "part", F.coalesce("component", "node").alias("cluster"))
        pairs = stored(pairs_across(lone, paired, tested, alike, unless="cluster"), "pairs")
        found = stored(links_in_cells(own, clusters, sets, percent).unionByName(confirm(pairs)), "links")
        discard(clusters, pairs)
        return found

    parts = linked_components(members, paired, alike, _bits_apart, confirm, confirm_across)
    own = nodes.join(parts.withColumnRenamed("node", "p_node"), F.col("node") == F.col("p_node"), "left").select(
        F.col("d1").alias("n_d1"), F.col("d2").alias("n_d2"), F.coalesce("component", "node").alias("component"))
    own = stored(own, "components")
    discard(parts, nodes, entries_shared, members, paired, sets)
    return (rows.join(own, (F.col("d1") == F.col("n_d1")) & (F.col("d2") == F.col("n_d2")) & (F.col("n_shingles") > 0), "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *(["d1", "d2"] if digests else [])))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_components`` keeps. Where an id
    has rows that are kept and others that aren't, they are told apart by their text."""
    found = stored(near_components(docs, width, percent, digests=True).where("doc_id is not null").select("doc_id", "d1", "d2", "kept").distinct(), "kept-sets")
    dropped = found.where("not kept").select(F.col("doc_id").alias("g_id"), F.col("d1").alias("g_d1"), F.col("d2").alias("g_d2"))
    kept = found.where("kept").select(F.col("doc_id").alias("k_id")).distinct()
    mixed = stored(dropped.join(kept, F.col("g_id") == F.col("k_id"), "left_semi"), "mixed-ids")
    rows = docs.join(mixed.select("g_id").distinct(), F.col("doc_id") == F.col("g_id"), "left_semi").select("doc_id", "text")
    apart = (F.col("doc_id") == F.col("g_id")) & (F.col("d1") == F.col("g_d1")) & (F.col("d2") == F.col("g_d2"))
    texts = stored(with_digest(rows, width).join(mixed, apart, "left_semi").select(F.col("doc_id").alias("g_id"), F.col("text").alias("g_text")).distinct(), "mixed-texts")
    whole_ids = dropped.join(kept, F.col("g_id") == F.col("k_id"), "left_anti").select("g_id").distinct()
    gone = whole_ids.withColumn("g_text", F.lit(None).cast("string")).unionByName(texts)
    return docs.join(gone, (F.col("doc_id") == F.col("g_id")) & (F.col("g_text").isNull() | (F.col("g_text") == F.col("text"))), "left_anti")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), width=2)


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words
    ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END) AS shingles FROM w),
e AS (SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS shingle FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT u, v FROM p UNION ALL SELECT v, u FROM p),
r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, r.seen FROM r JOIN l ON l.u = r.node),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON c.node = doc_id
"""
