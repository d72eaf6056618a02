"""Hard negatives for embeddings by anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster, every candidate row has an upper
bound on its inner product with any member of unit length: its norm times the cosine of
its angle to the centre less the cluster's radius. Candidates are sorted by that bound
once a cluster, and every member walks the shared list until the next bound, times its
own norm, is below what it still needs; from there on no row can change its result,
which is thereby certified exact.

Rows and anchors meet in a grid of blocks of bounded size, so no task holds more than one
block of each. A first pass finds every anchor's positives; the second starts with the
scores that they ask for and walks only as far as a negative may lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketpulse.llm.common import discard, stored, table

#: Rows and anchors in a block of the grid, on average
ROWS, ANCHORS = 8192, 8192
#: Centres are fitted on so many anchors at most (those of the least id hashes); all are assigned
SAMPLE, CENTRES, ROUNDS = 4096, 64, 8
#: Rows of a list that are walked at once at first; the step doubles
STEP, LARGEST = 64, 1024
#: Positives of an anchor, and negatives of a positive
POSITIVES, NEGATIVES = 5, 5
#: Percentages of the positive's score between which a negative's lies
LEAST, MOST = 80, 100
#: Relative slack of the bounds, which are computed in floating point
SLACK = 1e-9


def _matrix(vectors: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, len(flat) // n) if n else np.empty((0, 0), np.int64)


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and vectors of length one; a zero vector stays zero."""
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    return norms, vectors / np.where(norms > 0, norms, 1)[:, None]


def fitted_centres(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means with as many centres as the root of the sample, from evenly spaced rows."""
    _, units = _units(vectors)
    centres = units[np.linspace(0, len(units) - 1, min(CENTRES, int(len(units) ** 0.5) + 1)).astype(int)]
    for _ in range(ROUNDS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        norms, directions = _units(sums)
        centres = np.where(norms[:, None] > 0, directions, centres)
    return centres


def shared_list(rows: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in descending order of their bound for members of length one, and the bounds."""
    norms, units = _units(rows)
    lengths, directions = _units(members)
    _, centre = _units(directions.sum(axis=0, keepdims=True))
    radius = np.arccos(np.clip(directions[lengths > 0] @ centre[0], -1, 1)).max(initial=0)
    apart = np.arccos(np.clip(units @ centre[0], -1, 1))
    bounds = norms * np.cos(np.clip(apart - radius, 0, np.pi)) + norms * SLACK
    order = np.argsort(-bounds, kind="stable")
    return order, bounds[order]


def _products(members: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while no sum can leave 53 bits."""
    largest = int(max(np.abs(members).max(initial=0), 1)) * int(max(np.abs(rows).max(initial=0), 1)) * max(1, members.shape[1])
    if largest < 1 << 53:
        return (members.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return members @ rows.T if largest < 1 << 63 else members.astype(object) @ rows.T.astype(object)


def walk(members: np.ndarray, rows: np.ndarray, take: Callable[[np.ndarray, np.ndarray, np.ndarray], None], needed: Callable[[], np.ndarray]) -> int:
    """Members walk the shared list of ``rows``: ``take`` gets the members at work, rows
    and their scores; ``needed`` is the least score that can still change each member's
    result. Ends when every next bound is below it. Returns the products made."""
    order, bounds = shared_list(rows, members)
    lengths, _ = _units(members)
    at, step, made = 0, STEP, 0
    while at < len(order):
        reach = lengths * bounds[at]
        active = np.flatnonzero(reach + np.abs(reach) * SLACK + SLACK >= needed())
        if not len(active):
            break
        some = order[at:at + step]
        take(active, some, _products(members[active], rows[some]))
        made += len(active) * len(some)
        at, step = at + step, min(step * 2, LARGEST)
    return made


class Best:
    """Per member its ``k`` best rows so far: higher scores first, ties by place."""

    def __init__(self, members: int, k: int, n_rows: int):
        self.k, self.span = k, n_rows
        self.keys = np.full((members, k), None, object)
        self.least = np.full(members, -np.inf)

    def add(self, members: np.ndarray, places: np.ndarray, scores: np.ndarray, eligible: np.ndarray) -> None:
        better = eligible & (scores >= self.least[members][:, None])
        for i in np.flatnonzero(better.any(axis=1)):
            there = np.flatnonzero(better[i])
            m = members[i]
            found = [x for x in self.keys[m] if x is not None]
            found += [(-int(scores[i, j]), int(places[j])) for j in there[np.lexsort((places[there], -scores[i, there]))[:self.k]]]
            found = sorted(found)[:self.k]
            self.keys[m, :len(found)] = found
            if len(found) == self.k:
                self.least[m] = -found[-1][0]

    def of(self, member: int) -> list[tuple[int, int]]:
        """(place, score) of the member's rows, best first."""
        return [(place, -score) for score, place in (x for x in self.keys[member] if x is not None)]


def _by(*keys: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of the rows of each combination of the keys' values."""
    if len(keys[0]):
        order = np.lexsort(keys)
        differ = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0) if len(order) > 1 else np.empty(0, bool)
        yield from np.split(order, np.flatnonzero(differ) + 1)


def _sides(rows: pa.Table, anchors: pa.Table) -> tuple:
    """Ids, labels and vectors of a block's rows, in order of their ids, and of its anchors."""
    rows = rows.take(pa.array(np.argsort(rows["vec_id"].to_numpy(), kind="stable")))
    return tuple(x for side in (rows, anchors) for x in (side["vec_id"].to_numpy(), side["label"].to_numpy(), _matrix(side["v"], side.num_rows)))


def positives_in_block(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    """Of every anchor the best other rows of its label among the block's."""
    out: list[tuple[int, int, int]] = []
    if rows.num_rows and anchors.num_rows:
        ids, labels, vectors, a_ids, a_labels, a_vectors = _sides(rows, anchors)
        for own in _by(a_labels, anchors["cluster"].to_numpy()):
            same = np.flatnonzero(labels == a_labels[own[0]])
            best = Best(len(own), k, len(ids))
            walk(a_vectors[own], vectors[same], lambda who, some, scores: best.add(who, same[some], scores, ids[same[some]][None] != a_ids[own[who]][:, None]),
                 lambda: best.least)
            out += [(int(a_ids[a]), int(ids[place]), score) for m, a in enumerate(own) for place, score in best.of(m)]
    return pa.table({n: pa.array([x[i] for x in out], pa.int64()) for i, n in enumerate(("anchor_id", "positive_id", "positive_score"))})


def negatives_in_block(rows: pa.Table, anchors: pa.Table, k: int, least: int, most: int) -> pa.Table:
    """Of every score that an anchor's positives have, the best rows of other labels
    among the block's whose score lies between ``least`` and ``most`` per cent of it."""
    out: list[tuple[int, int, int, int]] = []
    if rows.num_rows and anchors.num_rows:
        ids, labels, vectors, a_ids, a_labels, a_vectors = _sides(rows, anchors)
        wanted = [sorted(set(x), reverse=True) for x in anchors["scores"].to_pylist()]
        for own in _by(anchors["cluster"].to_numpy()):
            turns = range(max(len(wanted[a]) for a in own))
            # from, to: the scores that count for each member and turn; where there is none, no score reaches
            spans = [[(-(-least * s // 100), most * s // 100) for s in wanted[a]] for a in own]
            low, high = (np.array([[float(x[t][end]) if t < len(x) and x[t][0] <= x[t][1] else np.inf for t in turns] for x in spans]) for end in (0, 1))
            best = [Best(len(own), k, len(ids)) for _ in turns]

            def take(who: np.ndarray, some: np.ndarray, scores: np.ndarray) -> None:
                other = labels[some][None] != a_labels[own[who]][:, None]
                for t in turns:
                    best[t].add(who, some, scores, other & (scores >= low[who, t][:, None]) & (scores <= high[who, t][:, None]))

            walk(a_vectors[own], vectors, take, lambda: np.min([np.maximum(low[:, t], best[t].least) for t in turns], axis=0))
            out += [(int(a_ids[a]), wanted[a][t], int(ids[place]), score)
                    for m, a in enumerate(own) for t in range(len(wanted[a])) for place, score in best[t].of(m)]
    return pa.table({n: pa.array([x[i] for x in out], pa.int64()) for i, n in enumerate(("n_anchor", "n_score", "negative_id", "negative_score"))})


def prepared(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v`` (whole numbers) of the rows that take part: those with an
    id, a label and a vector of finite numbers. Of rows that repeat an id, the one of
    the least label and vector counts."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    whole = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(label.alias("label"), v.alias("v")).alias("row")).groupBy("vec_id").agg(
        F.min("row").alias("row")).select("vec_id", "row.*")


def with_clusters(anchors: DataFrame) -> DataFrame:
    """Anchors with the nearest of the centres of their dimension as ``cluster``. The
    centres are fitted on a sample of at most ``SAMPLE`` anchors."""
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row.v), []).append(row.v)
    centres = {size: fitted_centres(np.array(vs, np.int64)) for size, vs in by_size.items() if size}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch["v"].to_pylist():
                own = centres.get(len(v))
                found.append(0 if own is None else int((own @ np.array(v, np.float64)).argmax()))
            yield batch.append_column("cluster", pa.array(found, pa.int32()))

    return anchors.mapInArrow(assign, "vec_id long, label int, v array<long>, cluster int")


def _dealt(anchors: DataFrame) -> tuple[Column, int]:
    """Blocks of about ``ANCHORS`` anchors, of one cluster or of several small ones."""
    first, parts, block, room = {}, {}, 0, ANCHORS
    for cluster, n in sorted((r.cluster, r.n) for r in anchors.groupBy("cluster").agg(F.count("*").alias("n")).collect()):  # CENTRES at most
        if n > room and room < ANCHORS:
            block, room = block + 1, ANCHORS
        first[cluster], parts[cluster] = block, max(1, -(-n // ANCHORS))
        room -= n
        if room <= 0:
            block, room = block + parts[cluster], ANCHORS
    if not first:
        return F.lit(0), 1
    of = {name: F.create_map(*[F.lit(x) for pair in values.items() for x in pair]) for name, values in (("first", first), ("parts", parts))}
    salt = F.pmod(F.xxhash64("vec_id"), F.element_at(of["parts"], F.col("cluster")))
    return (F.element_at(of["first"], F.col("cluster")) + salt).cast("int"), max(first[c] + parts[c] for c in first)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least: int = LEAST, most: int = MOST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows``: ``vec_id, label, v`` with unique ids, vectors of whole numbers (of any
    dimension; only those of the same are compared). ``anchor`` says which are anchors.
    Scores are integer inner products, which must fit in 64 bits; higher ones come
    first, ties by smaller id. An anchor's positives are its best other rows of its
    label. Each gets the best rows of other labels whose score lies between ``least`` and
    ``most`` per cent of its own. All rows are candidates: the lists are exact, the
    clusters only decide how early a walk ends. An empty table gives an empty result."""
    rows = stored(rows, "vectors")
    anchors = stored(with_clusters(rows.where(anchor)), "anchors")
    n_rows = rows.count()
    n_blocks = max(1, -(-n_rows // ROWS))
    in_block, n_anchor_blocks = _dealt(anchors)
    dealt_rows = rows.withColumn("i", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")).select(
        "i", F.explode(F.sequence(F.lit(0), F.lit(n_anchor_blocks - 1))).alias("a"), F.size("v").alias("dim"), "vec_id", "label", "v")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("i")

    def met(side: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        dealt = side.withColumn("a", in_block).select("a", blocks, F.size("v").alias("dim"), *side.columns)
        return dealt_rows.groupBy("i", "a", "dim").cogroup(dealt.groupBy("i", "a", "dim")).applyInArrow(work, schema)

    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    found = met(anchors, lambda x, y: positives_in_block(x, y, positives), "anchor_id long, positive_id long, positive_score long")
    chosen = stored(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives).drop("nth"), "positives")
    scores = chosen.groupBy(F.col("anchor_id").alias("s_id")).agg(F.collect_set("positive_score").alias("scores"))
    asking = stored(anchors.join(scores, F.col("vec_id") == F.col("s_id")).drop("s_id"), "asking")
    near = met(asking, lambda x, y: negatives_in_block(x, y, negatives, least, most), "n_anchor long, n_score long, negative_id long, negative_score long")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("n_anchor", "n_score").orderBy(F.col("negative_score").desc(), "negative_id")))
    kept = stored(ranked.where(F.col("rank") <= negatives), "negatives")
    discard(rows, anchors, asking)
    return chosen.join(kept, (F.col("anchor_id") == F.col("n_anchor")) & (F.col("positive_score") == F.col("n_score"))).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(prepared(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label, list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)])::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
