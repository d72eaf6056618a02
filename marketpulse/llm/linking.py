"""Components of nodes that share buckets, without pairing whole buckets.

Nodes that share a bucket are candidates for a link. A large group of copies must
not be expanded into all its pairs, so buckets are worked off in rounds: of every
component in a bucket one node is held against one pivot, and every component
has its likeliest pair confirmed. When a round links nothing more, what shared
buckets still hold across components is confirmed, all of it, so no link
between components stays untested.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from marketpulse.llm.common import discard, stored
from marketpulse.llm.components import components

#: Rounds over pivots at most; what they leave is tested pair by pair.
ROUNDS = 2
Of = Callable[[str, str], Column]


def _salted(node: str, key: str, turn: int) -> Column:
    """A number that orders nodes differently in every bucket and round; applied to
    it again, it gives the node back."""
    return F.col(node).bitwiseXOR(F.xxhash64(key, F.lit(turn)))


def with_details(df: DataFrame, details: DataFrame, node: str, name: str) -> DataFrame:
    own = details.select(F.col("node").alias("d_node"), F.struct("*").alias(name))
    return df.join(own, F.col(node) == F.col("d_node")).drop("d_node")


def with_parts(members: DataFrame, parts: DataFrame) -> DataFrame:
    own = parts.select(F.col("node").alias("p_node"), "component")
    return members.join(own, F.col("node") == F.col("p_node"), "left").select("key", "node", F.coalesce("component", "node").alias("part"))


def _untested(pairs: DataFrame, tested: DataFrame, x: str, y: str) -> DataFrame:
    done = tested.select(F.col("u").alias("t_u"), F.col("v").alias("t_v"))
    return pairs.join(done, (F.least(x, y) == F.col("t_u")) & (F.greatest(x, y) == F.col("t_v")), "left_anti")


def _pivot_pairs(members: DataFrame, details: DataFrame, parts: DataFrame, tested: DataFrame, alike: Of, distance: Of, turn: int) -> DataFrame:
    """Per component its likeliest untested pair (``a``, ``b``) of a node and a pivot
    of another component in the same bucket."""
    reps = with_parts(members, parts).groupBy("key", "part").agg(F.min(_salted("node", "key", turn)).alias("salted"))
    pivots = reps.groupBy("key").agg(F.min("salted").alias("salted"), F.count("*").alias("n")).where("n > 1").select(
        F.col("key").alias("p_key"), _salted("salted", "key", turn).alias("pivot"))
    # the pivot of a bucket is a node of each component's row but its own
    pairs = (reps.join(pivots, F.col("key") == F.col("p_key")).select(_salted("salted", "key", turn).alias("node"), "pivot", "part")
             .where("node <> pivot").distinct())
    pairs = _untested(pairs, tested, "node", "pivot")
    pairs = with_details(with_details(pairs, details, "node", "a"), details, "pivot", "b").where(alike("a", "b"))
    best = pairs.groupBy("part").agg(F.min_by(F.struct("a", "b"), F.struct(distance("a", "b"), "node", "pivot")).alias("pair"))
    return best.select("pair.*")


def pairs_across(own: DataFrame, details: DataFrame, tested: DataFrame, alike: Of, unless: str | None = None) -> DataFrame:
    """All alike, untested pairs (``a``, ``b``) in a bucket of ``own`` (``key, node,
    part``) that lie in different parts, and don't agree in the column ``unless``."""
    own = with_details(own, details, "node", "a")
    other = own.select(F.col("key").alias("o_key"), F.col("part").alias("o_part"), F.col("a").alias("b"), *([F.col(unless).alias("o_unless")] if unless else []))
    differ = (F.col("part") < F.col("o_part")) & (F.col(unless) != F.col("o_unless") if unless else F.lit(True))
    pairs = own.join(other, (F.col("key") == F.col("o_key")) & differ & alike("a", "b"))
    return _untested(pairs.select("a", "b").dropDuplicates(), tested, "a.node", "b.node")


def with_partner(members: DataFrame, details: DataFrame, alike: Of) -> DataFrame:
    """The rows of ``members`` whose node is alike another one of the bucket."""
    own = with_details(members, details, "node", "a").select("key", "a")
    other = own.select(F.col("key").alias("o_key"), F.col("a").alias("b"))
    near = (F.col("key") == F.col("o_key")) & (F.col("a.node") != F.col("b.node")) & alike("a", "b")
    return own.join(other, near, "left_semi").select("key", "a.node")


def linked_components(members: DataFrame, details: DataFrame, alike: Of, distance: Of, confirm: Callable[[DataFrame], DataFrame],
                      confirm_across: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """``node, component`` (the smallest node) of the nodes that have a link.

    ``members``: ``key, node``, a row for each bucket of a node. ``details``: a row
    per ``node`` with the columns that ``alike`` and ``distance`` of two such rows
    (names of struct columns) look at; a pair that isn't alike has no link, and pairs
    of smaller distance are confirmed first. ``confirm`` takes pairs (``a``, ``b``)
    and returns the linked ones as ``u, v``.

    What the rounds leave goes to ``confirm_across``: it takes members with their
    component (``key, node, part``) and the pairs tested so far (``u, v``), and returns
    the links between different parts of a bucket, stored. By default these pairs are listed and confirmed."""
    spark = members.sparkSession
    parts = spark.createDataFrame([], "node long, component long")
    tested = links = spark.createDataFrame([], "u long, v long")
    used = []
    for turn in range(ROUNDS):
        pairs = stored(_pivot_pairs(members, details, parts, tested, alike, distance, turn), "pairs")
        found = stored(confirm(pairs), "links")
        used += [pairs, found]
        tested = tested.unionByName(pairs.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct())
        links = links.unionByName(found)
        if found.isEmpty():
            break
        used.append(parts)
        parts = components(links)
    own = with_parts(members, parts)
    mixed = own.groupBy("key").agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first < last").select("key")
    own = stored(own.join(mixed, "key"), "mixed")
    rest = confirm_across(own, tested) if confirm_across else stored(confirm(pairs_across(own, details, tested, alike)), "links")
    if not rest.isEmpty():
        used.append(parts)
        parts = components(links.unionByName(rest))
    discard(own, rest, *used)
    return parts
