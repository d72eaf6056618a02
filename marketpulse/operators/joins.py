"""Join helpers: a broadcast hint only where the planner itself would broadcast."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def within_broadcast_limit(spark: SparkSession, size_bytes: int) -> bool:
    """Whether a table of this (measured) size is under the session's own
    ``spark.sql.autoBroadcastJoinThreshold``.  For derived tables whose size the
    planner can only overestimate; beyond the limit the join stays a shuffle."""
    limit = re.fullmatch(r"(-?\d+)([a-z]*)", spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m").lower())
    return size_bytes <= int(limit[1]) * _UNITS[limit[2]]


def measured_within_limit(df: DataFrame) -> bool:
    """Whether ``df`` is under the session's limit by its measured size. For dictionaries
    (lexicons, topics), of which the planner knows no size."""
    strings = [F.sum(F.octet_length(c)) for c, t in df.dtypes if t == "string"]
    n, *octets = df.agg(F.count(F.lit(1)), *strings).first()
    return within_broadcast_limit(df.sparkSession, 16 * n * (1 + len(df.columns)) + sum(x or 0 for x in octets))


def broadcast_within_limit(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is under the session's limit."""
    return F.broadcast(df) if measured_within_limit(df) else df


def looked_up(dictionary: list[tuple[str, object]], value_type: str):
    """A function from a column of words to their values in ``dictionary``, null where it
    has none. The dictionary is a constant of the plan: an array of small maps, of which
    a word's hash names one, so a look-up takes the same time whatever its size.
    Only for dictionaries under the broadcast limit."""
    spark = SparkSession.getActiveSession()
    places = max(1, len(dictionary))
    hashed = spark.createDataFrame([(w,) for w, _ in dictionary], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(places)).alias("at")).collect()
    at = {r["w"]: r["at"] for r in hashed}
    maps: list[dict] = [{} for _ in range(places)]
    for word, value in dictionary:
        maps[at[word]][word] = value
    constant = F.from_json(F.lit(json.dumps(maps)), f"array<map<string,{value_type}>>")
    return lambda word: F.get(constant, F.pmod(F.xxhash64(word), F.lit(places)).cast("int"))[word]


def one_of_each(column: Column) -> Column:
    """An array's distinct values without null."""
    return F.array_distinct(F.array_compact(column))
