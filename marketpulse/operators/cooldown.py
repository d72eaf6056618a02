"""Per-coin alert cooldown as a distributed, exact Spark job.

Rule (sequential form): walk a coin's ticks in (time, seq) order; a tick with a
non-null, non-zero change is *kept* when at least ``C`` seconds passed since
the coin's last kept tick, and keeping it restarts the cooldown.  Zero, null
and NaN changes never touch the state, so they are dropped up front.  Of the
ticks of one instant only the first can be kept, so the job works on distinct
instants; redelivered ticks and ticks without a ``seq`` need no more than an
order among equals at the end.

A per-coin fold would put all of a hot coin's ticks through one task.  This
module computes the same set with joins and windows only:

1.  A kept tick ``x`` is followed by ``next(x)``, the coin's first tick at or
    after ``x + C``.  Time is cut into buckets of width ``C``; the probe ``x + C``
    lands in the bucket after ``x``'s, where one running minimum finds the answer,
    or else it is the first tick of the occupied bucket after that.
2.  A tick that comes ``C`` or more after the one before it is kept whatever was
    kept before (a *root*; so is a coin's first tick).  The chain is cut there:
    every root starts a chain of its own, which ends before the next root.
3.  Chains are composed over blocks of buckets, 32 blocks at once: a shuffle by
    (coin, larger block), then five doublings inside it, each a window in which the
    ticks of a left half that lead into the right half find their row there.
    A row is a tick at which a block can be entered, with the ticks kept from
    there on inside the block and the tick that follows beyond it.  Only ticks of a
    block's first bucket, its first tick after that (when what precedes is empty) and
    roots can be entered, so every level has about a 32nd of the rows of the one
    below, and the work is linear.  Rows that nothing enters are gone after a doubling.
4.  The job ends when every root's chain has ended within its block.

No partition holds a whole coin: windows are keyed by (coin, bucket) or (coin,
block), sorted and spilled by Spark, and hold distinct instants only, at most ``C``
in microseconds per bucket whatever the number of rows.  The only per-coin window
runs over one row per occupied bucket (time span / C rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from marketpulse.constants import COOLDOWN_SECONDS
from marketpulse.functions.labels import nan_to_null
from marketpulse.functions.time import epoch_micros
from marketpulse.session import checkpoint_dir

DEFAULT_COOLDOWN_SECONDS = COOLDOWN_SECONDS
# doublings in one shuffle: 32 blocks become one
DOUBLINGS = 5
# added to bucket numbers, so that those before 1970 are shifted like the others
FIRST_BUCKET = 1 << 60


class Scratch:
    """Intermediate tables of one run: folders written to the shared checkpoint
    folder.  ``release()`` deletes them once the result has been consumed."""

    def __init__(self):
        self.paths: list[str] = []

    def release(self) -> None:
        for path in self.paths:
            spark = SparkSession.getActiveSession()
            jvm = spark.sparkContext._jvm
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
        self.paths.clear()


def materialize(df: DataFrame, name: str, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: one job,
    lineage cut, and the scan carries real size statistics for AQE."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if scratch is not None:
        scratch.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def may_alert(change: str) -> F.Column:
    """Ticks that the cooldown looks at: a change that is there and not zero."""
    c = nan_to_null(change)
    return c.isNotNull() & (c != 0)


def tick_order(df: DataFrame, key: str, ts: str, seq: str) -> F.Column:
    """Order among a coin's ticks: by time, then ingest sequence, what is missing
    last; ticks without a sequence at one instant by their other columns."""
    first = [c for c in (ts, seq) if c in df.columns]
    rest = [c for c in df.columns if c not in (key, ts, seq)]
    return F.struct(*[x for i, c in enumerate(first) for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_v{i}"))],
                    *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])


def candidates(df: DataFrame, key: str, ts: str, change: str) -> DataFrame:
    """(key, t) of the instants at which a coin may keep a tick."""
    return (df.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & may_alert(change))
            .select(F.col(key).alias("key"), epoch_micros(ts).alias("t")).distinct())


def _bucket(t: str, cooldown_us: int) -> F.Column:
    return F.expr(f"({t} - pmod({t}, {cooldown_us}L)) div {cooldown_us}L + {FIRST_BUCKET}L")


def _steps(cand: DataFrame, cooldown_us: int) -> DataFrame:
    """Per instant ``x`` of a coin: ``root``, ``prev`` (the instant before it, or
    ``x`` itself where that is in the same bucket) and ``exit``, the instant that
    follows when ``x`` is kept (null when that is a root, or there is none)."""
    C = F.lit(cooldown_us)
    cand = cand.withColumn("k", _bucket("t", cooldown_us))
    over = Window.partitionBy("key").orderBy("k")
    buckets = cand.groupBy("key", "k").agg(F.min("t").alias("first"), F.max("t").alias("last")).select(
        "*", F.lag("last").over(over).alias("earlier"), F.lead("k").over(over).alias("k1"),
        *[F.lead(c, n).over(over).alias(f"{c}{n}") for c, n in (("first", 1), ("last", 1), ("first", 2))])
    # the first tick of the buckets from k + 2 on, and whether it is a root
    adjacent = F.col("k1") == F.col("k") + 1
    later = F.when(adjacent, F.struct(F.col("first2").alias("t"), (F.col("first2") - F.col("last1") >= C).alias("root"))).otherwise(
        F.struct(F.col("first1").alias("t"), (F.col("first1") - F.col("last") >= C).alias("root")))
    placed = cand.join(buckets.select("key", "k", "first", "earlier", later.alias("later")), ["key", "k"])
    prev = F.when(F.col("t") == F.col("first"), F.col("earlier")).otherwise(F.col("t"))
    placed = placed.select("key", "k", "t", prev.alias("prev"), (prev.isNull() | (F.col("t") - prev >= C)).alias("root"), "later")
    both = F.array(F.struct(F.col("k").alias("at"), F.col("t").alias("time"), F.lit(0).alias("probe")),
                   F.struct((F.col("k") + 1).alias("at"), (F.col("t") + C).alias("time"), F.lit(1).alias("probe")))
    rows = placed.select("key", "t", "prev", "root", "later", F.inline(both))
    latest_first = Window.partitionBy("key", "at").orderBy(F.col("time").desc(), "probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.min(F.when(F.col("probe") == 0, F.struct("t", "root"))).over(latest_first)
    after = F.coalesce(F.col("found"), F.when(F.col("later.t").isNotNull(), F.col("later")))
    return rows.withColumn("found", found).where("probe = 1").select(
        "key", F.col("t").alias("x"), "root", "prev", F.when(~after["root"], after["t"]).alias("exit"), F.array("t").alias("path"))


def _composed(rows: DataFrame, first_bit: int, cooldown_us: int) -> DataFrame:
    """Rows of blocks of ``2 ** first_bit`` buckets to rows of blocks 32 times as long."""
    df = rows.withColumn("k", _bucket("x", cooldown_us)).withColumn("k_exit", _bucket("exit", cooldown_us))
    df = df.withColumn("block", F.shiftright("k", first_bit + DOUBLINGS)).repartition("key", "block")
    for bit in range(first_bit, first_bit + DOUBLINGS):
        pair = F.shiftright("k", bit + 1)
        right = F.shiftright("k", bit).bitwiseAND(F.lit(1)) == 1
        goes_on = ~right & F.coalesce(F.shiftright("k_exit", bit + 1) == pair, F.lit(False))
        meets = Window.partitionBy("key", "block", "pair", "meet")
        df = df.withColumns({"pair": pair, "right": right, "goes_on": goes_on, "meet": F.when(goes_on, F.col("exit")).otherwise(F.col("x"))})
        df = df.withColumn("rest", F.first(F.when(F.col("right"), F.struct("exit", "k_exit", "path")), ignorenulls=True).over(meets))
        # of a right half only its first tick, when nothing lies between it and the pair's first bucket, and roots can be entered
        second_bucket = (F.shiftleft("pair", bit + 1) - F.lit(FIRST_BUCKET) + 1) * F.lit(cooldown_us)
        df = df.where(~F.col("right") | F.col("root") | (F.col("prev") < second_bucket))
        df = df.select("key", "block", "k", "x", "root", "prev", *[F.when(F.col("goes_on"), F.col("rest")[c]).otherwise(F.col(c)).alias(c) for c in ("exit", "k_exit")],
                       F.when(F.col("goes_on"), F.concat("path", F.col("rest.path"))).otherwise(F.col("path")).alias("path"))
    return df.select("key", "x", "root", "prev", "exit", "path")


def kept_ticks(cand: DataFrame, cooldown_us: int, scratch: Scratch | None = None) -> DataFrame:
    """(key, t) of the kept instants among candidate instants (key, t)."""
    rows = _steps(materialize(cand, "cooldown-instants", scratch), cooldown_us)
    ended = F.col("root") & F.col("exit").isNull()
    bit, kept = 0, None
    while True:
        open_chains = Observation(f"open chains {bit}")
        level = _composed(rows, bit, cooldown_us).where(ended | F.col("exit").isNotNull() | ~F.col("root"))
        level = level.observe(open_chains, F.count_if(F.col("root") & F.col("exit").isNotNull()).alias("n"))
        level = materialize(level, f"cooldown-level-{bit}", scratch)
        done = level.where(ended).select("key", F.explode("path").alias("t"))
        kept = done if kept is None else kept.unionByName(done)
        if not open_chains.get["n"]:
            return kept
        rows, bit = level.where(~ended), bit + DOUBLINGS


def cooldown(df: DataFrame, seconds: float = DEFAULT_COOLDOWN_SECONDS, key: str = "id", ts: str = "timestamp",
             seq: str = "seq", change: str = "price_change_pct_24h", ready: DataFrame | None = None,
             scratch: Scratch | None = None) -> DataFrame:
    """Ticks of ``df`` that pass the per-coin cooldown (event time), as a
    table written to the shared checkpoint folder.

    ``seq`` is the ingest sequence (e.g. a topic offset) and orders ticks of one
    instant; it may be null or missing (see ``tick_order``).  A redelivered tick is
    skipped like any tick inside the cooldown.  Ticks without a time can't be placed
    in event time and are not kept.

    ``ready`` optionally carries state from earlier input: rows ``(key,
    ready_at)`` with the earliest instant (naive UTC) at which the coin may keep
    a tick again; older ticks of that coin are skipped, so a backfill can go on
    where another one ended.

    Without a ``scratch`` of the caller's, intermediate tables are freed here."""
    if seconds <= 0:
        raise ValueError("a cooldown takes more than 0 seconds")
    own = Scratch() if scratch is None else scratch
    cooldown_us = max(1, int(round(seconds * 1_000_000)))
    cand = candidates(df, key, ts, change)
    if ready is not None:
        r = ready.select(F.col(key).alias("key"), epoch_micros("ready_at").alias("ready_t"))
        cand = cand.join(r, "key", "left").where(F.col("ready_t").isNull() | (F.col("t") >= F.col("ready_t"))) \
            .drop("ready_t")
    kept = kept_ticks(cand, cooldown_us, own)
    # a written table of at most one row per coin-bucket: the planner sees its
    # real size and broadcasts it while it is small
    cooled = materialize(first_of_instants(df.where(may_alert(change)), epoch_micros(ts), kept, key, ts, seq), "cooldown-cooled", scratch)
    if scratch is None:
        own.release()
    return cooled


def first_of_instants(df: DataFrame, at: F.Column, kept: DataFrame, key: str = "id", ts: str = "timestamp", seq: str = "seq") -> DataFrame:
    """The first tick of ``df`` at each kept instant (``key``, ``t`` in microseconds)
    of the clock ``at``."""
    there = (F.col(key) == F.col("_k.key")) & (at == F.col("_k.t"))
    at_instant = df.join(kept.alias("_k"), there, "left_semi").withColumn("_at", at)
    first = F.min_by(F.struct(*df.columns), tick_order(df, key, ts, seq)).alias("_row")
    return at_instant.groupBy(key, "_at").agg(first).select("_row.*")
