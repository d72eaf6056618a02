"""Subscriptions as an append-only command log folded to current state
(K4, K5), with form normalisation, validation and lookups (P6-P8, S7, S8).

One live row per (email, coin): an upsert replaces threshold and direction and
keeps ``created_at``; a delete removes the row; an upsert after a delete
creates a new row with a new ``created_at``.  The fold is two hash
aggregations (map-side combined) and one key join, so it never needs the log
in order on one machine.  Keys compare null-safely throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketpulse.functions.labels import (DEFAULT_THRESHOLD, MAX_THRESHOLD, MIN_THRESHOLD, describe_subscription,
                                          effective_threshold)
from marketpulse.constants import DROP_FORM_LABEL
from marketpulse.functions.time import epoch_micros
from marketpulse.schemas import SUBSCRIPTION, SUBSCRIPTION_COMMAND
from marketpulse.session import file_system
from marketpulse.sources.codec import read_or_empty

KEY = ["email", "coin"]
#: Day and chunk of commands without a time, after all others
_NO_TIME = (1 << 63) - 1


def _order() -> F.Column:
    """Log order: by time, then sequence; missing ones come last."""
    return F.struct(F.col("ts").isNull(), F.col("ts"), F.col("seq").isNull(), F.col("seq"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> F.Column:
    """Null-safe key equality: a missing email or coin is a key like any other."""
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on


def apply_commands(commands: DataFrame) -> DataFrame:
    """K4/K5: current subscriptions from a log (email, coin, op, threshold,
    direction, ts, seq).

    One aggregation finds each key's last delete, the upserts after it are folded.
    The planner broadcasts the deletes while they are small."""
    deletes = commands.where(F.col("op") == "delete").groupBy(*KEY).agg(F.max(_order()).alias("del_at"))
    upserts = commands.where(F.col("op") == "upsert")
    live = upserts.join(deletes, _same(upserts, deletes, KEY), "left").where(F.col("del_at").isNull() | (_order() > F.col("del_at")))
    return live.select(*[upserts[c] for c in (*KEY, "threshold", "direction", "ts", "seq")]).groupBy(*KEY).agg(
        F.max_by("threshold", _order()).alias("threshold"),
        F.max_by("direction", _order()).alias("direction"),
        F.min("ts").alias("created_at"),
    )


def fold(state: DataFrame, commands: DataFrame) -> DataFrame:
    """``state`` (a row per subscription, as ``apply_commands`` gives it) after further
    commands in the order of ``seq``, which the log gives out: what a full fold gives,
    at the cost of the state and the new commands alone."""
    deletes = commands.where(F.col("op") == "delete").groupBy(*KEY).agg(F.max("seq").alias("del_at"))
    upserts = commands.where(F.col("op") == "upsert").select(*KEY, "threshold", "direction", F.col("ts").alias("created_at"), F.col("seq").alias("_at"))
    before = state.select(*KEY, "threshold", "direction", "created_at", F.lit(None).cast("long").alias("_at"))
    rows = before.unionByName(upserts)
    live = rows.join(deletes, _same(rows, deletes, KEY), "left").where(F.col("del_at").isNull() | F.coalesce(F.col("_at") > F.col("del_at"), F.lit(False)))
    at = F.struct(F.col("_at").isNotNull(), F.col("_at"))
    return live.select(*[rows[c] for c in rows.columns]).groupBy(*KEY).agg(
        F.max_by("threshold", at).alias("threshold"), F.max_by("direction", at).alias("direction"), F.min_by("created_at", at).alias("created_at"))


class SubscriptionLog:
    """A command log (Parquet, appended to; ``seq`` grows) with its state as of a
    position.  ``advance`` writes the state at a position as a table of its own;
    ``as_of`` starts from the last one before the position asked for and reads only
    the commands after it (pushed down to the scan)."""

    def __init__(self, spark: SparkSession, log_path: str, state_path: str):
        self.spark, self.log_path, self.state_path = spark, log_path, state_path

    def commands(self) -> DataFrame:
        return read_or_empty(self.spark, self.log_path, SUBSCRIPTION_COMMAND)

    def position(self) -> int:
        """The last command's sequence number; -1 before the first."""
        return int(self.commands().agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0])

    def _written(self, upto: int) -> int | None:
        fs, cls = file_system(self.spark, self.state_path)
        done = [int(f.getPath().getParent().getName().split("=")[1]) for f in fs.globStatus(cls(f"{self.state_path}/upto=*/_SUCCESS")) or []]
        return max((p for p in done if p <= upto), default=None)

    def as_of(self, position: int) -> DataFrame:
        """The subscriptions after all commands up to ``position``."""
        base = self._written(position)
        state = self.spark.createDataFrame([], SUBSCRIPTION) if base is None else self.spark.read.schema(SUBSCRIPTION).parquet(f"{self.state_path}/upto={base}")
        later = self.commands().where(F.col("seq") <= position)
        return fold(state, later if base is None else later.where(F.col("seq") > base))

    def advance(self, keep: int = 2) -> int:
        """Write the state as of now; the last ``keep`` tables stay, for batches that may be replayed."""
        position = self.position()
        if self._written(position) != position:
            self.as_of(position).write.mode("overwrite").parquet(f"{self.state_path}/upto={position}")
        fs, cls = file_system(self.spark, self.state_path)
        for old in sorted(int(f.getPath().getName().split("=")[1]) for f in fs.globStatus(cls(f"{self.state_path}/upto=*")) or [])[:-keep]:
            fs.delete(cls(f"{self.state_path}/upto={old}"), True)
        return position


def with_outcome(commands: DataFrame, chunk_seconds: int = 4, day_seconds: int = 86400) -> DataFrame:
    """Outcome of each command in log order: an upsert is ``updated`` when the
    key's previous command was an upsert, else ``created``; a delete is
    ``deleted`` after an upsert, else ``noop``.  Every command has an outcome:
    missing emails and coins are keys, missing times come last, and a missing
    operation is no upsert.

    The previous command is what counts, so no partition holds a whole key: it is the
    one before inside (key, chunk of ``chunk_seconds``), for a chunk's first command the
    last one of the chunk before within the day, and for a day's first chunk that of the
    day before.  Last commands are taken from the rows as they lie for the step below, so
    the log is read and dealt out once."""
    us = epoch_micros("ts")

    def part_of_time(seconds: int) -> F.Column:
        return F.coalesce(F.floor(us / F.lit(seconds * 1_000_000)), F.lit(_NO_TIME))
    rows = commands.select(F.struct(*KEY).alias("_k"), "op", "ts", "seq",
                           part_of_time(day_seconds).alias("_d"), part_of_time(chunk_seconds).alias("_c"))

    def before(df: DataFrame, op: str, found: str, keys: list[str], *order: F.Column) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        # nothing is computed from the operation below the exchange, so that both readers find the same one
        return df.withColumns({found: F.lag(op).over(w), f"{found}_start": F.lag(F.lit(True)).over(w).isNull(), f"{found}_end": F.lead(F.lit(True)).over(w).isNull()})
    placed = before(rows, "op", "_prev", ["_k", "_d", "_c"], F.col("ts").asc_nulls_last(), F.col("seq").asc_nulls_last())
    chunks = before(placed.where("_prev_end").select("_k", "_d", "_c", F.col("op").alias("_last")), "_last", "_chunk", ["_k", "_d"], F.col("_c"))
    days = before(chunks.where("_chunk_end").select("_k", "_d", "_last"), "_last", "_day", ["_k"], F.col("_d"))
    # the keys are structs: a missing email or coin equals another missing one
    earlier = chunks.join(days.select("_k", "_d", "_day"), ["_k", "_d"]).select("_k", "_d", "_c", F.when(F.col("_chunk_start"), F.col("_day")).otherwise(F.col("_chunk")).alias("_before"))
    after_upsert = F.when(F.col("_prev_start"), F.col("_before")).otherwise(F.col("_prev")).eqNullSafe("upsert")
    outcome = (F.when(F.col("op") == "upsert", F.when(after_upsert, "updated").otherwise("created"))
               .otherwise(F.when(after_upsert, "deleted").otherwise("noop")))
    return placed.join(earlier, ["_k", "_d", "_c"]).select("_k.*", "op", "ts", "seq", outcome.alias("outcome"))


def normalise_command(form: DataFrame) -> DataFrame:
    """Form input (email, coin display name, 'Drops by'/'Rises by', optional
    threshold) to a command row."""
    return form.select(
        F.col("email"),
        F.lower("coin").alias("coin"),
        F.when(F.col("alert_when") == DROP_FORM_LABEL, F.lit("drop")).otherwise(F.lit("rise")).alias("direction"),
        F.coalesce(F.col("threshold"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        *[c for c in form.columns if c not in ("email", "coin", "alert_when", "threshold")],
    )


def valid_email(email) -> F.Column:
    e = F.col(email) if isinstance(email, str) else email
    return e.isNotNull() & (F.length(e) > 0) & (F.instr(e, "@") > 0)


def is_valid(df: DataFrame) -> F.Column:
    """Email non-empty and containing '@'; threshold in [0.1, 50]."""
    t = effective_threshold("threshold")
    return valid_email("email") & t.between(MIN_THRESHOLD, MAX_THRESHOLD)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a reason)."""
    ok = is_valid(df)
    reason = (F.when(~valid_email("email") | F.col("email").isNull(), F.lit("invalid email"))
              .otherwise(F.lit("threshold out of range")))
    return df.where(ok), df.where(~ok | ok.isNull()).withColumn("reason", reason)


def subs_for(subs: DataFrame, coin: str, dirn: str) -> DataFrame:
    """Subscribers of one coin and direction (equality filters pushed to the scan)."""
    return subs.where((F.col("coin") == coin) & (F.col("direction") == dirn))


def subs_for_email(subs: DataFrame, email: str) -> DataFrame:
    """S8 + P8: one address's subscriptions with display text; empty when the
    address is not valid."""
    if not email or "@" not in email:
        return subs.where(F.lit(False)).select("coin", "threshold", "direction",
                                               F.lit(None).cast("string").alias("label"), "email")
    return subs.where(F.col("email") == email).select(
        "coin", "threshold", "direction", describe_subscription("direction", "threshold").alias("label"), "email")


def valid_command(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P6 by its inventory name: (valid rows, rejected rows with a reason)."""
    return split_valid(df)
