"""Latest-state operators over tick history.

All are single aggregations keyed by coin: Spark runs a partial aggregate
on every input partition (map-side combine), so each coin crosses the shuffle
as one row per partition however many ticks it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.labels import change_label, display_name, price_label, trend, volume_label
from marketpulse.schemas import TICK_VALUE_COLUMNS


def order_key(df: DataFrame, ts: str = "timestamp", seq: str | None = "seq") -> F.Column:
    """Time order with null times last (they sort after every instant), then
    the ingest sequence as the tie-break, when ``df`` has one."""
    parts = [F.col(ts).isNull(), F.col(ts)]
    if seq is not None and seq in df.columns:
        parts.append(F.col(seq))
    return F.struct(*parts)


def latest_by_coin(df: DataFrame, key: str = "id", ts: str = "timestamp", seq: str | None = "seq",
                   values: list[str] | None = None) -> DataFrame:
    """A3: per coin, the last non-null value of *each column separately*.

    A row with a null time sorts last and therefore wins; null keys are dropped.
    The time column itself reports its last non-null value (the latest instant)."""
    values = values if values is not None else [c for c in TICK_VALUE_COLUMNS if c in df.columns]
    ok = order_key(df, ts, seq)
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ok)).alias(c) for c in values]
    aggs.append(F.max(ts).alias(ts))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def last_volume(df: DataFrame, key: str = "id", ts: str = "timestamp", seq: str | None = "seq") -> DataFrame:
    """A4: volume of the last *row* per coin (a null there stays null), with label."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(F.max_by("total_volume", order_key(df, ts, seq)).alias("total_volume")))
    return out.withColumn("volume_label", volume_label("total_volume"))


def partials(df: DataFrame, key: str = "id", ts: str = "timestamp", seq: str | None = "seq",
             values: list[str] | None = None) -> DataFrame:
    """A3, A4, A6 and A7 in mergeable form: per coin each column's last non-null value
    with its place in the order (``<column>_at``), the last row's volume, the latest
    instant and the number of ticks.  Written with every batch, these few rows stand
    for the batch's ticks; ``from_partials`` merges any number of them."""
    values = values if values is not None else [c for c in TICK_VALUE_COLUMNS if c in df.columns]
    at = F.struct(F.col(ts).isNull().alias("late"), F.col(ts).alias("ts"), (F.col(seq) if seq in df.columns else F.lit(None).cast("long")).alias("seq"))
    aggs = [x for c in values for x in (F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c), F.max(F.when(F.col(c).isNotNull(), at)).alias(f"{c}_at"))]
    aggs += [F.max_by("total_volume", at).alias("last_volume"), F.max(at).alias("last_at"), F.max(ts).alias("last_tick"), F.count(F.lit(1)).alias("n_ticks")]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def from_partials(parts: DataFrame, key: str = "id", ts: str = "timestamp") -> DataFrame:
    """Per coin what ``latest_by_coin`` gives (A3), ``last_volume`` (A4) and ``n_ticks``
    (A7), from ``partials`` of all its ticks; raw ticks aren't read.  The largest ``timestamp``
    is A6."""
    values = [c.removesuffix("_at") for c in parts.columns if c.endswith("_at") and c != "last_at"]
    return parts.groupBy(key).agg(*[F.max_by(c, f"{c}_at").alias(c) for c in values], F.max("last_tick").alias(ts),
                                  F.max_by("last_volume", "last_at").alias("last_volume"), F.sum("n_ticks").alias("n_ticks"))


def coins(df: DataFrame, key: str = "id") -> DataFrame:
    """A5: distinct coins (nulls dropped)."""
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def freshness(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The latest instant in the history (one row)."""
    return df.agg(F.max(ts).alias("last_updated"))


def tick_counts(df: DataFrame, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_ticks"))


def at_least(df: DataFrame, n: int = 2, key: str = "id") -> DataFrame:
    """Keep the ticks of coins that have at least ``n`` rows (HAVING + semi join).

    The count side is one row per coin after a map-side combine, so AQE turns the
    join into a broadcast once it has seen its size; beyond the planner's limit it
    stays a shuffle join whose hot coins AQE splits.  Nothing runs before the plan does."""
    return df.join(tick_counts(df, key).where(F.col("n_ticks") >= n).select(key), on=key, how="left_semi")


def market_share(df: DataFrame, key: str = "id", ts: str = "timestamp", seq: str | None = "seq") -> DataFrame:
    """A10: market-cap share of each coin from its latest snapshot.

    Null caps are left out; when every cap is zero the share is null.  The total
    is a one-row aggregate that every coin's row is paired with (a cross join with
    one row, written as a join on a constant), so no task sees the per-coin table."""
    snap = latest_by_coin(df, key, ts, seq, values=["market_cap"]).where(F.col("market_cap").isNotNull())
    total = snap.agg(F.sum("market_cap").alias("total_cap")).withColumn("_one", F.lit(1))
    return (snap.withColumn("_one", F.lit(1))
            .join(F.broadcast(total), on="_one")
            .select(key, "market_cap",
                    F.try_divide(F.col("market_cap").cast("double"), F.col("total_cap").cast("double")).alias("share")))


def change_board(df: DataFrame, key: str = "id", ts: str = "timestamp", seq: str | None = "seq") -> DataFrame:
    """Latest 24 h change per coin with trend flag and label."""
    snap = latest_by_coin(df, key, ts, seq, values=["price_change_pct_24h"])
    c = F.col("price_change_pct_24h")
    return snap.select(key, display_name(key).alias("name"), c.alias("change"), trend(c).alias("trend"),
                       change_label(c).alias("change_label"))


def for_coin(df: DataFrame, coin: str, key: str = "id") -> DataFrame:
    """One coin's rows (an equality filter, pushed down to the scan)."""
    return df.where(F.col(key) == F.lit(coin))


def labels(df: DataFrame, price: str = "current_price", change: str = "price_change_pct_24h",
           volume: str = "total_volume", key: str = "id") -> DataFrame:
    """P10 + P11: display labels for whichever of the columns are present."""
    cols = {}
    if key in df.columns:
        cols["name"] = display_name(key)
    if price in df.columns:
        cols["price_label"] = price_label(price)
    if change in df.columns:
        cols["change_label"] = change_label(change)
    if volume in df.columns:
        cols["volume_label"] = volume_label(volume)
    return df.withColumns(cols)
