"""Regular time buckets over tick history.

Plan: one hash aggregation to *sparse* buckets (map-side combine, so the
shuffle carries at most one row per coin-bucket per input partition), then
one window pass over the sparse buckets that computes the forward fill and
the next occupied bucket, then a generator that fills the empty buckets in
between.  The window sees one row per occupied bucket, so its per-coin size is
bounded by time span / width (17,520 rows per coin-year at 30 minutes), not by
how many ticks arrived.  No join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.constants import BUCKET_WIDTH, FLAT_RANGE_FRACTION, RANGE_PADDING, SPARKLINE_PADDING
from marketpulse.functions.labels import change_label, display_name, price_label, trend
from marketpulse.functions.time import epoch_micros, from_epoch_micros
from marketpulse.operators.snapshot import for_coin

DEFAULT_WIDTH = BUCKET_WIDTH
_UNITS = {"second": 1, "seconds": 1, "s": 1, "minute": 60, "minutes": 60, "min": 60, "t": 60,
          "hour": 3600, "hours": 3600, "h": 3600, "day": 86400, "days": 86400, "d": 86400}


def width_seconds(width: str | int) -> int:
    """Bucket width in seconds, from seconds, ``"30 minutes"`` or a pandas-style
    ``"30min"``.  Buckets anchor at the epoch, which equals the midnight
    anchoring of the series' first day only for widths dividing 24 h."""
    if isinstance(width, int):
        secs = width
    else:
        m = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", width)
        if not m or m.group(2).lower() not in _UNITS:
            raise ValueError(f"unknown bucket width {width!r}")
        secs = int(m.group(1)) * _UNITS[m.group(2).lower()]
    if secs <= 0 or 86400 % secs:
        raise ValueError(f"bucket width must divide 24 hours, got {width!r}")
    return secs


def _sparse_buckets(df: DataFrame, width_us: int, key: str, ts: str, seq: str | None, values: list[str]) -> DataFrame:
    """Occupied buckets only: last non-null value per column in (time, seq)
    order, plus the row count.  Rows with a null time form a null bucket that
    only contributes to the count."""
    order = F.struct(F.col(ts), F.col(seq)) if seq in df.columns else F.struct(F.col(ts))
    b = F.floor(epoch_micros(ts) / F.lit(width_us)) * F.lit(width_us)
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in values]
    return (df.where(F.col(key).isNotNull())
            .groupBy(F.col(key), b.cast("long").alias("_b")).agg(*aggs, F.count(F.lit(1)).alias("_n")))


# a run of equal buckets is expanded in pieces of at most so many, dealt over all tasks
GAP_RUN = 4096


def expanded(runs: DataFrame, width_us: int, first: str, last: str) -> DataFrame:
    """``runs`` with a row for every bucket from ``first`` to ``last`` (in microseconds), as
    ``_bucket``.  A run is cut into pieces, which are dealt out before they are
    expanded, so that a gap of decades doesn't fall to the task that found it."""
    pieces = runs.withColumn("_piece", F.explode(F.sequence(first, last, F.lit(GAP_RUN * width_us).cast("long"))))
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece_to = F.least(F.col("_piece") + F.lit((GAP_RUN - 1) * width_us), F.col(last))
    dealt = pieces.repartition(n, F.xxhash64(*[c for c, t in pieces.dtypes if t == "string"], "_piece"))
    return dealt.withColumn("_bucket", F.explode(F.sequence("_piece", piece_to, F.lit(width_us).cast("long")))).drop("_piece")


def _resample(df: DataFrame, width, key, ts, seq, values, fill: bool, min_ticks: int | None = None,
              per_coin: dict[str, F.Column] | None = None) -> DataFrame:
    """``per_coin``: further columns, aggregates over all of a coin's occupied
    buckets (``_b`` is the bucket, null for rows without a time, and comes last)."""
    width_us = width_seconds(width) * 1_000_000
    if values is None:
        values = [c for c in df.columns if c not in (key, ts, seq)]
    sparse = _sparse_buckets(df, width_us, key, ts, seq, values)
    w = Window.partitionBy(key).orderBy(F.col("_b").asc_nulls_last())
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.col(c) if not fill else F.last(c, ignorenulls=True).over(running).alias(c) for c in values]
    nxt = F.lead("_b").over(w)
    last_b = F.coalesce(nxt - F.lit(width_us), F.col("_b"))
    extra = []
    if min_ticks is not None:  # A7 on the same window: rows per coin, null times included
        extra = [F.sum("_n").over(Window.partitionBy(key)).alias("_total")]
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    more = {name: agg.over(whole) for name, agg in (per_coin or {}).items()}
    stepped = sparse.select(key, "_b", *cols, last_b.alias("_to"), *extra, *[c.alias(n) for n, c in more.items()])
    stepped = stepped.where(F.col("_b").isNotNull())
    if min_ticks is not None:
        stepped = stepped.where(F.col("_total") >= min_ticks)
    exploded = expanded(stepped.select(key, "_b", "_to", *values, *more), width_us, "_b", "_to")
    if fill:
        out_vals = [F.col(c) for c in values]
    else:  # empty buckets between occupied ones are present but null
        out_vals = [F.when(F.col("_bucket") == F.col("_b"), F.col(c)).alias(c) for c in values]
    return exploded.select(key, from_epoch_micros(F.col("_bucket")).alias("bucket"), *out_vals, *more)


def resample_last(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
                  seq: str | None = "seq", values: list[str] | None = None) -> DataFrame:
    """Fixed buckets, left-closed and left-labelled, last non-null value of
    each column; rows with a null time are ignored; empty buckets between the
    first and last occupied bucket are emitted with nulls."""
    return _resample(df, width, key, ts, seq, values, fill=False)


def resample_ffill(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
                   seq: str | None = "seq", values: list[str] | None = None, min_ticks: int | None = None) -> DataFrame:
    """W1 + W2: as ``resample_last`` with every column forward-filled; a
    leading null stays null.  ``min_ticks`` keeps only coins with at least that
    many rows (A7), counted in the same window pass, so no join is needed."""
    return _resample(df, width, key, ts, seq, values, fill=True, min_ticks=min_ticks)


def forward_fill(resampled: DataFrame, key: str = "id", order: str = "bucket",
                 values: list[str] | None = None) -> DataFrame:
    """W2 on an already regular series."""
    values = values if values is not None else [c for c in resampled.columns if c not in (key, order)]
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return resampled.select(key, order, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in values])


def tight_range(series: DataFrame, padding: float = RANGE_PADDING, key: str = "id",
                value: str = "current_price") -> DataFrame:
    """Padded axis range per coin: pad = (max-min)*padding, or min*0.01 for
    a flat series; nulls are skipped."""
    agg = series.groupBy(key).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    return agg.select(key, *_padded(F.col("_mn"), F.col("_mx"), padding))


def _padded(mn: F.Column, mx: F.Column, padding: float):
    pad = F.when(mx != mn, (mx - mn) * F.lit(padding)).otherwise(mn * F.lit(FLAT_RANGE_FRACTION))
    return [(mn - pad).alias("range_low"), (mx + pad).alias("range_high")]


def compare(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
            seq: str | None = "seq") -> DataFrame:
    """Indexed comparison series ``(price - base) / base * 100`` where base
    is the coin's first bucket price; coins with more than one tick only."""
    filled = _resample(df, width, key, ts, seq, ["current_price"], fill=True, min_ticks=2, per_coin={"_base": F.first("current_price")})
    p, base = F.col("current_price"), F.col("_base")
    return filled.select(key, "bucket", (F.try_divide(p - base, base) * F.lit(100.0)).alias("pct_change"))


def sparklines(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
               seq: str | None = "seq", padding: float = SPARKLINE_PADDING) -> DataFrame:
    """Price series of coins with more than one tick, with the trend of the
    latest change and a padded y range (0.15).

    Trend and range come from the same buckets and window as the series: a coin's
    latest change is that of its last bucket that has one, and filling adds no
    price that an occupied bucket doesn't have."""
    in_time = F.when(F.col("_b").isNotNull(), F.col("current_price"))
    change = "price_change_pct_24h"
    series = _resample(df, width, key, ts, seq, ["current_price", change], fill=True, min_ticks=2, per_coin={
        "_change": F.last(change, ignorenulls=True), "_mn": F.min(in_time), "_mx": F.max(in_time)})
    return series.select(key, "bucket", "current_price", trend("_change").alias("trend"), *_padded(F.col("_mn"), F.col("_mx"), padding))


def detail_series(df: DataFrame, coin: str, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
                  seq: str | None = "seq") -> DataFrame:
    """Price and volume series of one coin (filter pushed to the scan)."""
    one = for_coin(df, coin, key)
    return resample_ffill(one, width, key, ts, seq, values=["current_price", "total_volume"]).select(
        "bucket", "current_price", "total_volume")


def history_panel(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
                  seq: str | None = "seq", padding: float = RANGE_PADDING) -> DataFrame:
    """Every coin's price series with a padded range (no tick guard)."""
    in_time = F.when(F.col("_b").isNotNull(), F.col("current_price"))
    series = _resample(df, width, key, ts, seq, ["current_price"], fill=True, per_coin={"_mn": F.min(in_time), "_mx": F.max(in_time)})
    return series.select(key, "bucket", "current_price", *_padded(F.col("_mn"), F.col("_mx"), padding))


def period_stats(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
                 seq: str | None = "seq") -> DataFrame:
    """First, last, high, low, total change and latest 24 h change on the
    resampled series (so high/low ignore intra-bucket extremes)."""
    price, change = F.col("current_price"), F.col("price_change_pct_24h")
    buckets = _sparse_buckets(df, width_seconds(width) * 1_000_000, key, ts, seq, ["current_price", "price_change_pct_24h"]).where("_b is not null")
    # what filling adds repeats a value of an occupied bucket, so these suffice
    agg = buckets.groupBy(key).agg(
        F.min_by(price, "_b").alias("first_price"),
        F.max_by(price, F.when(price.isNotNull(), F.col("_b"))).alias("last_price"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(change, F.when(change.isNotNull(), F.col("_b"))).alias("change_24h"),
    )
    total = F.try_divide(F.col("last_price") - F.col("first_price"), F.col("first_price")) * F.lit(100.0)
    return agg.select(key, "first_price", "last_price", "high", "low", total.alias("total_change"), "change_24h",
                      price_label("last_price").alias("current_label"), change_label(total).alias("total_change_label"))


def coin_cards(df: DataFrame, width=DEFAULT_WIDTH, key: str = "id", ts: str = "timestamp",
               seq: str | None = "seq", padding: float = SPARKLINE_PADDING) -> DataFrame:
    """One card per coin: latest price and change labels with the trend,
    and the sparkline's padded range for coins with more than one tick (null
    otherwise).  Latest values, tick count and range are one aggregate over the
    coin's occupied buckets: one scan and no join."""
    c, price = F.col("price_change_pct_24h"), F.col("current_price")
    sparse = _sparse_buckets(df, width_seconds(width) * 1_000_000, key, ts, seq, ["current_price", "price_change_pct_24h"])
    last = F.struct(F.col("_b").isNull(), F.col("_b"))
    many, in_time = F.sum("_n") > 1, F.when(F.col("_b").isNotNull(), price)
    cards = sparse.groupBy(key).agg(
        F.max_by(price, F.when(price.isNotNull(), last)).alias("current_price"), F.max_by(c, F.when(c.isNotNull(), last)).alias("price_change_pct_24h"),
        many.alias("has_sparkline"), F.when(many, F.min(in_time)).alias("_mn"), F.when(many, F.max(in_time)).alias("_mx"))
    return cards.select(key, display_name(key).alias("name"), price_label("current_price").alias("price_label"), change_label(c).alias("change_label"),
                        trend(c).alias("trend"), "has_sparkline", *_padded(F.col("_mn"), F.col("_mx"), padding))
