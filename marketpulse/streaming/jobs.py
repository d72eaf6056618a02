"""Structured Streaming jobs (T2-T7) and the streaming forms of T1, W1 and W2.

Each job is ``readStream -> decode -> foreachBatch``.  Inside a batch the
DataFrame is persisted once, then every branch (history append, alert match,
summary) runs as an ordinary distributed batch plan, so the streaming code is the
batch library.  What must outlive a batch (a coin's cooldown, its last bucket) is
Spark's own keyed state: it is versioned with the checkpoint, so a replayed batch
sees the state it saw first.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketpulse.constants import BUCKET_WIDTH, SENTIMENT_TRIGGER, TICK_TRIGGER
from marketpulse.functions.time import epoch_micros, from_epoch_micros, naive_utc, now_utc, zoned
from marketpulse.operators.alerts import match_alerts
from marketpulse.operators.cooldown import DEFAULT_COOLDOWN_SECONDS, first_of_instants, may_alert
from marketpulse.operators.sentiment import sentiment_summary
from marketpulse.operators.snapshot import partials
from marketpulse.operators.subscriptions import SubscriptionLog
from marketpulse.operators.timeseries import expanded, width_seconds
from marketpulse.schemas import TICK_VALUE_COLUMNS
from marketpulse.streaming.sinks import BatchRecord, append_batch, append_summary


def start(df: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
          trigger: str | None = TICK_TRIGGER, available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """Run ``batch_fn`` per micro-batch with a processing-time trigger
    (or ``availableNow`` for backfills and tests), recoverable from ``checkpoint``."""
    w = df.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def stream_id_for(checkpoint: str) -> str:
    """Sink partition id tied to the checkpoint: a restart from the same
    checkpoint replays into the same partitions, a new checkpoint (whose batch
    ids restart at 0) gets new ones."""
    return "q" + hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def run_to_end(query: StreamingQuery) -> None:
    """T5 for bounded runs: wait for the query and surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def kept_instants(ticks: DataFrame, at: Column, seconds: float = DEFAULT_COOLDOWN_SECONDS, key: str = "id",
                  change: str = "price_change_pct_24h") -> DataFrame:
    """T1 on a stream: (``key``, ``t``) of the instants of the clock ``at`` at which a
    coin keeps a tick, with the earliest instant at which it may keep the next one as the
    coin's state.  Only instants go through the state operator, eight bytes a tick, and a
    coin's batch is walked by binary search from one kept instant to the next."""
    if seconds <= 0:
        raise ValueError("a cooldown takes more than 0 seconds")
    cooldown_us = max(1, int(round(seconds * 1_000_000)))

    def walk(coin: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, kept = np.unique(np.concatenate([p["t"].to_numpy(np.int64) for p in parts])), []
        at = int(np.searchsorted(times, state.get[0])) if state.exists else 0
        while at < len(times):
            kept.append(int(times[at]))
            at = int(np.searchsorted(times, times[at] + cooldown_us))
        if kept:
            state.update((kept[-1] + cooldown_us,))
        yield pd.DataFrame({"key": [coin[0]] * len(kept), "t": pd.Series(kept, dtype="int64")})

    rows = ticks.where(F.col(key).isNotNull() & at.isNotNull() & may_alert(change)).select(F.col(key).alias("key"), epoch_micros(at).alias("t"))
    return rows.groupBy("key").applyInPandasWithState(walk, "key string, t long", "ready long", "append", GroupStateTimeout.NoTimeout)


def _with_kept(ticks: DataFrame, at: Column, seconds: float) -> DataFrame:
    """The ticks and, as further rows of the same stream, the kept instants: ``_kept``
    tells them apart, ``_t`` is either's instant."""
    kept = kept_instants(ticks, at, seconds)
    own = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "id" else F.col("key").alias("id") for f in ticks.schema.fields]
    return ticks.select("*", epoch_micros(at).alias("_t"), F.lit(False).alias("_kept")).unionByName(
        kept.select(*own, F.col("t").alias("_t"), F.lit(True).alias("_kept")))


def _cooled(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch of ``_with_kept``: its ticks, and those that pass the cooldown."""
    ticks = batch.where(~F.col("_kept")).drop("_kept")
    kept = batch.where("_kept").select(F.col("id").alias("key"), F.col("_t").alias("t"))
    cooled = first_of_instants(ticks.where(may_alert("price_change_pct_24h")), F.col("_t"), kept)
    return ticks.drop("_t"), cooled.drop("_t")


def cooldown_stream(ticks: DataFrame, out_path: str, checkpoint: str, stream_id: str | None = None,
                    seconds: float = DEFAULT_COOLDOWN_SECONDS, **trigger) -> StreamingQuery:
    """T1 on a stream: kept ticks appended to ``out_path`` per batch.  Equals
    the batch form when batches arrive in time order; a tick older than its
    coin's last kept tick is skipped."""
    sid = stream_id or stream_id_for(checkpoint)

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            append_batch(_cooled(batch)[1], batch_id, out_path, sid, skip_empty=False)
        finally:
            batch.unpersist()

    return start(_with_kept(ticks, F.col("timestamp"), seconds), fn, checkpoint, **trigger)


def write_alerts(cooled: DataFrame, subscriptions: Callable[[], DataFrame] | SubscriptionLog, batch_id: int, path: str, stream_id: str) -> int:
    """J1 and K6 for one batch, against the subscriptions as they are at the batch's
    first try.  With a ``SubscriptionLog`` a replay sees the same ones: the log's
    position is kept in the batch's record.  A callable is asked in every try."""
    if isinstance(subscriptions, SubscriptionLog):
        record = BatchRecord(cooled.sparkSession, path, stream_id, batch_id)
        subs = subscriptions.as_of(record.once("position", subscriptions.position))
    else:
        subs = subscriptions()
    return append_batch(match_alerts(cooled, subs, render=True), batch_id, path, stream_id, skip_empty=False)


def tick_job(ticks: DataFrame, history_path: str, alerts_path: str, dead_letter_path: str,
             subscriptions: Callable[[], DataFrame] | SubscriptionLog, checkpoint: str, stream_id: str | None = None,
             seconds: float = DEFAULT_COOLDOWN_SECONDS, preview: bool = False, clock: str = "event",
             arrival: Column | None = None, snapshot_path: str | None = None, **trigger) -> StreamingQuery:
    """Decoded tick stream -> history (K1), cooldown (T1) with keyed state,
    alert match (J1) against the subscription table as of this batch, alert
    outbox (K6), and dead letters for ticks that the cooldown can't look at.

    ``clock="event"`` measures the cooldown on the ticks' own times; a tick without
    a time goes to the dead letters (``reason`` "no time") besides the history.
    ``clock="processing"`` measures it on arrival (the column ``arrival``, naive UTC, by
    default the time of the batch), so a tick's time, or lack of one, doesn't
    matter.  A tick without an id only goes to the dead letters ("no id").  With a
    ``snapshot_path`` the batch's partial snapshot is written there (``snapshot.partials``)."""
    if clock not in ("event", "processing"):
        raise ValueError(f"unknown clock {clock!r}")
    stream_id = stream_id or stream_id_for(checkpoint)
    no_id = F.col("id").isNull()
    reason = F.when(no_id, F.lit("no id"))
    if clock == "event":
        reason = reason.when(F.col("timestamp").isNull(), F.lit("no time"))
        at = F.col("timestamp")
    else:
        at = now_utc() if arrival is None else arrival

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():  # K7
                return
            rows, cooled = _cooled(batch)
            good = rows.where(~no_id)
            append_batch(rows.withColumn("reason", reason).where("reason is not null"), batch_id, dead_letter_path, stream_id, skip_empty=False)
            append_batch(good, batch_id, history_path, stream_id, preview=preview, date_from="timestamp",
                         skip_empty=False)
            if snapshot_path is not None:
                append_batch(partials(good), batch_id, snapshot_path, stream_id, date_from="last_tick", skip_empty=False)
            write_alerts(cooled, subscriptions, batch_id, alerts_path, stream_id)
        finally:
            batch.unpersist()

    return start(_with_kept(ticks, at, seconds), fn, checkpoint, **trigger)


def sentiment_job(articles: DataFrame, raw_path: str, summary_path: str, checkpoint: str, stream_id: str | None = None,
                  as_of: Callable[[int], object] | None = None, preview: bool = False, **trigger) -> StreamingQuery:
    """Decoded article stream -> raw history (K2) and one per-coin summary
    per batch stamped with a single batch instant (A1, T4, K3)."""
    stream_id = stream_id or stream_id_for(checkpoint)
    trigger.setdefault("trigger", SENTIMENT_TRIGGER)

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if append_batch(batch, batch_id, raw_path, stream_id) == 0:  # K7
                return
            stamp = as_of(batch_id) if as_of is not None else None
            append_summary(sentiment_summary(batch, stamp), batch_id, summary_path, stream_id, preview=preview)
        finally:
            batch.unpersist()

    return start(articles, fn, checkpoint, **trigger)


def resample_stream(ticks: DataFrame, width: str = BUCKET_WIDTH, delay: str = "1 hour",
                    values: tuple[str, ...] = tuple(TICK_VALUE_COLUMNS), fill: bool | None = None) -> DataFrame:
    """W1 on a stream: event-time buckets closed by a watermark, last non-null
    value per column; append mode emits a bucket once the watermark passes
    its end, later rows for it are dropped.

    Without ``fill`` only occupied buckets come out.  With it the empty ones between a
    coin's closed buckets do as well, as nulls (``fill=False``, W1) or with the values
    before them (``fill=True``, W1 and W2), once the occupied bucket after them closes:
    all in all what the batch form makes of the ticks in closed buckets."""
    ts = zoned("timestamp")
    src = ticks.where(F.col("id").isNotNull()).withColumn("_ts", ts).withWatermark("_ts", delay)
    if fill is not None:
        return _regular(src, width_seconds(width) * 1_000_000, values, fill)
    order = F.struct(F.col("_ts"), *[F.col("seq") for _ in ("seq",) if "seq" in ticks.columns])
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in values]
    out = src.groupBy(F.col("id"), F.window("_ts", width).alias("w")).agg(*aggs)
    return out.select("id", naive_utc(F.col("w.start")).alias("bucket"), *values)


# a coin's ticks are folded to the last values of their buckets in blocks of about so many
FOLD_ROWS = 50_000


def last_values(values: tuple[str, ...]) -> Callable[[Iterator[pd.DataFrame]], tuple[set[int], dict[str, pd.DataFrame]]]:
    """A function (nested, so that it travels with its job) from the parts of a coin's
    ticks to their buckets ``b`` and, per column, the last value that is there in each of
    them with its place (``t``, ``s``); of equal places the later row counts.  It holds
    one block and a row per bucket and column, however many ticks come."""
    def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for part in parts:
            held.append(part)
            n += len(part)
            if n >= FOLD_ROWS:
                yield pd.concat(held)
                held, n = [], 0
        if n:
            yield pd.concat(held)

    def fold(parts: Iterator[pd.DataFrame]) -> tuple[set[int], dict[str, pd.DataFrame]]:
        occupied, last = set(), {}
        for rows in blocks(parts):
            occupied.update(rows["b"].unique().tolist())
            for name in values:
                own = rows.loc[rows[name].notna(), ["b", "t", "s", name]]
                both = pd.concat([last[name], own]) if name in last else own
                last[name] = both.sort_values(["t", "s"], kind="stable").groupby("b").tail(1)
        return occupied, last

    return fold


def _regular(src: DataFrame, width_us: int, values: tuple[str, ...], fill: bool) -> DataFrame:
    """Closed buckets with the empty ones before them.  A coin's state holds its open
    buckets, per column the last value with its place in the order, and the last
    closed bucket's values; it wakes when the watermark passes the end of an open
    bucket.  A batch's ticks are folded block by block, so a task never holds a coin's
    ticks, only its buckets.  Values pass as text, which keeps every long and double as it is; an empty
    stretch leaves the operator as one run and is expanded afterwards."""
    types = {f.name: f.dataType for f in src.schema.fields}
    fold = last_values(values)

    def close(coin: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        found = json.loads(state.get[0]) if state.exists else {"last": None, "before": [None] * len(values), "open": {}}
        buckets = {int(b): own for b, own in found["open"].items()}
        closed_to = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            in_time = (p[p["b"] + width_us > closed_to] for p in parts)  # what comes later than that is dropped
            occupied, latest = fold(in_time)
            for b in occupied:
                buckets.setdefault(b, [None] * len(values))
            for i, name in enumerate(values):
                for r in latest[name].itertuples(index=False) if name in latest else ():
                    held, own = buckets[int(r[0])][i], [int(r[1]), int(r[2]), r[3]]
                    if held is None or held[:2] <= own[:2]:
                        buckets[int(r[0])][i] = own
        last, before, out = found["last"], found["before"], []
        for b in sorted(b for b in buckets if b + width_us <= closed_to):
            own = [None if v is None else v[2] for v in buckets.pop(b)]
            if last is not None and last + width_us < b:
                out.append((coin[0], last + width_us, b - width_us, *(before if fill else [None] * len(values))))
            if fill:
                own = [w if v is None else v for v, w in zip(own, before)]
            out.append((coin[0], b, b, *own))
            last, before = b, own
        state.update((json.dumps({"last": last, "before": before, "open": buckets}),))
        if buckets:
            state.setTimeoutTimestamp(max((min(buckets) + width_us) // 1000 - 1, closed_to // 1000 + 1))
        yield pd.DataFrame(out, columns=["id", "from_us", "to_us", *values]).astype({"from_us": "int64", "to_us": "int64"} | {v: object for v in values})

    t = epoch_micros("timestamp")
    seq = F.coalesce("seq", F.lit(-1 << 63)) if "seq" in types else F.lit(0).cast("long")
    b = F.expr(f"t - pmod(t, {width_us}L)")
    rows = src.where(F.col("timestamp").isNotNull()).select("id", "_ts", t.alias("t"), seq.alias("s"), *[F.col(v).cast("string").alias(v) for v in values])
    out = ", ".join(f"`{v}` string" for v in values)
    found = rows.withColumn("b", b).groupBy("id").applyInPandasWithState(
        close, f"id string, from_us long, to_us long, {out}", "held string", "append", GroupStateTimeout.EventTimeTimeout)
    each = expanded(found, width_us, "from_us", "to_us")
    return each.select("id", from_epoch_micros("_bucket").alias("bucket"), *[F.col(v).cast(types[v]).alias(v) for v in values])
