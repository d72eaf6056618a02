"""Alert matching (J1) and the alert outbox.

The tick side of J1 is the *cooled* tick set (at most one row per coin per
cooldown window), the subscription side may hold millions of rows keyed by
only a handful of coins.  The cooldown writes the cooled ticks, so the planner
sees their real size and broadcasts them while they are small.  A subscription
gives hundreds of alerts, so a compact file of them, which one task scans, is dealt
out over all tasks before it meets the ticks.  For a long
backfill the join falls back to a shuffle join whose skewed coin partitions
AQE splits.

Both sides are keyed by (coin, direction, cell).  Thresholds lie in bands, bands in
a binary tree of cells.  A subscription is in one cell per level; a tick goes to the
cells that cover the bands up to its own change, the only ones that hold
thresholds it can hit: at most one per level, six in all, and no band twice.  So a
coin and direction is dealt over many tasks, and pairs that can't match are
mostly never made.

With ``render=True`` the alert text is rendered on the tick side before it is
dealt to cells (number formatting once per cooled tick, not once per cell or alert); each alert
then only appends its subscriber's threshold.

An outbox may be stored in buckets by subscription.  A subscription's alerts then lie together,
where few bits tell them apart, and what a mailer still has to send is found bucket by bucket:
nothing as large as the outbox is shuffled, and a bucket is small enough to be sorted in memory.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.labels import (alert_body, alert_body_head, alert_body_tail, alert_subject, direction,
                                          effective_threshold, threshold_hit)
from marketpulse.functions.time import epoch_micros


# thresholds are dealt into bands of one per cent, the last one is open; 64 bands are the leaves of a tree of 7 levels
BANDS, LEVELS = 64, 7
# where an alert lies in a stored outbox: a number that all alerts of a subscription share
PLACE = "_place"
# a bucket of a stored outbox has at most about so many alerts; Spark takes no more buckets than that
BUCKET_ALERTS, MOST_BUCKETS = 500_000, 100_000


def _band(percent) -> F.Column:
    return F.greatest(F.lit(0), F.least(F.lit(BANDS - 1), F.floor(percent))).cast("int")


def _cells_of(band) -> F.Column:
    """The cell of each level that a band lies in."""
    return F.array(*[F.lit(level * BANDS) + F.shiftright(band, level) for level in range(LEVELS)])


def _cover(band) -> F.Column:
    """The fewest cells that hold the bands from 0 to ``band``: one for each bit of their number."""
    n = band + 1
    return F.array_compact(F.array(*[F.when(F.shiftright(n, level).bitwiseAND(F.lit(1)) == 1, F.lit(level * BANDS) + F.shiftright(n, level) - 1)
                                     for level in range(LEVELS)]))


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _dealt(subs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Subscriptions evenly over all tasks, however few files or row groups hold them, or
    with their place, a bucket to a task.  The number is given, so that AQE, which sees only
    how small they are, doesn't merge them again."""
    if buckets is None:
        return subs.repartition(_tasks(subs.sparkSession))
    return subs.withColumn(PLACE, F.xxhash64("email", "coin", "direction")).repartition(buckets, PLACE)


def match_alerts(cooled: DataFrame, subs: DataFrame, key: str = "id", change: str = "price_change_pct_24h",
                 price: str = "current_price", ts: str = "timestamp", render: bool = False,
                 buckets: int | None = None) -> DataFrame:
    """One row per (cooled tick, subscriber) whose direction and threshold
    hit; with ``render`` also the K6 subject and body.  With ``buckets`` also their place, and
    a task makes the alerts of one bucket (see ``store_outbox``)."""
    t = cooled.select(F.col(key).alias("coin"), F.col(change).alias("change"), F.col(price).alias("price"),
                      F.col(ts).alias("timestamp"), direction(change).alias("direction"))
    if render:
        t = t.withColumns({"subject": alert_subject("coin", "direction", "change"),
                           "_head": alert_body_head("coin", "direction", "change", "price")})
    t = t.withColumn("_band", F.explode(_cover(_band(F.abs("change")))))
    s = _dealt(subs.select("email", "coin", "direction", effective_threshold("threshold").alias("threshold")), buckets)
    s = s.withColumn("_band", F.explode(_cells_of(_band(F.col("threshold")))))
    cond = ((t["coin"] == s["coin"]) & (t["direction"] == s["direction"]) & (t["_band"] == s["_band"])
            & threshold_hit(t["change"], s["threshold"], t["direction"]))
    cols = [s["email"], t["coin"], t["direction"], t["change"], t["price"], s["threshold"], t["timestamp"]]
    if render:
        cols += [t["subject"], alert_body_tail(t["_head"], s["threshold"]).alias("body")]
    if buckets is not None:
        cols.append(s[PLACE])
    return t.join(s, cond, "inner").select(*cols)


def render_alert(alerts: DataFrame) -> DataFrame:
    """Add the subject and body text of each alert."""
    return alerts.withColumns({
        "subject": alert_subject("coin", "direction", "change"),
        "body": alert_body("coin", "direction", "change", "price", "threshold"),
    })


def alert_outbox(alerts: DataFrame) -> DataFrame:
    """K6: one notification row per alert, with rendered subject and body."""
    return render_alert(alerts.select("email", "coin", "direction", "change", "price", "threshold", "timestamp"))


def with_alert_id(alerts: DataFrame) -> DataFrame:
    """Delivery identity of K6: ``alert_id``, the SHA-256 of subscriber, coin, direction and
    instant.  It comes from the alert alone, so a replayed batch, a restarted stream and a
    backfill give the same alert the same id.  Missing parts count as parts of their own."""
    def part(c: str) -> F.Column:
        return F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    at = F.coalesce(epoch_micros("timestamp").cast("string"), F.lit("-"))
    return alerts.withColumn("alert_id", F.sha2(F.concat(part("email"), part("coin"), part("direction"), at), 256))


def outbox_buckets(cooled: DataFrame, subs: DataFrame, key: str = "id", change: str = "price_change_pct_24h") -> int:
    """The number of buckets for the outbox of ``match_alerts``: by the alerts there are at
    most, if every tick hits all thresholds of its coin and direction."""
    ticks = cooled.groupBy(F.col(key).alias("coin"), direction(change).alias("direction")).agg(F.count(F.lit(1)).alias("_ticks"))
    pairs = subs.groupBy("coin", "direction").agg(F.count(F.lit(1)).alias("_subs")).join(ticks, ["coin", "direction"])
    most = pairs.agg(F.sum(F.col("_ticks") * F.col("_subs"))).first()[0] or 0
    return min(MOST_BUCKETS, max(_tasks(subs.sparkSession), -(-most // BUCKET_ALERTS)))


@contextmanager
def _one_file_at_a_time(spark: SparkSession):
    """A task that writes to one bucket only has nothing to sort; another one sorts what comes
    after its first bucket."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def store_outbox(outbox: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write the alerts that ``match_alerts`` made for so many ``buckets`` to ``path``, and read
    them back.  Ids aren't for storing: they can't be compressed, and ``with_alert_id`` gives
    the same ones at any time.

    The catalog knows the table only meanwhile; its files stay.  The place has another name in
    it, as a union forgets how its sides are dealt if their columns are qualified by a table."""
    spark, name = outbox.sparkSession, f"outbox_{uuid.uuid4().hex}"
    with _one_file_at_a_time(spark):
        (outbox.withColumnRenamed(PLACE, "place").write.bucketBy(buckets, "place")
         .option("path", path).option("compression", "zstd").saveAsTable(name, format="parquet"))
    try:
        return spark.table(name).withColumnRenamed("place", PLACE)
    finally:
        spark.sql(f"DROP TABLE {name}")


def unsent(outbox: DataFrame, receipts: DataFrame) -> DataFrame:
    """What a mailer still has to send: the alerts of ``outbox`` whose ``alert_id`` isn't in
    ``receipts``, each once, also where the outbox has it repeatedly.  Both sides meet on the
    id, which deals them out evenly; of rows that share an id and differ, the least one counts.

    Where both sides tell the alerts' place in a stored outbox, they meet bucket by bucket, and
    neither is moved: rows and receipts are sorted together, once."""
    rows = outbox if "alert_id" in outbox.columns else with_alert_id(outbox)
    rest = [c for c in rows.columns if c not in ("alert_id", PLACE)]
    row = F.struct(*rest)
    if PLACE not in rows.columns or PLACE not in receipts.columns:
        left = rows.join(receipts.select("alert_id"), "alert_id", "left_anti")
        return left.groupBy("alert_id").agg(F.min(row).alias("_row")).select("_row.*", "alert_id")
    sent = receipts.where(F.col("alert_id").isNotNull()).select("alert_id", PLACE, F.lit(True).alias("_sent"))
    met = rows.withColumn("_sent", F.lit(False)).unionByName(sent, allowMissingColumns=True).groupBy("alert_id", PLACE)
    left = met.agg(F.min(F.when(~F.col("_sent"), row)).alias("_row"), F.max("_sent").alias("_sent")).where(~F.col("_sent"))
    return left.select("_row.*", "alert_id")
