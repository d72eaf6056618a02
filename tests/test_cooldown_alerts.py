"""T1 cooldown against a sequential loop, J1 alert matching, K6 outbox."""

import random

import pytest
from pyspark.sql import functions as F

from marketpulse.operators import alerts as J
from marketpulse.operators import cooldown as T
from marketpulse.schemas import SUBSCRIPTION
from tests.helpers import at, rows_of, tick, ticks_df


def sequential_cooldown(rows, seconds=3600):
    """The rule as a plain loop: the oracle for the distributed job."""
    last, kept = {}, []
    for r in sorted((r for r in rows if r[0] is not None and r[6] is not None), key=lambda r: (r[6], r[7])):
        coin, change = r[0], r[3]
        if coin in last and (r[6] - last[coin]).total_seconds() < seconds:
            continue
        if change is None or change == 0:
            continue
        last[coin] = r[6]
        kept.append(r[7])
    return sorted(kept)


def kept_seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())


def test_cooldown_boundaries(spark):
    rows = [tick("a", s, change=1.0, seq=i) for i, s in enumerate([0, 3599, 3600, 7199, 7200])]
    assert kept_seqs(T.cooldown(ticks_df(spark, rows))) == [0, 2, 4]


def test_zero_and_null_do_not_set_state(spark):
    rows = [tick("a", 0, change=0.0, seq=1), tick("a", 10, change=None, seq=2), tick("a", 20, change=-1.0, seq=3),
            tick("a", 30, change=5.0, seq=4)]          # sign change inside the cooldown is skipped
    assert kept_seqs(T.cooldown(ticks_df(spark, rows))) == [3]


def test_state_is_per_coin(spark):
    rows = [tick("a", 0, change=1.0, seq=1), tick("b", 10, change=1.0, seq=2), tick("a", 20, change=1.0, seq=3)]
    assert kept_seqs(T.cooldown(ticks_df(spark, rows))) == [1, 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cooldown_matches_sequential_loop(spark, seed):
    rnd = random.Random(seed)
    rows, seq = [], 0
    for coin in ["a", "b", "c", "d"]:
        t = rnd.randint(0, 10_000)
        for _ in range(rnd.randint(1, 400)):
            t += rnd.choice([0, 1, 30, 90, 600, 1800, 3599, 3600, 3601, 7300, 20_000])
            seq += 1
            change = rnd.choice([None, 0.0, -3.0, 1.0, 2.5, -0.5])
            rows.append(tick(coin, t, change=change, seq=seq))
    rows.append(tick(None, 5, change=1.0, seq=seq + 1))
    rows.append(tick("a", None, change=1.0, seq=seq + 2))
    want = sequential_cooldown(rows)
    assert kept_seqs(T.cooldown(ticks_df(spark, rows))) == want
    assert kept_seqs(T.cooldown(ticks_df(spark, rows), seconds=600)) == sequential_cooldown(rows, 600)


def test_cooldown_with_carried_state(spark):
    rows = [tick("a", s, change=1.0, seq=i) for i, s in enumerate([100, 3700, 5000])]
    ready = spark.createDataFrame([("a", at(3700))], "id string, ready_at timestamp_ntz")
    assert kept_seqs(T.cooldown(ticks_df(spark, rows), ready=ready)) == [1]


def _subs(spark, rows):
    return spark.createDataFrame([(e, c, t, d, at(0)) for e, c, t, d in rows], SUBSCRIPTION)


def test_match_alerts(spark):
    cooled = ticks_df(spark, [tick("a", 0, price=10.0, change=-3.0, seq=1), tick("b", 0, price=1.0, change=5.0, seq=2)])
    subs = _subs(spark, [("x@e", "a", 2.5, "drop"), ("y@e", "a", 4.0, "drop"), ("z@e", "a", 1.0, "rise"),
                         ("w@e", "b", None, "rise")])
    got = rows_of(J.match_alerts(cooled, subs), "email", "coin", "threshold")
    assert got == [("w@e", "b", 2.0), ("x@e", "a", 2.5)]
    out = J.alert_outbox(J.match_alerts(cooled, subs)).where("email = 'x@e'").first()
    assert out["subject"] == "Price alert: A dropped 3.00%"


def test_results_do_not_depend_on_session_zone(spark):
    from marketpulse.operators import timeseries as W
    # ticks across the 2024-03-10 US daylight-saving jump
    rows = [tick("a", 68 * 86400 + i * 1500, price=float(i), change=1.0, seq=i) for i in range(40)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = (kept_seqs(T.cooldown(ticks_df(spark, rows))),
               rows_of(W.resample_ffill(ticks_df(spark, rows), values=["current_price"]), "bucket", "current_price"))
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = (kept_seqs(T.cooldown(ticks_df(spark, rows))),
              rows_of(W.resample_ffill(ticks_df(spark, rows), values=["current_price"]), "bucket", "current_price"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert utc == ny
    assert utc[0] == sequential_cooldown(rows)


def test_tick_without_subscribers_still_consumes_cooldown(spark):
    # coin "a" first moves with nobody subscribed; the second tick 10 minutes
    # later would hit the threshold but is inside the cooldown
    ticks = ticks_df(spark, [tick("a", 0, price=1.0, change=9.0, seq=1), tick("a", 600, price=1.0, change=9.0, seq=2)])
    subs = _subs(spark, [("x@e", "b", 1.0, "rise")])
    assert J.match_alerts(T.cooldown(ticks), subs).count() == 0
    subs_a = _subs(spark, [("x@e", "a", 1.0, "rise")])
    assert rows_of(J.match_alerts(T.cooldown(ticks), subs_a), "timestamp") == [(at(0),)]


def test_cooldown_with_a_hot_bucket_and_equal_instants(spark):
    rnd = random.Random(5)
    rows, seq = [], 0
    for _ in range(3000):                      # one coin-hour holding most rows, many at one instant
        seq += 1
        rows.append(tick("hot", 7200 + rnd.choice([0, 0, 0, 1, 2, 1800, 3599]), change=1.0, seq=seq))
    for i in range(200):                       # the same coin before and after, and another coin
        seq += 1
        rows.append(tick("hot", rnd.randint(0, 20_000), change=rnd.choice([1.0, -1.0, 0.0]), seq=seq))
        seq += 1
        rows.append(tick("cold", rnd.randint(0, 20_000), change=1.0, seq=seq))
    df = ticks_df(spark, rows)
    assert kept_seqs(T.cooldown(df)) == sequential_cooldown(rows)


def test_cooldown_on_empty_and_all_zero_input(spark):
    empty = ticks_df(spark, [])
    assert T.cooldown(empty).count() == 0
    zeros = ticks_df(spark, [tick("a", i * 10, change=0.0, seq=i) for i in range(5)])
    assert T.cooldown(zeros).count() == 0
    from marketpulse.operators import timeseries as W
    assert W.resample_ffill(empty).count() == 0 and W.period_stats(empty).count() == 0


def test_rendering_before_the_join_equals_rendering_per_alert(spark):
    cooled = ticks_df(spark, [tick("shiba inu", 0, price=1234.5, change=-3.125, seq=1),
                              tick("b", 0, price=None, change=5.0, seq=2)])
    subs = _subs(spark, [("x@e", "shiba inu", 2.5, "drop"), ("w@e", "b", None, "rise"), ("v@e", "b", 4.0, "rise")])
    cols = ("email", "subject", "body")
    assert rows_of(J.match_alerts(cooled, subs, render=True), *cols) == rows_of(
        J.alert_outbox(J.match_alerts(cooled, subs)), *cols)


def test_cooldown_over_three_levels_without_a_root(spark):
    """A dense series of 4,000 hours: its only root is the first tick, and no two entries of a block ever meet."""
    rows = [tick("a", 20 + i * 1260, change=1.0, seq=i) for i in range(11_500)] + [tick("b", -5000 + i * 4000, change=1.0, seq=20_000 + i) for i in range(5)]
    assert kept_seqs(T.cooldown(ticks_df(spark, rows))) == sequential_cooldown(rows)


def test_cooldown_runs_few_jobs(spark):
    rows = [tick("abc"[i % 3], i * 500, change=1.0, seq=i) for i in range(3000)]
    df = ticks_df(spark, rows).repartition(4).persist()
    df.count()
    sc = spark.sparkContext
    sc.setJobGroup("cooldown-jobs", "counted")
    try:
        T.cooldown(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        df.unpersist()
    assert len(sc.statusTracker().getJobIdsForGroup("cooldown-jobs")) <= 15


def test_a_tick_covers_the_bands_below_it_once():
    for band in range(J.BANDS):
        n, cells = band + 1, set()
        for level in range(J.LEVELS):
            if n >> level & 1:
                cells.add((level, (n >> level) - 1))
        assert len(cells) <= 6
        for other in range(J.BANDS):
            assert sum((level, other >> level) in cells for level in range(J.LEVELS)) == (other <= band)


def test_cells_in_spark_and_nan_thresholds(spark):
    got = spark.range(J.BANDS).select("id", J._cover(F.col("id").cast("int")).alias("cover"), J._cells_of(F.col("id").cast("int")).alias("cells")).collect()
    for a in got:
        assert len(a.cover) <= 6
        for b in got:
            assert len(set(a.cover) & set(b.cells)) == (b.id <= a.id)
    cooled = ticks_df(spark, [tick("a", 0, change=-3.0, seq=1), tick("a", 1, change=1.5, seq=2), tick("a", 2, change=float("nan"), seq=3)])
    subs = _subs(spark, [("n@e", "a", float("nan"), "drop"), ("m@e", "a", float("nan"), "rise")])
    assert rows_of(J.match_alerts(cooled, subs), "email", "change", "threshold") == [("n@e", -3.0, 2.0)]


def test_rendering_lies_below_the_deal_to_cells(spark):
    cooled = ticks_df(spark, [tick("a", 0, price=1.0, change=-3.0, seq=1)])
    plan = J.match_alerts(cooled, _subs(spark, [("x@e", "a", 1.0, "drop")]), render=True)._jdf.queryExecution().optimizedPlan().toString()
    tick_side = plan[plan.index("_head") if plan.index("_head") < plan.index("Generate") else 0:]
    assert "format_number" in tick_side[tick_side.index("Generate"):] and "format_number" not in tick_side[:tick_side.index("Generate")]


def test_a_mailer_skips_what_it_has_sent(spark):
    rows = [("e1", "a", "rise", 3.0, 1.0, 2.0, at(0)), ("e1", "a", "rise", 3.0, 1.0, 2.0, at(4000)), ("e2", "a", "rise", 3.0, 1.0, 2.0, at(0)),
            (None, "a", "rise", 3.0, 1.0, 2.0, None), ("1", "1:b", "rise", 3.0, 1.0, 2.0, at(0)), ("11", ":b", "rise", 3.0, 1.0, 2.0, at(0))]
    outbox = J.alert_outbox(spark.createDataFrame(rows, "email string, coin string, direction string, change double, price double, threshold double, timestamp timestamp_ntz"))
    ids = {(r.email, r.timestamp): r.alert_id for r in J.with_alert_id(outbox).collect()}
    assert len(set(ids.values())) == len(rows)
    none = J.with_alert_id(outbox).where("false")
    assert sorted(r.alert_id for r in J.unsent(outbox, none).collect()) == sorted(ids.values())
    receipts = spark.createDataFrame([(ids["e1", at(0)],), (ids["e1", at(0)],), (None,)], "alert_id string")
    repeated = outbox.unionByName(outbox).unionByName(outbox.withColumn("price", F.col("price") + 1))
    got = J.unsent(repeated, receipts)
    assert sorted(r.alert_id for r in got.collect()) == sorted(set(ids.values()) - {ids["e1", at(0)]})
    assert got.columns == [*outbox.columns, "alert_id"] and {r.price for r in got.collect()} == {1.0}
    assert J.unsent(outbox.where("false"), receipts).count() == 0


def test_a_stored_outbox_is_searched_bucket_by_bucket(spark, tmp_dir, monkeypatch):
    cooled = ticks_df(spark, [tick("a", 4000 * i, price=1.0, change=9.0 - i, seq=i) for i in range(6)] + [tick("b", 0, change=-3.0, seq=9)])
    people = [(f"u{i}@e", "a", 1.0 + i % 7, "rise") for i in range(40)] + [(f"u{i}@e", "b", None, "drop") for i in range(9)]
    subs = _subs(spark, people + [people[0], (None, "a", 2.0, "rise"), (None, "a", 3.0, "rise"), ("w@e", None, 2.0, "rise")])
    tables = {t.name for t in spark.catalog.listTables()}
    outbox = J.match_alerts(cooled, subs, render=True)
    written = J.with_alert_id(J.store_outbox(J.match_alerts(cooled, subs, render=True, buckets=5), f"{tmp_dir}/outbox", 5))
    assert {t.name for t in spark.catalog.listTables()} == tables and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert rows_of(written.drop("alert_id", J.PLACE)) == rows_of(outbox)
    receipts = written.where(F.col("timestamp") < F.lit(at(9000)).cast("timestamp_ntz")).select("alert_id", J.PLACE)
    got = J.unsent(written.unionByName(written), receipts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 3 and plan.count("Bucketed: true") == 3
    by_id = J.unsent(outbox.unionByName(outbox), receipts.select("alert_id"))
    assert got.columns == by_id.columns and rows_of(got) == rows_of(by_id) and 0 < got.count() < outbox.count()
    none = receipts.select(F.lit(None).cast("string").alias("alert_id"), J.PLACE)  # a receipt without an id is for no alert
    assert rows_of(J.unsent(written, none)) == rows_of(J.unsent(outbox, none.select("alert_id")))
    # 43 rising subscriptions of a times 6 ticks, 9 dropping ones of b times one
    monkeypatch.setattr(J, "BUCKET_ALERTS", 10)
    assert J.outbox_buckets(cooled, subs) == max(J._tasks(spark), -(-(43 * 6 + 9) // 10)) and J.outbox_buckets(cooled, subs.where("false")) == J._tasks(spark)


def test_an_alert_of_a_stored_outbox_counts_once_where_its_rows_differ(spark, tmp_dir):
    cooled = ticks_df(spark, [tick("a", 0, price=1.0, change=9.0, seq=1), tick("a", 4000, price=2.0, change=8.0, seq=2)])
    written = J.store_outbox(J.match_alerts(cooled, _subs(spark, [("x@e", "a", 2.0, "rise")]), render=True, buckets=3), f"{tmp_dir}/outbox", 3)
    twice = written.withColumn("price", F.col("price") + 1).unionByName(written)
    sent = J.with_alert_id(written.where("price = 2")).select("alert_id", J.PLACE)
    assert [r.price for r in J.unsent(twice, sent).collect()] == [1.0]


def test_subscriptions_of_one_file_are_dealt_over_tasks(spark):
    cooled = ticks_df(spark, [tick("a", i, price=1.0, change=9.0, seq=i) for i in range(3)])
    subs = _subs(spark, [(f"u{i}@e", "a", 1.0 + i % 7, "rise") for i in range(400)]).coalesce(1)
    alerts = J.match_alerts(F.broadcast(cooled), subs, render=True)
    per_task = [r["count"] for r in alerts.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 1200
    assert len(per_task) >= 4 and max(per_task) <= 600
