"""Input as it comes: NaN, missing and repeated sequences, bad times, missing keys, replays."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from marketpulse.functions import labels as P
from marketpulse.operators import alerts as J
from marketpulse.operators import cooldown as T
from marketpulse.operators import sentiment as X
from marketpulse.operators import snapshot as S
from marketpulse.operators import subscriptions as K
from marketpulse.operators import timeseries as W
from marketpulse.schemas import SUBSCRIPTION, SUBSCRIPTION_COMMAND, TICK, TICK_WIRE_SEQ
from marketpulse.sources import codec as C
from marketpulse.streaming import jobs as ST
from marketpulse.streaming.sinks import append_batch, compact_date, read_table
from tests.helpers import at, rows_of, tick, ticks_df

NAN = float("nan")
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_nan_is_a_missing_value(spark):
    df = spark.createDataFrame([(NAN,), (1.0,), (-1.0,), (None,)], "c double").select("c", P.direction("c").alias("d"), P.trend("c").alias("t"))
    assert [(r.d, r.t) for r in df.collect()] == [(None, "down"), ("rise", "up"), ("drop", "down"), (None, "down")]
    msgs = spark.createDataFrame([('{"id": "a", "current_price": "NaN", "price_change_pct_24h": NaN, "timestamp": "2024-01-01T00:00:00Z"}',)], "value string")
    r = C.decode_ticks(msgs).first()
    assert r.current_price is None and r.price_change_pct_24h is None


def test_nan_does_not_take_the_cooldown(spark):
    rows = [tick("a", 0, change=NAN, seq=1), tick("a", 5, change=-9.0, seq=2)]
    assert [r.seq for r in T.cooldown(ticks_df(spark, rows)).collect()] == [2]


def test_missing_and_repeated_sequences(spark):
    rows = [tick("a", 0, price=2.0, change=1.0, seq=None), tick("a", 0, price=2.0, change=1.0, seq=None), tick("a", 4000, change=2.0, seq=7),
            tick("a", 4000, change=2.0, seq=7), tick("b", 0, price=5.0, change=1.0, seq=None), tick("b", 0, price=4.0, change=1.0, seq=9)]
    got = sorted((r.id, r.timestamp, r.seq) for r in T.cooldown(ticks_df(spark, rows)).collect())
    assert got == [("a", at(0), None), ("a", at(4000), 7), ("b", at(0), 9)]
    bare = ticks_df(spark, rows).drop("seq")
    assert T.cooldown(bare).count() == 3
    assert T.cooldown(bare).columns == bare.columns


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_without_a_zone_are_utc(spark, zone):
    texts = ["2026-01-01T00:00:00", "2026-01-01T00:00:00Z", "2026-01-01T02:00:00+02:00", "2026-01-01", "soon", None]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = C.parse_time(spark.createDataFrame([(t,) for t in texts], "timestamp string"))
        assert [str(r.timestamp) for r in df.collect()] == ["2026-01-01 00:00:00"] * 4 + ["None"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_every_command_has_an_outcome(spark):
    rows = [("e", "a", "upsert", 1.0, "rise", at(5), 1), ("e", "a", "upsert", 1.0, "rise", None, 2), (None, "a", "upsert", 1.0, "rise", at(6), 3),
            (None, "a", "delete", 1.0, "rise", at(7), 4), ("e", None, "upsert", 1.0, "rise", None, None), ("e", None, "delete", 1.0, "rise", None, None)]
    log = spark.createDataFrame(rows, SUBSCRIPTION_COMMAND)
    got = K.with_outcome(log).collect()
    assert len(got) == len(rows)
    assert {(r.email, r.coin, r.seq): r.outcome for r in got if r.seq} == {
        ("e", "a", 1): "created", ("e", "a", 2): "updated", (None, "a", 3): "created", (None, "a", 4): "deleted"}
    assert {(r.email, r.coin) for r in K.apply_commands(log.where("seq is not null")).collect()} == {("e", "a")}


def test_outcomes_read_and_deal_out_the_log_once(spark, tmp_dir):
    rows = [(f"e{i % 7}", None if i % 5 == 0 else "a", None if i % 11 == 0 else "upsert" if i % 3 else "delete", 1.0, "rise", at(i * 3), i) for i in range(200)]
    spark.createDataFrame(rows, SUBSCRIPTION_COMMAND).write.parquet(f"{tmp_dir}/log")
    df = K.with_outcome(spark.read.schema(SUBSCRIPTION_COMMAND).parquet(f"{tmp_dir}/log"))
    found, last = {r.seq: r.outcome for r in df.collect()}, {}
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") == 1
    for email, coin, op, _, _, _, seq in rows:
        after = last.get((email, coin)) == "upsert"
        assert found[seq] == (("updated" if after else "created") if op == "upsert" else "deleted" if after else "noop"), (seq, op)
        last[email, coin] = op


def test_replay_with_less_or_nothing(spark, tmp_dir):
    df = ticks_df(spark, [tick("a", i * 90_000, change=1.0, seq=i) for i in range(4)])
    for date_from in (None, "timestamp"):
        path = f"{tmp_dir}/{date_from}"
        append_batch(df, 0, path, "s", date_from=date_from)
        append_batch(df.where("seq = 2"), 0, path, "s", date_from=date_from)
        assert [r.seq for r in read_table(spark, path).collect()] == [2]
        append_batch(df.where("false"), 0, path, "s", date_from=date_from, skip_empty=False)
        append_batch(df.where("false"), 0, path, "s", date_from=date_from)
        assert read_table(spark, path, schema=TICK).count() == 0


def test_history_before_the_first_write(spark, tmp_dir):
    assert C.scan_ticks(spark, f"{tmp_dir}/none", since=at(0)).schema == TICK
    assert read_table(spark, f"{tmp_dir}/none", schema=TICK).count() == 0


def test_interrupted_compaction_goes_on(spark, tmp_dir, monkeypatch):
    import marketpulse.streaming.sinks as sinks
    path = f"{tmp_dir}/h"
    for b in range(3):
        append_batch(ticks_df(spark, [tick("a", b, change=1.0, seq=b)]), b, path, "s", date_from="timestamp")
    day = str(at(0).date())
    real = sinks.file_system

    class Dies:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "rename":
                raise RuntimeError("lost")
            return getattr(self.fs, name)
    monkeypatch.setattr(sinks, "file_system", lambda *a: (Dies(real(*a)[0]), real(*a)[1]))
    with pytest.raises(RuntimeError):
        compact_date(spark, path, day)
    monkeypatch.setattr(sinks, "file_system", real)
    compact_date(spark, path, day)
    assert sorted(r.seq for r in read_table(spark, path).collect()) == [0, 1, 2]


def test_alert_match_without_broadcast(spark):
    cooled = ticks_df(spark, [tick(c, i, price=1.0, change=x, seq=i) for i, (c, x) in enumerate([("a", 70.0), ("a", -3.5), ("b", 0.4), ("b", 2.0), ("a", -0.2)])])
    subs = spark.createDataFrame([(f"{i}@x", "ab"[i % 2], [None, -1.0, 0.1, 0.4, 2.0, 3.5, 50.0, 70.0, 99.0][i % 9], ["drop", "rise"][i // 2 % 2], at(0)) for i in range(72)], SUBSCRIPTION)
    want = sorted(map(repr, J.match_alerts(cooled, subs).collect()))
    brute = sum((t.price_change_pct_24h <= -th if d == "drop" else t.price_change_pct_24h >= th)
                for t in cooled.collect() for s in subs.collect() for th in [2.0 if s.threshold is None else s.threshold] for d in [s.direction]
                if s.coin == t.id and d == ("drop" if t.price_change_pct_24h < 0 else "rise"))
    assert len(want) == brute > 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = J.match_alerts(cooled, subs)
        assert sorted(map(repr, df.collect())) == want
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_band" in plan.split("SortMergeJoin")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_gap_in_bounded_runs(spark):
    from marketpulse.functions.time import EPOCH
    df = ticks_df(spark, [tick("a", 0, price=1.0, seq=1)]).unionByName(ticks_df(spark, [tick("a", 400 * 86_400, price=2.0, seq=2)]))
    n = W.resample_ffill(df, "1 minute", values=["current_price"]).groupBy("current_price").count().collect()
    assert {r.current_price: r["count"] for r in n} == {1.0: 400 * 1440, 2.0: 1}
    far = df.withColumn("timestamp", F.when(F.col("seq") == 1, F.lit(EPOCH)).otherwise(F.lit("9990-01-01")).cast("timestamp_ntz"))
    assert W.resample_ffill(far, "1 minute", values=["current_price"]).limit(3).count() == 3


def test_cards_and_sparklines_scan_once(spark, tmp_dir):
    ticks_df(spark, [tick("ab"[i % 2], i * 600, price=float(i), change=float(i - 3), seq=i) for i in range(20)]).write.parquet(f"{tmp_dir}/t")
    for operator in (W.coin_cards, W.sparklines):
        df = operator(spark.read.parquet(f"{tmp_dir}/t"))
        df.collect()
        assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") == 1


def test_scores_are_not_rounded_and_rows_not_merged(spark):
    lexicon = spark.createDataFrame([("good", 0.100000001), ("Good", 0.100000001), ("bad", -0.5)], "word string, polarity double")
    rows = [(1, "good"), (1, "bad bad"), (2, ""), (None, "good")]
    got = sorted((repr(r.doc_id), r.sentiment_score, r.sentiment_label) for r in X.score_text(spark.createDataFrame(rows, "doc_id long, text string"), lexicon).collect())
    assert got == [("1", -0.5, "negative"), ("1", 0.100000001, "positive"), ("2", 0.0, "neutral"), ("None", 0.100000001, "positive")]


def test_tick_job_by_processing_time(spark, tmp_dir):
    import json
    os.makedirs(f"{tmp_dir}/in")
    batches = [[("a", "bad", 3.0, 1), ("a", "2024-01-01T00:00:00Z", 4.0, 2), (None, "2024-01-01T00:00:00Z", 4.0, 3)], [("a", "2031-01-01T00:00:00Z", 5.0, 4)],
               [("a", "2024-01-01T00:00:01Z", 6.0, 5)]]
    for i, batch in enumerate(batches):
        with open(f"{tmp_dir}/in/{i}.json", "w") as f:
            f.writelines(json.dumps({"id": c, "timestamp": t, "price_change_pct_24h": x, "seq": s}) + "\n" for c, t, x, s in batch)
        os.utime(f"{tmp_dir}/in/{i}.json", (i + 1, i + 1))
    ticks = C.decode(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_dir}/in"), TICK_WIRE_SEQ)
    subs = spark.createDataFrame([("s@x", "a", 1.0, "rise", at(0))], SUBSCRIPTION)
    ST.run_to_end(ST.tick_job(ticks, f"{tmp_dir}/h", f"{tmp_dir}/a", f"{tmp_dir}/d", lambda: subs, f"{tmp_dir}/c", clock="processing",
                              arrival=F.when(F.col("seq") <= 3, F.lit(at(0))).when(F.col("seq") == 4, F.lit(at(1800))).otherwise(F.lit(at(3600))).cast("timestamp_ntz"),
                              available_now=True))
    # batch 0: the tick with a time is first in order; batch 1 is inside the cooldown whatever its time; batch 2 is ready
    assert sorted(r.change for r in read_table(spark, f"{tmp_dir}/a").collect()) == [4.0, 6.0]
    assert [r.reason for r in read_table(spark, f"{tmp_dir}/d").collect()] == ["no id"]


def test_long_gap_spreads_over_tasks(spark):
    """Two ticks 56 years apart, at one minute: no task makes more than a few shares of the 29 million buckets."""
    from marketpulse.functions.time import EPOCH
    df = ticks_df(spark, [tick("a", 0, price=1.0, seq=1), tick("a", 2 * 366 * 86_400, price=2.0, seq=2)])
    df = df.withColumn("timestamp", F.when(F.col("seq") == 1, F.lit(EPOCH).cast("timestamp_ntz")).otherwise(F.col("timestamp")))
    sizes = [r["count"] for r in W.resample_ffill(df, "1 minute", values=["current_price"]).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and sum(sizes) > 29_000_000 and max(sizes) < 2 * min(sizes)


def test_polarity_just_above_the_bound(spark):
    lexicon = spark.createDataFrame([("up", 0.1000000004), ("down", -0.1000000004), ("flat", 0.1), (None, 1.0)], "word string, polarity double")
    texts = spark.createDataFrame([(1, "Up!"), (2, "down"), (3, "flat"), (4, None), (5, "up flat, UP other")], "doc_id long, text string")
    want = [(1, 0.1000000004, "positive"), (2, -0.1000000004, "negative"), (3, 0.1, "neutral"), (4, 0.0, "neutral"), (5, (0.1000000004 + 0.1 + 0.1000000004) / 3, "positive")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "10"):  # in place, and by a join
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert sorted(tuple(r) for r in X.score_text(texts, lexicon).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_articles_that_repeat_are_matched_row_by_row(spark):
    topics = spark.createDataFrame([("t", ["one", "Two"]), ("u", ["one"]), ("none", []), (None, ["one"])], "coin string, terms array<string>")
    rows = [(1, "one two", "2024"), (1, "one two", "2024"), (2, "one", "2025"), (2, "two", "2025"), (3, "TWO, one", None), (None, "one two three", "2023"), (4, None, "2026")]
    articles = spark.createDataFrame(rows, "doc_id long, text string, published_at string")
    want = {("t", 1): 1, ("t", 1, 2): 2, ("t", None): 3, ("t", 3): 4}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "10"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = X.select_articles(articles, topics, None, keep=("text",)).collect()
            assert sorted((r.rank, r.doc_id, r.text) for r in got if r.topic == "t") == [(1, 1, "one two"), (2, 1, "one two"), (3, None, "one two three"), (4, 3, "TWO, one")]
            assert [r.doc_id for r in sorted(got, key=lambda r: r.rank) if r.topic == "u"] == [2, 1, 1, None, 3] and {r.topic for r in got} == {"t", "u"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top_k_state_across_polls(spark):
    topics = spark.createDataFrame([("t", ["one"])], "coin string, terms array<string>")
    rows = [(i, f"one {i}", f"20{10 + i}") for i in range(12)]
    polls = [X.select_articles(spark.createDataFrame(part, "doc_id long, text string, published_at string"), topics, None, 4) for part in (rows[:7], rows[5:9], rows[2:])]
    state = polls[0]
    for poll in polls[1:]:
        state = X.newest_across_polls(state, poll, 4)
    whole = X.select_articles(spark.createDataFrame(rows, "doc_id long, text string, published_at string"), topics, None, 4)
    assert rows_of(state) == rows_of(whole) and whole.count() == 4


def test_ticks_without_a_sequence(spark):
    bare = ticks_df(spark, [tick("a", 0, price=1.0, vol=2, seq=1), tick("a", 4000, price=None, vol=None, seq=2)]).drop("seq")
    assert rows_of(S.latest_by_coin(bare), "id", "current_price") == [("a", 1.0)] and rows_of(S.last_volume(bare), "total_volume") == [(None,)]
    assert W.resample_ffill(bare).count() == 3 and W.coin_cards(bare).count() == 1 and S.market_share(bare).count() == 0


def test_entry_without_the_llm_subpackage(tmp_dir):
    target = f"{tmp_dir}/repo"
    shutil.copytree(REPO, target, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cooldown' in q and 'pipeline' not in q and set(q) == set(e.oracle_sql())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=target, check=True, timeout=120, env=env)
