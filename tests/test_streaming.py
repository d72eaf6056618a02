"""Streaming: idempotent sinks (K1), stream = batch, restart from checkpoint."""

import os
import random
import weakref

import pandas as pd
from pyspark.sql import functions as F

from marketpulse.operators import cooldown as T
from marketpulse.schemas import TICK_WIRE_SEQ
from marketpulse.sources import codec as C
from marketpulse.streaming import jobs as ST
from marketpulse.streaming.sinks import append_batch, read_table
from tests.helpers import rows_of, tick, ticks_df


def test_same_batch_twice_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    out = f"{tmp_dir}/t"
    assert append_batch(df, 0, out, "s0") == 2
    assert append_batch(df, 0, out, "s0") == 2          # replay of batch 0
    assert read_table(spark, out).count() == 2
    append_batch(df, 0, out, "s1")                      # same batch id under a new checkpoint
    assert read_table(spark, out).count() == 4
    assert append_batch(df.limit(0), 1, out, "s1") == 0  # empty batch: nothing written
    assert not os.path.exists(f"{out}/stream_id=s1/batch_id=1")


def _tick_rows():
    rows, seq = [], 0
    for coin in ["a", "b"]:
        for i in range(120):
            seq += 1
            rows.append(tick(coin, i * 700 + (seq % 3), price=float(i), change=(-1.0) ** i * (1 + i % 4), seq=seq))
    return rows


def _write_message_files(spark, rows, folder, parts=3):
    df = ticks_df(spark, rows).orderBy("timestamp", "seq")
    msgs = C.encode(df, micros=True).collect()
    n = len(msgs)
    for p in range(parts):
        chunk = msgs[p * n // parts:(p + 1) * n // parts]
        path = f"{folder}/part-{p}.json"
        with open(path, "w") as fh:
            fh.write("\n".join(r["value"] for r in chunk) + "\n")
        os.utime(path, (1_700_000_000 + p * 10, 1_700_000_000 + p * 10))  # files are taken in mtime order


def _stream(spark, folder):
    return C.decode(spark.readStream.option("maxFilesPerTrigger", 1).text(folder), TICK_WIRE_SEQ)


def test_cooldown_stream_equals_batch_and_survives_restart(spark, tmp_dir):
    rows = _tick_rows()
    expected = sorted(r["seq"] for r in T.cooldown(ticks_df(spark, rows)).collect())

    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write_message_files(spark, rows, src)
    ST.run_to_end(ST.cooldown_stream(_stream(spark, src), f"{tmp_dir}/o1", f"{tmp_dir}/c1",
                                     available_now=True))
    whole = sorted(r["seq"] for r in read_table(spark, f"{tmp_dir}/o1").collect())
    assert whole == expected

    # restart: first file only, stop, then the rest with the same checkpoint
    src2 = f"{tmp_dir}/src2"
    os.makedirs(src2)
    staged = f"{tmp_dir}/staged"
    os.makedirs(staged)
    _write_message_files(spark, rows, staged)
    os.rename(f"{staged}/part-0.json", f"{src2}/part-0.json")
    ST.run_to_end(ST.cooldown_stream(_stream(spark, src2), f"{tmp_dir}/o2", f"{tmp_dir}/c2",
                                     available_now=True))
    for p in (1, 2):
        os.rename(f"{staged}/part-{p}.json", f"{src2}/part-{p}.json")
    ST.run_to_end(ST.cooldown_stream(_stream(spark, src2), f"{tmp_dir}/o2", f"{tmp_dir}/c2",
                                     available_now=True))
    resumed = sorted(r["seq"] for r in read_table(spark, f"{tmp_dir}/o2").collect())
    assert resumed == expected


def test_resample_stream_emits_closed_buckets(spark, tmp_dir):
    rows = _tick_rows()
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write_message_files(spark, rows, src)
    q = (ST.resample_stream(_stream(spark, src), delay="1 hour").writeStream.outputMode("append").format("parquet")
         .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    ST.run_to_end(q)
    out = spark.read.parquet(f"{tmp_dir}/out")
    last = max(r[6] for r in rows)
    assert out.count() > 0
    assert all((last - r["bucket"]).total_seconds() >= 1800 + 3600 for r in out.collect())


def test_history_scan_prunes_dates(spark, tmp_dir):
    from marketpulse.sources.codec import scan_ticks
    rows = _tick_rows()
    hist = f"{tmp_dir}/hist"
    append_batch(ticks_df(spark, rows), 0, hist, "s0", date_from="timestamp")
    df = scan_ticks(spark, hist, since="2024-01-01 06:00:00", until="2024-01-01 12:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    got = sorted(r["seq"] for r in df.select("seq").collect())
    want = sorted(r[7] for r in rows if r[6] is not None and "2024-01-01 06:00:00" <= str(r[6]) < "2024-01-01 12:00:00")
    assert got == want and got


def test_kafka_options_and_preview(spark, tmp_dir, capsys):
    opts = C.kafka_options("broker:9092", "ticks", max_offsets_per_trigger=1000)
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "ticks", "startingOffsets": "latest",
                    "maxOffsetsPerTrigger": "1000"}
    append_batch(spark.createDataFrame([(1,)], "x int"), 0, f"{tmp_dir}/p", "s0", preview=True)
    assert "| x|" in capsys.readouterr().out.replace(" ", "").replace("|x|", "| x|")


def test_tick_job_over_three_batches_equals_batch(spark, tmp_dir):
    from marketpulse.operators import alerts as J
    from marketpulse.schemas import SUBSCRIPTION
    from tests.helpers import at
    rows = _tick_rows()
    subs = spark.createDataFrame([("x@e", "a", 1.5, "drop", at(0)), ("y@e", "a", None, "rise", at(0)),
                                  ("z@e", "b", 3.0, "rise", at(0))], SUBSCRIPTION)
    expected = sorted((r["email"], r["coin"], str(r["timestamp"]))
                      for r in J.match_alerts(T.cooldown(ticks_df(spark, rows)), subs).collect())
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write_message_files(spark, rows, src)
    q = ST.tick_job(_stream(spark, src), f"{tmp_dir}/h", f"{tmp_dir}/a", f"{tmp_dir}/d",
                    lambda: subs, f"{tmp_dir}/c", available_now=True)
    ST.run_to_end(q)
    got = sorted((r["email"], r["coin"], str(r["timestamp"])) for r in read_table(spark, f"{tmp_dir}/a").collect())
    assert got == expected and got
    assert read_table(spark, f"{tmp_dir}/h").count() == len(rows)
    assert len({r["batch_id"] for r in read_table(spark, f"{tmp_dir}/h", keep_batch_columns=True).collect()}) == 3


def test_sentiment_job_one_summary_per_batch(spark, tmp_dir):
    import json
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    batches = [[("btc", 0.5), ("btc", None), ("eth", -1.0)], [("btc", 1.0)]]
    for b, arts in enumerate(batches):
        path = f"{src}/part-{b}.json"
        with open(path, "w") as fh:
            for coin, score in arts:
                fh.write(json.dumps({"coin": coin, "title": "t", "sentiment_score": score,
                                     "timestamp": "2024-01-01T00:00:00Z"}) + "\n")
        os.utime(path, (1_700_000_000 + b * 10, 1_700_000_000 + b * 10))
    arts = C.decode_articles(spark.readStream.option("maxFilesPerTrigger", 1).text(src))
    ST.run_to_end(ST.sentiment_job(arts, f"{tmp_dir}/raw", f"{tmp_dir}/sum", f"{tmp_dir}/ck",
                                   as_of=lambda b: f"2024-01-0{b + 1} 00:00:00", available_now=True))
    got = sorted((str(r["timestamp"]), r["coin"], r["avg_sentiment"], r["article_count"])
                 for r in read_table(spark, f"{tmp_dir}/sum").collect())
    assert got == [("2024-01-01 00:00:00", "btc", 0.5, 2), ("2024-01-01 00:00:00", "eth", -1.0, 1),
                   ("2024-01-02 00:00:00", "btc", 1.0, 1)]
    assert read_table(spark, f"{tmp_dir}/raw").count() == 4


def test_scratch_release_frees_tables(spark):
    from marketpulse.operators.cooldown import Scratch
    scratch = Scratch()
    rows = [tick("a", i * 4000, change=1.0, seq=i) for i in range(8)]
    kept = T.cooldown(ticks_df(spark, rows), scratch=scratch)
    assert kept.count() == 8 and scratch.paths
    paths = [p.replace("file:", "") for p in scratch.paths]
    scratch.release()
    assert not any(os.path.exists(p) for p in paths)


def test_compact_closed_date(spark, tmp_dir):
    from marketpulse.streaming.sinks import compact_date
    hist = f"{tmp_dir}/hist"
    rows = _tick_rows()
    chunks = [rows[i::3] for i in range(3)]
    for b, chunk in enumerate(chunks):
        append_batch(ticks_df(spark, chunk), b, hist, "s0", date_from="timestamp")
    before = sorted(r["seq"] for r in read_table(spark, hist).collect())
    day = sorted({str(r[6].date()) for r in rows})[0]
    n = compact_date(spark, hist, day)
    assert n > 0
    after = sorted(r["seq"] for r in read_table(spark, hist).collect())
    assert after == before
    batches = {r["batch_id"] for r in read_table(spark, hist, keep_batch_columns=True).where(f"date = '{day}'").collect()}
    assert batches == {-1}
    append_batch(ticks_df(spark, chunks[0][:3]), 9, hist, "s1", date_from="timestamp")  # a late stream, then compact again
    compact_date(spark, hist, day)
    assert {r["batch_id"] for r in read_table(spark, hist, keep_batch_columns=True).where(f"date = '{day}'").collect()} == {-2}
    assert read_table(spark, hist).count() == len(before) + 3


def test_resample_stream_equals_batch_on_closed_buckets(spark, tmp_dir):
    import datetime as dt

    from marketpulse.operators import timeseries as W
    rows = _tick_rows()
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write_message_files(spark, rows, src)
    values = ["current_price", "price_change_pct_24h", "total_volume"]
    q = (ST.resample_stream(_stream(spark, src), delay="1 hour").writeStream.outputMode("append").format("parquet")
         .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    ST.run_to_end(q)
    got = rows_of(spark.read.parquet(f"{tmp_dir}/out"), "id", "bucket", *values)
    closed_before = max(r[6] for r in rows) - dt.timedelta(hours=1, minutes=30)
    batch = W.resample_last(ticks_df(spark, rows), values=values).where(F.col("current_price").isNotNull()
                                                                         | F.col("price_change_pct_24h").isNotNull())
    want = [r for r in rows_of(batch, "id", "bucket", *values) if r[1] <= closed_before]
    assert got == want and got


def test_gap_filled_stream_equals_batch_over_batches(spark, tmp_dir):
    """Three files, one batch each: what the batch form makes of the ticks in closed buckets, filled or not."""
    import datetime as dt

    from marketpulse.operators import timeseries as W
    rows = [r if i % 5 else tick(r[0], 0, seq=r[7]) for i, r in enumerate(_tick_rows())]
    rows = [(*r[:4], 2 ** 60 + r[7] if r[7] % 3 else None, *r[5:]) for r in rows if (r[6] - rows[0][6]).total_seconds() % 20_000 < 9_000]
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write_message_files(spark, rows, src)
    values = ("current_price", "price_change_pct_24h", "market_cap")
    end = max(r[6] for r in rows) - dt.timedelta(hours=1)
    closed = [r for r in rows if (r[6].replace(minute=r[6].minute // 30 * 30, second=0, microsecond=0) + dt.timedelta(minutes=30)) <= end]
    for fill, batch in ((True, W.resample_ffill), (False, W.resample_last)):
        q = (ST.resample_stream(_stream(spark, src), delay="1 hour", values=values, fill=fill).writeStream.outputMode("append").format("parquet")
             .option("path", f"{tmp_dir}/out{fill}").option("checkpointLocation", f"{tmp_dir}/ck{fill}").trigger(availableNow=True).start())
        ST.run_to_end(q)
        got = rows_of(spark.read.parquet(f"{tmp_dir}/out{fill}"), "id", "bucket", *values)
        assert got == rows_of(batch(ticks_df(spark, closed), values=list(values)), "id", "bucket", *values)
        assert len(got) > len({(r[0], r[1]) for r in got if r[2] is not None}) or fill


def test_calls_per_batch_do_not_grow_with_the_dates(spark, tmp_dir, monkeypatch):
    """A replay finds its partitions by the batch's record: no listing, and as many calls with 3 dates as with 300."""
    from marketpulse.streaming import sinks
    monkeypatch.setattr(sinks, "delete_folders", None)  # the only function that lists
    batch = ticks_df(spark, [tick("a", 0, seq=1), tick("a", 86_400, seq=2), tick("a", None, seq=3)])
    calls = []
    for days in (3, 300):
        hist = f"{tmp_dir}/h{days}"
        append_batch(ticks_df(spark, [tick("a", i * 86_400, seq=i) for i in range(days)]), 0, hist, "s", date_from="timestamp")
        append_batch(batch, 1, hist, "s", date_from="timestamp")
        seen = []
        original = sinks.BatchRecord.read
        monkeypatch.setattr(sinks.BatchRecord, "read", lambda self: seen.append(original(self)) or seen[-1])
        append_batch(batch.where("seq = 1"), 1, hist, "s", date_from="timestamp")
        monkeypatch.setattr(sinks.BatchRecord, "read", original)
        calls.append([sorted(r["dates"]) for r in seen])
        assert sorted(r["seq"] for r in read_table(spark, hist).collect()) == sorted([*range(days), 1])
        append_batch(batch.where("false"), 1, hist, "s", date_from="timestamp")
        assert read_table(spark, hist).count() == days
    assert calls[0] == calls[1] == [["2024-01-01", "2024-01-02", "None"]]


def test_record_survives_a_failure_between_delete_and_rename(spark, tmp_dir):
    from marketpulse.streaming.sinks import BatchRecord
    record = BatchRecord(spark, f"{tmp_dir}/t", "s", 4)
    assert record.read() == {} and record.once("position", lambda: 7) == 7 and record.once("position", lambda: 9) == 7
    os.rename(f"{tmp_dir}/t/_batches/stream_id=s/batch_id=4", f"{tmp_dir}/t/_batches/stream_id=s/batch_id=4.new")
    assert record.read() == {"position": 7}


def test_replayed_batch_sees_the_same_subscriptions(spark, tmp_dir):
    from marketpulse.operators.subscriptions import SubscriptionLog
    from marketpulse.schemas import SUBSCRIPTION_COMMAND
    from tests.helpers import at
    log = SubscriptionLog(spark, f"{tmp_dir}/log", f"{tmp_dir}/state")
    assert log.position() == -1 and log.as_of(-1).count() == 0

    def say(*commands):
        spark.createDataFrame(commands, SUBSCRIPTION_COMMAND).write.mode("append").parquet(log.log_path)
    say(("x@e", "a", "upsert", 1.0, "rise", at(0), 0), ("y@e", "a", "upsert", 1.0, "rise", at(1), 1))
    assert log.advance() == 1 and log.advance() == 1
    say(("y@e", "a", "delete", None, None, at(2), 2), ("x@e", "a", "upsert", 3.0, "rise", at(3), 3))
    cooled = ticks_df(spark, [tick("a", 0, price=1.0, change=4.0, seq=1)])
    ST.write_alerts(cooled, log, 0, f"{tmp_dir}/a", "s")
    first = rows_of(read_table(spark, f"{tmp_dir}/a"), "email", "threshold")
    say(("x@e", "a", "delete", None, None, at(4), 4), ("z@e", "a", "upsert", 1.0, "rise", at(5), 5))
    log.advance()
    ST.write_alerts(cooled, log, 0, f"{tmp_dir}/a", "s")
    assert rows_of(read_table(spark, f"{tmp_dir}/a"), "email", "threshold") == first == [("x@e", 3.0)]
    ST.write_alerts(cooled, log, 1, f"{tmp_dir}/a2", "s")
    assert rows_of(read_table(spark, f"{tmp_dir}/a2"), "email", "threshold") == [("z@e", 1.0)]
    assert rows_of(log.as_of(3), "email", "created_at") == [("x@e", at(0))]
    plan = log.as_of(5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(seq,5)" in plan


def test_partials_equal_the_full_scan_and_read_no_history(spark, tmp_dir):
    from marketpulse.operators import snapshot as S
    rows = _tick_rows() + [tick("a", None, price=5.0, seq=900), tick("c", 5, vol=3, seq=901), tick("c", 6, price=None, vol=None, seq=902), tick(None, 7, price=1.0, seq=903)]
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write_message_files(spark, rows, src)
    subs = spark.createDataFrame([], "email string, coin string, threshold double, direction string")
    ST.run_to_end(ST.tick_job(_stream(spark, src), f"{tmp_dir}/h", f"{tmp_dir}/a", f"{tmp_dir}/d", lambda: subs, f"{tmp_dir}/c",
                              snapshot_path=f"{tmp_dir}/latest", available_now=True))
    hist, parts = read_table(spark, f"{tmp_dir}/h"), read_table(spark, f"{tmp_dir}/latest")
    assert parts.count() <= 3 * 4
    merged = S.from_partials(parts)
    full = S.latest_by_coin(hist)
    assert rows_of(merged, *full.columns) == rows_of(full, *full.columns)
    assert rows_of(merged, "id", "last_volume") == rows_of(S.last_volume(hist), "id", "total_volume")
    assert rows_of(merged, "id", "n_ticks") == rows_of(S.tick_counts(hist), "id", "n_ticks")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_dir}/latest" in plan and f"{tmp_dir}/h" not in plan


def test_stream_fold_does_not_hold_a_coins_ticks(monkeypatch):
    """A coin's ticks come in many parts: whatever their number, only a few are held at a time."""
    monkeypatch.setattr(ST, "FOLD_ROWS", 500)
    rnd, made, most, whole = random.Random(3), [], 0, []

    def parts():
        nonlocal most
        for i in range(60):
            rows = [(b, b + rnd.randint(0, 3), rnd.randint(0, 2), f"{i}-{j}" if rnd.random() < 0.7 else None) for j in range(100) for b in [10 * rnd.randint(0, 4)]]
            whole.extend(rows)
            part = pd.DataFrame(rows, columns=["b", "t", "s", "v"]).assign(none=None)
            made.append(weakref.ref(part))
            most = max(most, sum(r() is not None for r in made))
            yield part
            del part

    occupied, last = ST.last_values(("v", "none"))(parts())
    expected = {}
    for b, t, s, v in whole:  # of equal places the later row counts
        if v is not None and (b not in expected or expected[b][:2] <= (t, s)):
            expected[b] = (t, s, v)
    assert occupied == {b for b, *_ in whole}
    assert {r.b: (r.t, r.s, r.v) for r in last["v"].itertuples()} == expected
    assert len(last["none"]) == 0
    assert most <= 10


def test_gap_filled_stream_in_small_blocks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ST, "FOLD_ROWS", 7)
    test_gap_filled_stream_equals_batch_over_batches(spark, tmp_dir)
