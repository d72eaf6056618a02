"""Snapshots (A3, A4, A9, A10) and time series (W1-W3) on edge rows, plus a
cross-model check of resample + fill against pandas."""

import random

import pandas as pd
import pytest

from marketpulse.operators import snapshot as S
from marketpulse.operators import timeseries as W
from tests.helpers import T0, at, rows_of, tick, ticks_df


def test_latest_is_last_non_null_per_column(spark):
    df = ticks_df(spark, [
        tick("a", 0, price=1.0, change=1.0, seq=1),
        tick("a", 10, price=None, change=2.0, seq=2),     # last row null in price -> older value
        tick("b", 0, price=5.0, seq=3),
        tick("b", None, price=6.0, seq=4),                 # null time sorts last and wins
        tick(None, 50, price=9.0, seq=5),                  # null id dropped
    ])
    got = {r["id"]: r for r in S.latest_by_coin(df).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["current_price"] == 1.0 and got["a"]["price_change_pct_24h"] == 2.0
    assert got["b"]["current_price"] == 6.0 and got["b"]["timestamp"] == at(0)


def test_last_volume_is_last_row(spark):
    df = ticks_df(spark, [tick("a", 0, vol=10, seq=1), tick("a", 5, vol=None, seq=2)])
    assert rows_of(S.last_volume(df), "id", "total_volume") == [("a", None)]


def test_market_share(spark):
    df = ticks_df(spark, [tick("a", 0, cap=30, seq=1), tick("b", 0, cap=10, seq=2), tick("c", 0, cap=None, seq=3)])
    assert rows_of(S.market_share(df), "id", "share") == [("a", 0.75), ("b", 0.25)]
    zero = ticks_df(spark, [tick("a", 0, cap=0, seq=1), tick("b", 0, cap=0, seq=2)])
    assert rows_of(S.market_share(zero), "id", "share") == [("a", None), ("b", None)]


@pytest.mark.parametrize("prices,padding,expected", [
    ([100.0, 100.0], 0.02, (99.0, 101.0)),
    ([90.0, 110.0], 0.02, (89.6, 110.4)),
    ([90.0, 110.0], 0.15, (87.0, 113.0)),
])
def test_tight_range(spark, prices, padding, expected):
    df = spark.createDataFrame([("a", p) for p in prices], "id string, current_price double")
    r = W.tight_range(df, padding).first()
    assert r["range_low"] == pytest.approx(expected[0]) and r["range_high"] == pytest.approx(expected[1])


def test_resample_edges(spark):
    df = ticks_df(spark, [
        tick("a", 0, price=None, seq=1),          # leading null stays null
        tick("a", 1800, price=2.0, seq=2),        # exactly on an edge -> later bucket
        tick("a", 1900, price=None, seq=3),       # null in last row of bucket -> earlier value
        tick("a", 3 * 1800 + 1800, price=5.0, seq=4),  # gap of 2 empty buckets
        tick("a", None, price=99.0, seq=5),       # null time ignored
        tick("b", 100, price=7.0, seq=6),         # single tick -> one bucket
    ])
    last = rows_of(W.resample_last(df, values=["current_price"]), "id", "bucket", "current_price")
    assert last == sorted([("a", at(0), None), ("a", at(1800), 2.0), ("a", at(3600), None), ("a", at(5400), None),
                           ("a", at(7200), 5.0), ("b", at(0), 7.0)], key=repr)
    filled = rows_of(W.resample_ffill(df, values=["current_price"]), "id", "bucket", "current_price")
    assert filled == sorted([("a", at(0), None), ("a", at(1800), 2.0), ("a", at(3600), 2.0), ("a", at(5400), 2.0),
                             ("a", at(7200), 5.0), ("b", at(0), 7.0)], key=repr)


def test_width_must_divide_a_day():
    with pytest.raises(ValueError):
        W.width_seconds("7 hours")


def test_compare_base_rules(spark):
    df = ticks_df(spark, [
        tick("nullbase", 0, price=None, seq=1), tick("nullbase", 1800, price=3.0, seq=2),
        tick("zero", 0, price=0.0, seq=3), tick("zero", 1800, price=3.0, seq=4),
        tick("ok", 0, price=2.0, seq=5), tick("ok", 1800, price=3.0, seq=6),
        tick("single", 0, price=1.0, seq=7),
    ])
    got = rows_of(W.compare(df), "id", "bucket", "pct_change")
    assert got == sorted([("nullbase", at(0), None), ("nullbase", at(1800), None), ("zero", at(0), None),
                          ("zero", at(1800), None), ("ok", at(0), 0.0), ("ok", at(1800), 50.0)], key=repr)


def test_resample_ffill_matches_pandas(spark):
    rnd = random.Random(7)
    rows, seq = [], 0
    for coin in ["x", "y", "z"]:
        t = rnd.randint(0, 5000)
        for _ in range(rnd.randint(1, 60)):
            t += rnd.choice([5, 60, 700, 1800, 4000, 9000])
            seq += 1
            price = None if rnd.random() < 0.2 else round(rnd.uniform(1, 100), 2)
            rows.append(tick(coin, t, price=price, seq=seq))
    got = rows_of(W.resample_ffill(ticks_df(spark, rows), values=["current_price"]), "id", "bucket", "current_price")
    pdf = pd.DataFrame([(r[0], r[6], r[2]) for r in rows], columns=["id", "timestamp", "current_price"])
    expected = []
    for coin, g in pdf.groupby("id"):
        s = g.sort_values("timestamp").set_index("timestamp")[["current_price"]].resample("30min").last().ffill()
        for ts, v in s["current_price"].items():
            expected.append((coin, ts.to_pydatetime(), None if pd.isna(v) else float(v)))
    assert got == sorted(expected, key=repr)
    assert T0.minute == 0


def test_tick_guard_counts_rows_with_null_time(spark):
    # one timed tick plus one without a time: two rows, so the series is shown
    df = ticks_df(spark, [tick("a", 0, price=2.0, seq=1), tick("a", None, price=3.0, seq=2),
                          tick("b", 0, price=1.0, seq=3)])
    got = rows_of(W.sparklines(df), "id", "bucket", "current_price")
    assert got == [("a", at(0), 2.0)]


@pytest.mark.parametrize("seed", [3, 4])
def test_latest_matches_pandas_groupby_last(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for seq in range(300):
        secs = None if rnd.random() < 0.05 else rnd.randint(0, 10_000) * 7 + seq % 7  # distinct non-null times
        rows.append(tick(rnd.choice(["a", "b", "c", None]), secs,
                         price=None if rnd.random() < 0.3 else float(rnd.randint(1, 99)),
                         change=None if rnd.random() < 0.3 else float(rnd.randint(-5, 5)), seq=seq))
    got = {r["id"]: (r["current_price"], r["price_change_pct_24h"], r["timestamp"])
           for r in S.latest_by_coin(ticks_df(spark, rows)).collect()}
    pdf = pd.DataFrame([(r[0], r[2], r[3], r[6], r[7]) for r in rows],
                       columns=["id", "current_price", "price_change_pct_24h", "timestamp", "seq"])
    last = pdf.sort_values(["timestamp", "seq"], na_position="last").groupby("id").last()
    want = {i: (None if pd.isna(r["current_price"]) else r["current_price"],
                None if pd.isna(r["price_change_pct_24h"]) else r["price_change_pct_24h"],
                r["timestamp"].to_pydatetime()) for i, r in last.iterrows()}
    assert got == want


def test_width_forms():
    assert W.width_seconds("30 minutes") == W.width_seconds("30min") == W.width_seconds(1800) == 1800
    assert W.width_seconds("1h") == W.width_seconds("1 hour") == 3600
    with pytest.raises(ValueError):
        W.width_seconds("30 fortnights")
