"""Property-based checks (hypothesis): the distributed cooldown equals the
sequential rule, and resample + fill equals pandas, on generated series."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketpulse.operators import cooldown as T
from marketpulse.operators import timeseries as W
from tests.helpers import rows_of, tick, ticks_df
from tests.test_cooldown_alerts import sequential_cooldown

GAPS = st.sampled_from([0, 1, 59, 600, 1799, 1800, 3599, 3600, 3601, 7200, 40_000])
CHANGES = st.sampled_from([None, 0.0, 1.5, -2.0])
SERIES = st.lists(st.tuples(st.sampled_from("abc"), GAPS, CHANGES, st.one_of(st.none(), st.floats(1, 100))),
                  min_size=1, max_size=120)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _rows(series):
    clock, rows = {}, []
    for i, (coin, gap, change, price) in enumerate(series):
        clock[coin] = clock.get(coin, 0) + gap
        rows.append(tick(coin, clock[coin], price=price, change=change, seq=i))
    return rows


@SETTINGS
@given(series=SERIES)
def test_cooldown_equals_sequential_rule(spark, series):
    rows = _rows(series)
    got = sorted(r["seq"] for r in T.cooldown(ticks_df(spark, rows)).select("seq").collect())
    assert got == sequential_cooldown(rows)


@SETTINGS
@given(series=SERIES)
def test_resample_ffill_equals_pandas(spark, series):
    rows = _rows(series)
    got = rows_of(W.resample_ffill(ticks_df(spark, rows), values=["current_price"]), "id", "bucket", "current_price")
    pdf = pd.DataFrame([(r[0], r[6], r[2], r[7]) for r in rows], columns=["id", "timestamp", "current_price", "seq"])
    expected = []
    for coin, g in pdf.groupby("id"):
        g = g.sort_values(["timestamp", "seq"]).set_index("timestamp")[["current_price"]]
        s = g.resample("30min").last().ffill()
        for ts, v in s["current_price"].items():
            expected.append((coin, ts.to_pydatetime(), None if pd.isna(v) else float(v)))
    assert got == sorted(expected, key=repr)


COMMANDS = st.lists(st.tuples(st.sampled_from(["u1@e", "u2@e"]), st.sampled_from("ab"),
                              st.sampled_from(["upsert", "upsert", "delete"]), st.integers(1, 50),
                              st.sampled_from(["drop", "rise"]), st.integers(0, 30)), min_size=1, max_size=60)


@SETTINGS
@given(commands=COMMANDS)
def test_subscription_fold_equals_replay(spark, commands):
    from marketpulse.operators import subscriptions as K
    from marketpulse.schemas import SUBSCRIPTION_COMMAND
    from tests.helpers import at
    from tests.test_subscriptions import replay
    cmds = [(e, c, op, float(t), d, at(secs * 20), i) for i, (e, c, op, t, d, secs) in enumerate(commands)]
    df = spark.createDataFrame(cmds, SUBSCRIPTION_COMMAND)
    state, outcomes = replay(cmds)
    assert rows_of(K.apply_commands(df), "email", "coin", "threshold", "direction", "created_at") == sorted(state, key=repr)
    assert sorted(rows_of(K.with_outcome(df, chunk_seconds=30, day_seconds=200), "seq", "outcome")) == outcomes


@SETTINGS
@given(series=st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 50)),
                                 st.one_of(st.none(), st.floats(1, 100)), st.one_of(st.none(), st.floats(-5, 5))),
                       min_size=1, max_size=50))
def test_latest_equals_pandas_groupby_last(spark, series):
    from marketpulse.operators import snapshot as S
    rows = [tick(c, None if m is None else m * 60, price=p, change=ch, seq=i) for i, (c, m, p, ch) in enumerate(series)]
    got = {r["id"]: (r["current_price"], r["price_change_pct_24h"], r["timestamp"])
           for r in S.latest_by_coin(ticks_df(spark, rows)).collect()}
    pdf = pd.DataFrame([(r[0], r[2], r[3], r[6], r[7]) for r in rows],
                       columns=["id", "current_price", "price_change_pct_24h", "timestamp", "seq"])
    last = pdf.sort_values(["timestamp", "seq"], na_position="last").groupby("id").last()

    def nn(v):
        return None if pd.isna(v) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v)

    want = {i: (nn(r["current_price"]), nn(r["price_change_pct_24h"]), nn(r["timestamp"])) for i, r in last.iterrows()}
    assert got == want
