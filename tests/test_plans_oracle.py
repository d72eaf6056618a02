"""Every registered query against its DuckDB oracle (sf0.001), and plan checks:
no Python evaluation anywhere, filters and column pruning reach the scan."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from marketpulse.plans import catalog

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, duck_rows, duck_types, spark_rows, spark_types  # noqa: E402

from tests.conftest import SF_SMALL  # noqa: E402

BATCH_QUERIES = [n for n in catalog.QUERIES if not n.startswith(("stream_", "tick_job", "sentiment_job"))]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got, want = E.queries()[name](spark, SF_SMALL), duck.sql(E.oracle_sql()[name])
    assert spark_types(got) == duck_types(want)
    assert spark_rows(got) == duck_rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "current_price" in df.columns


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_in_plan(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in plan


def test_filter_reaches_scan(spark):
    plan = E.queries()["detail_series"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan.split("PushedFilters: ", 1)[1].split("]", 1)[0]


def test_columns_pruned_at_scan(spark):
    plan = E.queries()["freshness"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def _plan(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_alert_join_broadcasts_cooled_ticks(spark):
    for name in ("match_alerts", "alert_outbox"):
        plan = _plan(spark, name)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, name


def test_unsent_alerts_are_found_where_they_are_stored(spark):
    plan = _plan(spark, "alerts_unsent")  # both copies of the outbox and its receipts are read, and not moved
    assert "Exchange" not in plan and plan.count("FileScan") == 3


def test_texts_are_scored_and_matched_in_place(spark):
    assert "Exchange" not in _plan(spark, "score_text")
    plan = _plan(spark, "select_articles")  # only the top-k of each topic is moved
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in _plan(spark, "select_articles")


def test_resample_combines_before_the_window(spark):
    plan = _plan(spark, "resample_ffill")
    # partial aggregate on (coin, bucket) first; the window shuffle sees only occupied buckets
    assert plan.index("hashpartitioning(id") < plan.rindex("partial_max_by")


def test_cooldown_never_shuffles_ticks_by_coin_alone(spark, monkeypatch):
    import re

    import marketpulse.operators.cooldown as cd
    from marketpulse.plans import views as V

    plans = {}
    original = cd.materialize

    def spy(df, name, scratch=None):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return original(df, name, scratch)

    monkeypatch.setattr(cd, "materialize", spy)
    cd.cooldown(V.ticks(spark, SF_SMALL))
    assert {"cooldown-instants", "cooldown-level-0"} <= set(plans)
    for name, plan in plans.items():  # the only window by coin runs on one row per occupied bucket
        for shuffle in re.findall(r"hashpartitioning\(key#\d+, \d+\)[^\n]*\n[^\n]*", plan):
            assert "Aggregate" in shuffle, (name, shuffle)
