"""Named queries over the driver tables and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over whole fixture views; every
computed column is aliased to the same name in its oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.constants import DROP_FORM_LABEL, RANGE_PADDING, SPARKLINE_PADDING, UNKNOWN_SOURCE
from marketpulse.functions import labels as P
from marketpulse.operators import alerts as J
from marketpulse.operators import cooldown as T
from marketpulse.operators import sentiment as X
from marketpulse.operators import snapshot as S
from marketpulse.operators import subscriptions as K
from marketpulse.operators import timeseries as W
from marketpulse.plans import fixtures as FX
from marketpulse.plans import views as V
from marketpulse.plans.oracle import (ARTICLE_CTE, COMMANDS_CTE, EDGE_CTE, LEXICON_CTE, NULL_COMMANDS_CTE, SUBS_CTE, TICK_CTE,
                                      TOPIC_CTE, with_)
from marketpulse.schemas import TICK, TICK_WIRE_SEQ
from marketpulse.session import scratch_path
from marketpulse.sources import codec as C
from marketpulse.sources import ingest as IN
from marketpulse.sources import payloads as PL
from marketpulse.streaming import jobs as ST
from marketpulse.streaming.sinks import append_batch, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DETAIL_COIN = "view"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- snapshot
def _arg_last_nonnull(c: str) -> str:
    return (f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN "
            f"struct_pack(n := \"timestamp\" IS NULL, t := \"timestamp\", s := seq) END) AS {c}")


@register("latest_by_coin", with_(TICK_CTE) + f"""
SELECT id, {_arg_last_nonnull('symbol')}, {_arg_last_nonnull('current_price')},
       {_arg_last_nonnull('price_change_pct_24h')}, {_arg_last_nonnull('market_cap')},
       {_arg_last_nonnull('total_volume')}, max("timestamp") AS "timestamp"
FROM tick WHERE id IS NOT NULL GROUP BY id""")
def q_latest_by_coin(spark, sf_dir):
    return S.latest_by_coin(V.ticks(spark, sf_dir))


@register("last_volume", with_(TICK_CTE) + """,
lv AS (SELECT id, arg_max_null(total_volume, struct_pack(n := "timestamp" IS NULL, t := "timestamp", s := seq))
              AS total_volume FROM tick WHERE id IS NOT NULL GROUP BY id)
SELECT id, total_volume, '$' || format('{:.2f}', total_volume / 1e9) || 'B' AS volume_label FROM lv""")
def q_last_volume(spark, sf_dir):
    return S.last_volume(V.ticks(spark, sf_dir))


@register("coins", with_(TICK_CTE) + "SELECT DISTINCT id FROM tick WHERE id IS NOT NULL")
def q_coins(spark, sf_dir):
    return S.coins(V.ticks(spark, sf_dir))


@register("freshness", with_(TICK_CTE) + 'SELECT max("timestamp") AS last_updated FROM tick')
def q_freshness(spark, sf_dir):
    return S.freshness(V.ticks(spark, sf_dir))


@register("coins_with_history", with_(TICK_CTE) + """
SELECT id, count(*) AS n_ticks FROM tick WHERE id IS NOT NULL GROUP BY id HAVING count(*) >= 2""")
def q_coins_with_history(spark, sf_dir):
    return S.tick_counts(V.ticks(spark, sf_dir)).where("n_ticks >= 2")


@register("at_least", with_(TICK_CTE) + """
SELECT * FROM tick WHERE id IN (SELECT id FROM tick GROUP BY id HAVING count(*) >= 1000)""")
def q_at_least(spark, sf_dir):
    return S.at_least(V.ticks(spark, sf_dir), 1000)


@register("market_share", with_(TICK_CTE) + """,
snap AS (SELECT id, arg_max(market_cap, CASE WHEN market_cap IS NOT NULL THEN
                struct_pack(n := "timestamp" IS NULL, t := "timestamp", s := seq) END) AS market_cap
         FROM tick WHERE id IS NOT NULL GROUP BY id),
nn AS (SELECT * FROM snap WHERE market_cap IS NOT NULL)
SELECT id, market_cap,
       CASE WHEN (SELECT sum(market_cap) FROM nn) = 0 THEN NULL
            ELSE CAST(market_cap AS DOUBLE) / CAST((SELECT sum(market_cap) FROM nn) AS DOUBLE) END AS share
FROM nn""")
def q_market_share(spark, sf_dir):
    return S.market_share(V.ticks(spark, sf_dir))


CHANGE_LABEL_SQL = "replace(format('{{:.2f}}', {c}), ',', '') || '%'"
PRICE_LABEL_SQL = "'$' || format('{{:,.4f}}', {c})"


@register("change_board", with_(TICK_CTE) + f"""
SELECT id, upper(substr(id, 1, 1)) || lower(substr(id, 2)) AS name, change,
       CASE WHEN change >= 0 THEN 'up' ELSE 'down' END AS trend,
       {CHANGE_LABEL_SQL.format(c='change')} AS change_label
FROM (SELECT id, {_arg_last_nonnull('price_change_pct_24h').replace(' AS price_change_pct_24h', ' AS change')}
      FROM tick WHERE id IS NOT NULL GROUP BY id)""")
def q_change_board(spark, sf_dir):
    return S.change_board(V.ticks(spark, sf_dir))


# ---------------------------------------------------------------- time series
def _sparse_sql(values: list[str]) -> str:
    parts = ", ".join(
        f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN struct_pack(t := \"timestamp\", s := seq) END) AS {c}"
        for c in values)
    return f"""sparse AS (
  SELECT id, time_bucket(INTERVAL '30 minutes', "timestamp") AS bucket, {parts}
  FROM tick WHERE id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY 1, 2),
grid AS (
  SELECT id, unnest(generate_series(min(bucket), max(bucket), INTERVAL '30 minutes')) AS bucket
  FROM sparse GROUP BY id)"""


def _filled_sql(values: list[str], source: str = "tick") -> str:
    fills = ", ".join(
        f"last_value(s.{c} IGNORE NULLS) OVER (PARTITION BY g.id ORDER BY g.bucket "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in values)
    sparse = _sparse_sql(values).replace("FROM tick", f"FROM {source}")
    return f"""{sparse},
filled AS (SELECT g.id, g.bucket, {fills} FROM grid g LEFT JOIN sparse s ON s.id = g.id AND s.bucket = g.bucket)"""


TICK_VALUES = ["symbol", "current_price", "price_change_pct_24h", "market_cap", "total_volume"]


@register("resample_last", with_(TICK_CTE, _sparse_sql(TICK_VALUES)) + """
SELECT g.id, g.bucket, s.symbol, s.current_price, s.price_change_pct_24h, s.market_cap, s.total_volume
FROM grid g LEFT JOIN sparse s ON s.id = g.id AND s.bucket = g.bucket""")
def q_resample_last(spark, sf_dir):
    return W.resample_last(V.ticks(spark, sf_dir), values=TICK_VALUES)


@register("resample_ffill", with_(TICK_CTE, _filled_sql(TICK_VALUES)) + "SELECT * FROM filled")
def q_resample_ffill(spark, sf_dir):
    return W.resample_ffill(V.ticks(spark, sf_dir), values=TICK_VALUES)


MULTI_CTE = """multi AS (SELECT * FROM tick WHERE id IN (SELECT id FROM tick GROUP BY id HAVING count(*) >= 2))"""


@register("compare_indexed", with_(TICK_CTE, MULTI_CTE, _filled_sql(["current_price"], "multi")) + """
SELECT id, bucket,
       CASE WHEN base = 0 THEN NULL ELSE (current_price - base) / base * 100.0 END AS pct_change
FROM (SELECT *, first_value(current_price) OVER (PARTITION BY id ORDER BY bucket) AS base FROM filled)""")
def q_compare_indexed(spark, sf_dir):
    return W.compare(V.ticks(spark, sf_dir))


def _range_sql(padding: float) -> str:
    return f"""rng AS (
  SELECT id, mn - CASE WHEN mx <> mn THEN (mx - mn) * {padding} ELSE mn * 0.01 END AS range_low,
             mx + CASE WHEN mx <> mn THEN (mx - mn) * {padding} ELSE mn * 0.01 END AS range_high
  FROM (SELECT id, min(current_price) AS mn, max(current_price) AS mx FROM filled GROUP BY id))"""


@register("sparklines", with_(TICK_CTE, MULTI_CTE, _filled_sql(["current_price"], "multi"), _range_sql(SPARKLINE_PADDING)) + """,
tr AS (SELECT id, CASE WHEN arg_max(price_change_pct_24h, CASE WHEN price_change_pct_24h IS NOT NULL THEN
              struct_pack(n := "timestamp" IS NULL, t := "timestamp", s := seq) END) >= 0 THEN 'up' ELSE 'down' END
              AS trend FROM multi GROUP BY id)
SELECT f.id, f.bucket, f.current_price, tr.trend, rng.range_low, rng.range_high
FROM filled f JOIN tr ON tr.id = f.id JOIN rng ON rng.id = f.id""")
def q_sparklines(spark, sf_dir):
    return W.sparklines(V.ticks(spark, sf_dir))


@register("detail_series", with_(TICK_CTE, f"one AS (SELECT * FROM tick WHERE id = '{DETAIL_COIN}')",
                                  _filled_sql(["current_price", "total_volume"], "one")) + """
SELECT bucket, current_price, total_volume FROM filled""")
def q_detail_series(spark, sf_dir):
    return W.detail_series(V.ticks(spark, sf_dir), DETAIL_COIN)


@register("history_panel", with_(TICK_CTE, _filled_sql(["current_price"]), _range_sql(RANGE_PADDING)) + """
SELECT f.id, f.bucket, f.current_price, rng.range_low, rng.range_high FROM filled f JOIN rng ON rng.id = f.id""")
def q_history_panel(spark, sf_dir):
    return W.history_panel(V.ticks(spark, sf_dir))


@register("tight_range", with_(TICK_CTE, _filled_sql(["current_price"]), _range_sql(RANGE_PADDING)) + "SELECT * FROM rng")
def q_tight_range(spark, sf_dir):
    return W.tight_range(W.resample_ffill(V.ticks(spark, sf_dir), values=["current_price"]), RANGE_PADDING)


@register("period_stats", with_(TICK_CTE, _filled_sql(["current_price", "price_change_pct_24h"])) + f""",
agg AS (SELECT id, arg_min_null(current_price, bucket) AS first_price, arg_max_null(current_price, bucket) AS last_price,
               max(current_price) AS high, min(current_price) AS low,
               arg_max_null(price_change_pct_24h, bucket) AS change_24h
        FROM filled GROUP BY id),
tot AS (SELECT *, CASE WHEN first_price = 0 THEN NULL ELSE (last_price - first_price) / first_price * 100.0 END
                  AS total_change FROM agg)
SELECT id, first_price, last_price, high, low, total_change, change_24h,
       {PRICE_LABEL_SQL.format(c='last_price')} AS current_label,
       {CHANGE_LABEL_SQL.format(c='total_change')} AS total_change_label
FROM tot""")
def q_period_stats(spark, sf_dir):
    return W.period_stats(V.ticks(spark, sf_dir))


# ---------------------------------------------------------------- cooldown and alerts

COOLED_CTE = """nz AS (
  SELECT id, "timestamp", seq, row_number() OVER (PARTITION BY id ORDER BY "timestamp", seq) AS rn
  FROM tick WHERE id IS NOT NULL AND "timestamp" IS NOT NULL
    AND price_change_pct_24h IS NOT NULL AND price_change_pct_24h <> 0),
chain(id, "timestamp", seq) AS (
  SELECT id, "timestamp", seq FROM nz WHERE rn = 1
  UNION ALL
  SELECT c.id, n."timestamp", n.seq FROM chain c, LATERAL (
    SELECT "timestamp", seq FROM nz
    WHERE nz.id = c.id AND nz."timestamp" >= c."timestamp" + INTERVAL 3600 SECOND
    ORDER BY "timestamp", seq LIMIT 1) n),
cooled AS (SELECT t.* FROM tick t JOIN chain USING (seq))"""


@register("cooldown", with_(TICK_CTE, COOLED_CTE) + "SELECT * FROM cooled")
def q_cooldown(spark, sf_dir):
    return T.cooldown(V.ticks(spark, sf_dir))



DIRECTION_SQL = "CASE WHEN {c} < 0 THEN 'drop' WHEN {c} > 0 THEN 'rise' END"
TREND_SQL = "CASE WHEN {c} >= 0 THEN 'up' ELSE 'down' END"
PLAIN2_SQL = "replace(format('{{:.2f}}', {c}), ',', '')"
NAME_SQL = "upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


@register("direction", with_(TICK_CTE) + f"""
SELECT seq, id, price_change_pct_24h AS change, {DIRECTION_SQL.format(c='price_change_pct_24h')} AS direction,
       {TREND_SQL.format(c='price_change_pct_24h')} AS trend,
       {CHANGE_LABEL_SQL.format(c='price_change_pct_24h')} AS change_label,
       {NAME_SQL.format(c='id')} AS name, {PRICE_LABEL_SQL.format(c='current_price')} AS price_label
FROM tick""")
def q_direction(spark, sf_dir):
    t = V.ticks(spark, sf_dir)
    c = "price_change_pct_24h"
    return t.select("seq", "id", t[c].alias("change"), P.direction(c).alias("direction"), P.trend(c).alias("trend"),
                    P.change_label(c).alias("change_label"), P.display_name("id").alias("name"),
                    P.price_label("current_price").alias("price_label"))


MATCH_CTE = f"""alerts AS (
  SELECT s.email, c.id AS coin, {DIRECTION_SQL.format(c='c.price_change_pct_24h')} AS direction,
         c.price_change_pct_24h AS change, c.current_price AS price, coalesce(s.threshold, 2.0) AS threshold,
         c."timestamp" AS "timestamp"
  FROM cooled c JOIN subs s
    ON s.coin = c.id AND s.direction = {DIRECTION_SQL.format(c='c.price_change_pct_24h')}
   AND ((s.direction = 'drop' AND c.price_change_pct_24h <= -coalesce(s.threshold, 2.0))
     OR (s.direction = 'rise' AND c.price_change_pct_24h >= coalesce(s.threshold, 2.0))))"""


def _alerts(spark, sf_dir):
    return J.match_alerts(T.cooldown(V.ticks(spark, sf_dir)), V.subscriptions(spark, sf_dir))


@register("match_alerts", with_(TICK_CTE, COOLED_CTE, SUBS_CTE, MATCH_CTE) + "SELECT * FROM alerts")
def q_match_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


OUTBOX_SQL = with_(TICK_CTE, COOLED_CTE, SUBS_CTE, MATCH_CTE) + f"""
SELECT *, 'Price alert: ' || {NAME_SQL.format(c='coin')} || ' '
          || CASE WHEN direction = 'drop' THEN 'dropped' ELSE 'surged' END || ' '
          || {PLAIN2_SQL.format(c='abs(change)')} || '%' AS subject,
       {NAME_SQL.format(c='coin')} || ' has ' || CASE WHEN direction = 'drop' THEN 'dropped' ELSE 'risen' END || ' '
          || {PLAIN2_SQL.format(c='abs(change)')} || '% over 24h. Price now $'
          || coalesce(format('{{:,.4f}}', price), 'n/a') || '. Your threshold: ' || CAST(threshold AS VARCHAR) || '%.'
          AS body
FROM alerts"""


@register("alert_outbox", OUTBOX_SQL)
def q_alert_outbox(spark, sf_dir):
    return J.match_alerts(T.cooldown(V.ticks(spark, sf_dir)), V.subscriptions(spark, sf_dir), render=True)


RECEIPTS_UPTO = "2024-01-16 00:00:00"


@register("alerts_unsent", f"""
SELECT *, sha256(length(email) || ':' || email || length(coin) || ':' || coin || length(direction) || ':' || direction
                 || CAST(epoch_us("timestamp") AS VARCHAR)) AS alert_id
FROM ({OUTBOX_SQL}) WHERE "timestamp" >= TIMESTAMP '{RECEIPTS_UPTO}'""")
def q_alerts_unsent(spark, sf_dir):
    """What a mailer has to send after a replay wrote the outbox twice, when the alerts
    before an instant have their receipts."""
    path = f"{scratch_path(spark, 'outbox')}/alerts"
    cooled, subs = T.cooldown(V.ticks(spark, sf_dir)), V.subscriptions(spark, sf_dir)
    buckets = J.outbox_buckets(cooled, subs)
    written = J.with_alert_id(J.store_outbox(J.match_alerts(cooled, subs, render=True, buckets=buckets), path, buckets))
    receipts = written.where(F.col("timestamp") < F.lit(RECEIPTS_UPTO).cast("timestamp_ntz")).select("alert_id", J.PLACE)
    return J.unsent(written.unionByName(written), receipts)


ORDER_SQL = "struct_pack(t := ts, s := seq)"
STATE_SQL = f"""dl AS (SELECT email, coin, max({ORDER_SQL}) AS del_at FROM cmd WHERE op = 'delete' GROUP BY 1, 2),
live AS (SELECT c.* FROM cmd c LEFT JOIN dl USING (email, coin)
         WHERE c.op = 'upsert' AND (dl.del_at IS NULL OR {ORDER_SQL.replace('ts', 'c.ts').replace('seq', 'c.seq')} > dl.del_at)),
state AS (SELECT email, coin, arg_max(threshold, {ORDER_SQL}) AS threshold, arg_max(direction, {ORDER_SQL}) AS direction,
                 min(ts) AS created_at FROM live GROUP BY 1, 2)"""


@register("subs_state", with_(COMMANDS_CTE, STATE_SQL) + "SELECT * FROM state")
def q_subs_state(spark, sf_dir):
    return K.apply_commands(V.subscription_commands(spark, sf_dir))


@register("subs_outcome", with_(COMMANDS_CTE) + """
SELECT email, coin, op, ts, seq,
       CASE WHEN op = 'upsert' THEN CASE WHEN prev = 'upsert' THEN 'updated' ELSE 'created' END
            ELSE CASE WHEN prev = 'upsert' THEN 'deleted' ELSE 'noop' END END AS outcome
FROM (SELECT *, lag(op) OVER (PARTITION BY email, coin ORDER BY ts, seq) AS prev FROM cmd)""")
def q_subs_outcome(spark, sf_dir):
    return K.with_outcome(V.subscription_commands(spark, sf_dir))


@register("subs_outcome_nulls", with_(COMMANDS_CTE, NULL_COMMANDS_CTE) + """
SELECT email, coin, op, ts, seq,
       CASE WHEN op = 'upsert' THEN CASE WHEN prev = 'upsert' THEN 'updated' ELSE 'created' END
            ELSE CASE WHEN prev = 'upsert' THEN 'deleted' ELSE 'noop' END END AS outcome
FROM (SELECT *, lag(op) OVER (PARTITION BY email, coin ORDER BY ts NULLS LAST, seq NULLS LAST) AS prev FROM cmdn)""")
def q_subs_outcome_nulls(spark, sf_dir):
    return K.with_outcome(V.commands_with_nulls(spark, sf_dir))


NULL_ORDER_SQL = "struct_pack(n := {c}ts IS NULL, t := coalesce({c}ts, TIMESTAMP '1970-01-01'), s := {c}seq)"


@register("subs_state_nulls", with_(COMMANDS_CTE, NULL_COMMANDS_CTE) + f""",
dl AS (SELECT email, coin, max({NULL_ORDER_SQL.format(c='')}) AS del_at FROM cmdn WHERE op = 'delete' GROUP BY 1, 2),
live AS (SELECT c.* FROM cmdn c LEFT JOIN dl ON c.email IS NOT DISTINCT FROM dl.email AND c.coin IS NOT DISTINCT FROM dl.coin
         WHERE c.op = 'upsert' AND (dl.del_at IS NULL OR {NULL_ORDER_SQL.format(c='c.')} > dl.del_at))
SELECT email, coin, arg_max(threshold, {NULL_ORDER_SQL.format(c='')}) AS threshold, arg_max(direction, {NULL_ORDER_SQL.format(c='')}) AS direction,
       min(ts) AS created_at FROM live GROUP BY 1, 2""")
def q_subs_state_nulls(spark, sf_dir):
    return K.apply_commands(V.commands_with_nulls(spark, sf_dir))


def _form(spark, sf_dir):
    s = V.subscriptions(spark, sf_dir)
    return s.select("email", P.display_name("coin").alias("coin"),
                    F.when(F.col("direction") == "drop", DROP_FORM_LABEL).otherwise("Rises by").alias("alert_when"),
                    "threshold")


FORM_SQL = f"""norm AS (SELECT email, lower({NAME_SQL.format(c='coin')}) AS coin, direction,
                       coalesce(threshold, 2.0) AS threshold FROM subs),
chk AS (SELECT *, (email IS NOT NULL AND length(email) > 0 AND strpos(email, '@') > 0) AS ok_email,
               (threshold BETWEEN 0.1 AND 50.0) AS ok_t FROM norm)"""


@register("subs_valid", with_(SUBS_CTE, FORM_SQL) + """
SELECT email, coin, direction, threshold FROM chk WHERE ok_email AND ok_t""")
def q_subs_valid(spark, sf_dir):
    return K.split_valid(K.normalise_command(_form(spark, sf_dir)))[0]


@register("subs_rejected", with_(SUBS_CTE, FORM_SQL) + """
SELECT email, coin, direction, threshold,
       CASE WHEN NOT ok_email THEN 'invalid email' ELSE 'threshold out of range' END AS reason
FROM chk WHERE NOT (ok_email AND ok_t)""")
def q_subs_rejected(spark, sf_dir):
    return K.split_valid(K.normalise_command(_form(spark, sf_dir)))[1]


LOOKUP_EMAIL = "user42@example.com"


@register("subs_for_email", with_(SUBS_CTE) + f"""
SELECT coin, threshold, direction,
       CASE WHEN direction = 'drop' THEN 'Drops' ELSE 'Rises' END || ' by ' || CAST(threshold AS VARCHAR) || '%'
         AS label, email
FROM subs WHERE email = '{LOOKUP_EMAIL}'""")
def q_subs_for_email(spark, sf_dir):
    return K.subs_for_email(V.subscriptions(spark, sf_dir), LOOKUP_EMAIL)


@register("subs_for", with_(SUBS_CTE) + "SELECT * FROM subs WHERE coin = 'purchase' AND direction = 'rise'")
def q_subs_for(spark, sf_dir):
    return K.subs_for(V.subscriptions(spark, sf_dir), "purchase", "rise")


# ---------------------------------------------------------------- sources and sentiment

BAD_MESSAGE_EVERY = 19
MARKET_UNIVERSE = ["click", "purchase", "signup", "view"]
AS_OF = "2024-02-01 00:00:00"


@register("decode_ticks", with_(TICK_CTE) + f"""
SELECT CASE WHEN bad THEN NULL ELSE id END AS id, CASE WHEN bad THEN NULL ELSE symbol END AS symbol,
       CASE WHEN bad THEN NULL ELSE current_price END AS current_price,
       CASE WHEN bad THEN NULL ELSE price_change_pct_24h END AS price_change_pct_24h,
       CASE WHEN bad THEN NULL ELSE market_cap END AS market_cap,
       CASE WHEN bad THEN NULL ELSE total_volume END AS total_volume,
       CASE WHEN bad THEN NULL ELSE date_trunc('second', "timestamp") END AS "timestamp"
FROM (SELECT *, seq % {BAD_MESSAGE_EVERY} = 0 AS bad FROM tick)""")
def q_decode_ticks(spark, sf_dir):
    t = V.ticks(spark, sf_dir)
    wire = F.to_json(F.struct(*[C.iso_text(c).alias(c) if c == "timestamp" else F.col(c) for c in t.columns]))
    bad = F.col("seq") % BAD_MESSAGE_EVERY == 0
    msgs = t.select(F.when(bad, F.lit("{not json")).otherwise(wire).cast("binary").alias("value"))
    return C.decode_ticks(msgs)


@register("market_payload", with_(TICK_CTE) + f"""
SELECT id, symbol, current_price, coalesce(price_change_pct_24h, 0.0) AS price_change_pct_24h, market_cap,
       total_volume, max("timestamp") OVER (PARTITION BY seq // 10) AS "timestamp"
FROM tick QUALIFY id IN ({", ".join(repr(c) for c in MARKET_UNIVERSE)})""")
def q_market_payload(spark, sf_dir):
    return PL.restrict(PL.normalise_market(FX.market_payloads(V.ticks(spark, sf_dir))), MARKET_UNIVERSE)


@register("tick_ingest", with_(TICK_CTE) + f"""
SELECT id, symbol, current_price, coalesce(price_change_pct_24h, 0.0) AS price_change_pct_24h, market_cap,
       total_volume, max("timestamp") OVER (PARTITION BY seq // 10) AS "timestamp"
FROM tick QUALIFY id IN ({", ".join(repr(c) for c in MARKET_UNIVERSE)})""")
def q_tick_ingest(spark, sf_dir):
    """The producer's whole way, and back: payloads, ticks, messages, decoded ticks."""
    return C.decode_ticks(C.encode(IN.ingest_ticks(FX.market_payloads(V.ticks(spark, sf_dir)), MARKET_UNIVERSE), micros=True))


def _articles(spark, sf_dir):
    return V.article_inputs(spark, sf_dir)


@register("article_payload", with_(ARTICLE_CTE) + """
SELECT coin, title, title || '. ' || coalesce(description, '') AS text, coalesce(source, 'unknown') AS source,
       published_at, CAST(max(published_at) OVER (PARTITION BY coin, doc_id // 50) AS TIMESTAMP) AS "timestamp"
FROM art""")
def q_article_payload(spark, sf_dir):
    return PL.normalise_articles(FX.news_payloads(_articles(spark, sf_dir))).drop("article_id")


SUM_SQL = "list_reduce(list_prepend(0.0::DOUBLE, list(lex.polarity::DOUBLE ORDER BY pos) FILTER (lex.polarity IS NOT NULL)), lambda a, b: a + b)"
SCORE_SQL = """words AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\\p{{L}}]+') AS ws FROM {src}),
tok AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM words),
scores AS (SELECT t.doc_id, coalesce(""" + SUM_SQL + """ / nullif(count(lex.polarity), 0), 0.0) AS sentiment_score
           FROM tok t LEFT JOIN lex ON lex.word = t.w GROUP BY t.doc_id),
labelled AS (SELECT doc_id, sentiment_score,
                    CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative'
                         ELSE 'neutral' END AS sentiment_label FROM scores)"""


@register("score_text", with_(ARTICLE_CTE, LEXICON_CTE, SCORE_SQL.format(src="art")) + "SELECT * FROM labelled")
def q_score_text(spark, sf_dir):
    return X.score_text(_articles(spark, sf_dir), V.lexicon(spark))


@register("article_ingest", with_(ARTICLE_CTE, LEXICON_CTE, TOPIC_CTE) + """,
full_text AS (SELECT doc_id, title, title || '. ' || coalesce(description, '') AS text, coalesce(source, 'unknown') AS source, published_at FROM art),
toks AS (SELECT *, regexp_split_to_array(lower(text), '[^\\p{L}]+') AS w FROM full_text),
m AS (SELECT topic.coin AS topic, toks.* FROM toks, topic WHERE list_has_all(w, topic.terms)),
k AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY topic ORDER BY published_at DESC) <= 10),
tok AS (SELECT topic, doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM k),
sc AS (SELECT topic, doc_id, coalesce(""" + SUM_SQL + """ / nullif(count(lex.polarity), 0), 0.0) AS score
       FROM tok LEFT JOIN lex ON lex.word = tok.w GROUP BY topic, doc_id)
SELECT topic AS coin, title, score AS sentiment_score,
       CASE WHEN score > 0.1 THEN 'positive' WHEN score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label, source, published_at
FROM k JOIN sc USING (topic, doc_id)""")
def q_article_ingest(spark, sf_dir):
    """The producer's whole way, and back: payloads, articles, messages, decoded articles."""
    found = IN.ingest_articles(FX.news_payloads(_articles(spark, sf_dir)), V.topics(spark), V.lexicon(spark))
    return C.decode_articles(C.encode(found)).drop("timestamp")


@register("select_articles", with_(ARTICLE_CTE, TOPIC_CTE) + """,
toks AS (SELECT doc_id, published_at, regexp_split_to_array(lower(text), '[^\\p{L}]+') AS w FROM art WHERE lang = 'en'),
m AS (SELECT topic.coin AS topic, doc_id, published_at FROM toks, topic WHERE list_has_all(w, topic.terms))
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY published_at DESC, doc_id) AS INTEGER) AS rank FROM m)
WHERE rank <= 10""")
def q_select_articles(spark, sf_dir):
    return X.select_articles(_articles(spark, sf_dir), V.topics(spark))


def _rounded(summary: DataFrame) -> DataFrame:
    """Means of doubles depend on the order of the sum in their last digits; the
    queries compare six digits, the operators don't round."""
    return summary.withColumn("avg_sentiment", F.round("avg_sentiment", 6))


@register("sentiment_summary", with_(ARTICLE_CTE, LEXICON_CTE, SCORE_SQL.format(src="art")) + f"""
SELECT a.coin, round(avg(l.sentiment_score), 6) AS avg_sentiment, CAST(count(*) AS INTEGER) AS article_count,
       TIMESTAMP '{AS_OF}' AS "timestamp"
FROM art a JOIN labelled l USING (doc_id) GROUP BY a.coin""")
def q_sentiment_summary(spark, sf_dir):
    return _rounded(X.sentiment_summary(X.with_scores(_articles(spark, sf_dir), V.lexicon(spark)), AS_OF))


POLL_UNIVERSE = V.COIN_BY_REMAINDER + ["bitcoin"]


@register("poll_average", with_(ARTICLE_CTE, LEXICON_CTE, SCORE_SQL.format(src="art")) + f""",
agg AS (SELECT a.coin, avg(l.sentiment_score) AS a, count(*) AS n FROM art a JOIN labelled l USING (doc_id)
        GROUP BY a.coin),
u(coin) AS (VALUES {", ".join(f"('{c}')" for c in POLL_UNIVERSE)})
SELECT u.coin, round(coalesce(agg.a, 0.0), 6) AS avg_sentiment, CAST(coalesce(agg.n, 0) AS INTEGER) AS article_count
FROM u LEFT JOIN agg USING (coin)""")
def q_poll_average(spark, sf_dir):
    coins = spark.createDataFrame([(c,) for c in POLL_UNIVERSE], "coin string")
    return _rounded(X.poll_average(X.with_scores(_articles(spark, sf_dir), V.lexicon(spark)), coins))


# ---------------------------------------------------------------- streaming

RESAMPLE_DELAY = "1 hour"


@register("stream_append", with_(TICK_CTE) + "SELECT * FROM tick")
def q_stream_append(spark, sf_dir):
    base = scratch_path(spark, "stream-append")
    ticks = V.tick_projection(V.stream_table(spark, sf_dir, "events"))
    ckpt = f"{base}/_checkpoint"
    sid = ST.stream_id_for(ckpt)
    ST.run_to_end(ST.start(ticks, lambda b, i: append_batch(b, i, f"{base}/history", sid, date_from="timestamp"),
                           ckpt, available_now=True))
    return read_table(spark, f"{base}/history")


@register("stream_cooldown", with_(TICK_CTE, COOLED_CTE) + "SELECT * FROM cooled")
def q_stream_cooldown(spark, sf_dir):
    base = scratch_path(spark, "stream-cooldown")
    ticks = V.tick_projection(V.stream_table(spark, sf_dir, "events"))
    ST.run_to_end(ST.cooldown_stream(ticks, f"{base}/kept", f"{base}/_checkpoint", available_now=True))
    return read_table(spark, f"{base}/kept")


CLOSED_CTE = f"""closed AS (
  SELECT * FROM tick WHERE time_bucket(INTERVAL '30 minutes', "timestamp") + INTERVAL 30 MINUTE <= (SELECT max("timestamp") FROM tick) - INTERVAL {RESAMPLE_DELAY})"""


def _stream_resample(spark, sf_dir, name, fill):
    base = scratch_path(spark, name)
    ticks = V.tick_projection(V.stream_table(spark, sf_dir, "events"))
    q = (ST.resample_stream(ticks, delay=RESAMPLE_DELAY, fill=fill).writeStream.outputMode("append").format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/_checkpoint")
         .trigger(availableNow=True).start())
    ST.run_to_end(q)
    return spark.read.parquet(f"{base}/out")


@register("stream_resample", with_(TICK_CTE, CLOSED_CTE, _sparse_sql(TICK_VALUES).replace("FROM tick", "FROM closed")) + """
SELECT g.id, g.bucket, s.symbol, s.current_price, s.price_change_pct_24h, s.market_cap, s.total_volume
FROM grid g LEFT JOIN sparse s ON s.id = g.id AND s.bucket = g.bucket""")
def q_stream_resample(spark, sf_dir):
    return _stream_resample(spark, sf_dir, "stream-resample", False)


@register("stream_ffill", with_(TICK_CTE, CLOSED_CTE, _filled_sql(TICK_VALUES, "closed")) + "SELECT * FROM filled")
def q_stream_ffill(spark, sf_dir):
    return _stream_resample(spark, sf_dir, "stream-ffill", True)


@register("tick_job", OUTBOX_SQL)
def q_tick_job(spark, sf_dir):
    base = scratch_path(spark, "tick-job")
    topic = FX.message_folder(C.encode(V.ticks(spark, sf_dir), micros=True), base)
    ticks = C.decode(spark.readStream.text(topic), TICK_WIRE_SEQ)
    q = ST.tick_job(ticks, f"{base}/history", f"{base}/alerts", f"{base}/dead",
                    lambda: V.subscriptions(spark, sf_dir), f"{base}/_checkpoint", available_now=True)
    ST.run_to_end(q)
    return read_table(spark, f"{base}/alerts")


EDGE_COOLED_CTE = COOLED_CTE[:COOLED_CTE.index("cooled AS")].replace("FROM tick", "FROM first_of") + """cooled AS (SELECT f.* EXCLUDE (nth) FROM first_of f JOIN chain c ON f.id = c.id AND f."timestamp" = c."timestamp")"""
FIRST_CTE = """first_of AS (
  SELECT *, row_number() OVER (PARTITION BY id, "timestamp" ORDER BY seq NULLS LAST) AS nth FROM edge
  WHERE price_change_pct_24h IS NOT NULL AND price_change_pct_24h <> 0 QUALIFY nth = 1)"""


@register("tick_job_edges", with_(TICK_CTE, EDGE_CTE, FIRST_CTE, EDGE_COOLED_CTE, SUBS_CTE, MATCH_CTE) + """
SELECT 'alert' AS kind, email, coin, change, threshold, "timestamp", NULL AS reason FROM alerts
UNION ALL
SELECT 'dead letter', NULL, id, price_change_pct_24h, NULL, "timestamp", CASE WHEN id IS NULL THEN 'no id' ELSE 'no time' END
FROM edge WHERE id IS NULL OR "timestamp" IS NULL""")
def q_tick_job_edges(spark, sf_dir):
    base = scratch_path(spark, "tick-job-edges")
    topic = FX.message_folder(V.edge_messages(spark, sf_dir), base)
    ticks = C.decode(spark.readStream.text(topic), TICK_WIRE_SEQ)
    q = ST.tick_job(ticks, f"{base}/history", f"{base}/alerts", f"{base}/dead",
                    lambda: V.subscriptions(spark, sf_dir), f"{base}/_checkpoint", available_now=True)
    ST.run_to_end(q)
    alerts = read_table(spark, f"{base}/alerts").select(F.lit("alert").alias("kind"), "email", "coin", "change", "threshold", "timestamp",
                                                        F.lit(None).cast("string").alias("reason"))
    dead = read_table(spark, f"{base}/dead").select(F.lit("dead letter").alias("kind"), F.lit(None).cast("string").alias("email"), F.col("id").alias("coin"),
                                                    F.col("price_change_pct_24h").alias("change"), F.lit(None).cast("double").alias("threshold"), "timestamp", "reason")
    return alerts.unionByName(dead)


@register("stream_replay", with_(TICK_CTE) + "SELECT * FROM tick WHERE seq % 4 = 1")
def q_stream_replay(spark, sf_dir):
    """Two batches, each replayed with less than it had: the first with nothing."""
    path, ticks = f"{scratch_path(spark, 'stream-replay')}/history", V.ticks(spark, sf_dir)
    for batch_id, rule in ((0, "seq % 2 = 0"), (1, "seq % 2 = 1"), (0, "false"), (1, "seq % 4 = 1")):
        append_batch(ticks.where(rule), batch_id, path, "s", date_from="timestamp", skip_empty=False)
    return read_table(spark, path, schema=TICK)


REPLAY_FROM, REPLAY_POSITION = 2, 3  # the log's position at the batch's first try, as a fraction of it


def _log_sql(state: str) -> str:
    return f"""log AS (SELECT * FROM cmd WHERE seq <= (SELECT {REPLAY_FROM} * max(seq) // {REPLAY_POSITION} FROM cmd)),
dl AS (SELECT email, coin, max(seq) AS del_at FROM log WHERE op = 'delete' GROUP BY 1, 2),
live AS (SELECT c.* FROM log c LEFT JOIN dl USING (email, coin) WHERE c.op = 'upsert' AND (dl.del_at IS NULL OR c.seq > dl.del_at)),
{state} AS (SELECT email, coin, arg_max(threshold, seq) AS threshold, arg_max(direction, seq) AS direction, arg_min(ts, seq) AS created_at FROM live GROUP BY 1, 2)"""


@register("alerts_replay", with_(TICK_CTE, COOLED_CTE, COMMANDS_CTE, _log_sql("subs"), MATCH_CTE) + "SELECT * FROM alerts")
def q_alerts_replay(spark, sf_dir):
    """A batch whose first try sees a part of the command log, and whose replay comes
    after the rest of it: the same alerts, from the state at the batch's position."""
    base = scratch_path(spark, "alerts-replay")
    commands = V.subscription_commands(spark, sf_dir)
    upto = commands.agg(F.max("seq")).first()[0] * REPLAY_FROM // REPLAY_POSITION
    log = K.SubscriptionLog(spark, f"{base}/commands", f"{base}/state")
    cooled = T.cooldown(V.ticks(spark, sf_dir))
    commands.where(F.col("seq") <= upto // 2).write.mode("append").parquet(log.log_path)
    log.advance()
    commands.where((F.col("seq") > upto // 2) & (F.col("seq") <= upto)).write.mode("append").parquet(log.log_path)
    ST.write_alerts(cooled, log, 0, f"{base}/alerts", "s")
    commands.where(F.col("seq") > upto).write.mode("append").parquet(log.log_path)
    log.advance()
    ST.write_alerts(cooled, log, 0, f"{base}/alerts", "s")
    return read_table(spark, f"{base}/alerts").select("email", "coin", "direction", "change", "price", "threshold", "timestamp")


@register("latest_from_partials", with_(TICK_CTE) + f"""
SELECT id, {_arg_last_nonnull('symbol')}, {_arg_last_nonnull('current_price')},
       {_arg_last_nonnull('price_change_pct_24h')}, {_arg_last_nonnull('market_cap')},
       {_arg_last_nonnull('total_volume')}, max("timestamp") AS "timestamp",
       arg_max_null(total_volume, struct_pack(n := "timestamp" IS NULL, t := "timestamp", s := seq)) AS last_volume, count(*) AS n_ticks
FROM tick WHERE id IS NOT NULL GROUP BY id""")
def q_latest_from_partials(spark, sf_dir):
    """Four batches' partial snapshots, merged without a look at the ticks."""
    path, ticks = f"{scratch_path(spark, 'partials')}/latest", V.ticks(spark, sf_dir)
    for batch_id in range(4):
        append_batch(S.partials(ticks.where(F.col("seq") % 4 == batch_id)), batch_id, path, "s", date_from="last_tick", skip_empty=False)
    return S.from_partials(read_table(spark, path))


@register("latest_decoded", with_(TICK_CTE) + """,
t AS (SELECT id, symbol, current_price, price_change_pct_24h, market_cap, total_volume, date_trunc('second', "timestamp") AS "timestamp" FROM tick)
SELECT id, max("timestamp") AS "timestamp", count(DISTINCT time_bucket(INTERVAL '30 minutes', "timestamp")) AS n_buckets FROM t GROUP BY id""")
def q_latest_decoded(spark, sf_dir):
    """A3, A4 and W1 on ticks as the messages have them, without an ingest sequence."""
    ticks = C.decode_ticks(C.encode(V.ticks(spark, sf_dir).drop("seq")))
    buckets = W.resample_last(ticks, values=["market_cap"]).where("market_cap is not null").groupBy("id").agg(F.count("*").alias("n_buckets"))
    return S.latest_by_coin(ticks).select("id", "timestamp").join(S.last_volume(ticks).select("id"), "id").join(buckets, "id")


EDGE_ARTICLE_CTE = """arte AS (
  SELECT CASE WHEN doc_id % 5 = 0 THEN doc_id - 1 ELSE doc_id END AS doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE published_at END AS published_at, lang, text
  FROM art, LATERAL (SELECT unnest(range(CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END))) AS twice)"""


@register("select_articles_edges", with_(ARTICLE_CTE, TOPIC_CTE, EDGE_ARTICLE_CTE) + """,
toks AS (SELECT doc_id, published_at, regexp_split_to_array(lower(text), '[^\\p{L}]+') AS w FROM arte),
m AS (SELECT topic.coin AS topic, doc_id, published_at FROM toks, topic WHERE list_has_all(w, topic.terms))
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY published_at DESC NULLS LAST, doc_id) AS INTEGER) AS rank FROM m)
WHERE rank <= 200""")
def q_select_articles_edges(spark, sf_dir):
    """Repeated rows, ids that two texts share, and articles without a date."""
    return X.select_articles(V.edge_articles(spark, sf_dir), V.topics(spark), None, 200)


@register("match_alerts_edges", with_(TICK_CTE, COOLED_CTE, SUBS_CTE, MATCH_CTE) + f"""
SELECT * FROM alerts WHERE substr(email, 5, 1) NOT IN ('1', '2')
UNION ALL
SELECT s.email, c.id, s.direction, c.price_change_pct_24h, c.current_price, 2.0, c."timestamp" FROM subs s JOIN cooled c
ON s.coin = c.id AND s.direction = {DIRECTION_SQL.format(c='c.price_change_pct_24h')} AND abs(c.price_change_pct_24h) >= 2.0
WHERE substr(s.email, 5, 1) IN ('1', '2')""")
def q_match_alerts_edges(spark, sf_dir):
    """Subscriptions whose threshold is NaN count as having none."""
    subs = V.subscriptions(spark, sf_dir)
    nan = F.substring("email", 5, 1).isin("1", "2")
    return J.match_alerts(T.cooldown(V.ticks(spark, sf_dir)), subs.withColumn("threshold", F.when(nan, F.lit(float("nan"))).otherwise(F.col("threshold"))))


HISTORY_FROM, HISTORY_TO = "2024-01-08 12:00:00", "2024-01-21 00:00:00"


@register("history_scan", with_(TICK_CTE) + f"""
SELECT * FROM tick WHERE "timestamp" >= TIMESTAMP '{HISTORY_FROM}' AND "timestamp" < TIMESTAMP '{HISTORY_TO}'""")
def q_history_scan(spark, sf_dir):
    path = f"{scratch_path(spark, 'history')}/ticks"
    empty = C.scan_ticks(spark, path, HISTORY_FROM, HISTORY_TO)  # before the first write
    append_batch(V.ticks(spark, sf_dir), 0, path, "s", date_from="timestamp")
    found = C.scan_ticks(spark, path, HISTORY_FROM, HISTORY_TO).drop("date", "stream_id", "batch_id")
    return found.unionByName(empty)


@register("sentiment_job", ORACLE["sentiment_summary"])
def q_sentiment_job(spark, sf_dir):
    base = scratch_path(spark, "sentiment-job")
    arts = X.with_scores(_articles(spark, sf_dir), V.lexicon(spark), keep=("coin", "title", "source", "published_at"))
    msgs = C.encode(arts.select("coin", "title", "sentiment_score", "sentiment_label",
                                F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"), "published_at",
                                F.col("published_at").alias("timestamp")), time_columns=())
    topic = FX.message_folder(msgs, base)
    articles = C.decode_articles(spark.readStream.text(topic))
    q = ST.sentiment_job(articles, f"{base}/raw", f"{base}/summary", f"{base}/_checkpoint",
                         as_of=lambda batch_id: AS_OF, available_now=True)
    ST.run_to_end(q)
    return _rounded(read_table(spark, f"{base}/summary"))


@register("coin_cards", with_(TICK_CTE, MULTI_CTE, _filled_sql(["current_price"], "multi"), _range_sql(SPARKLINE_PADDING)) + f""",
snap AS (SELECT id, {_arg_last_nonnull('current_price')}, {_arg_last_nonnull('price_change_pct_24h')}, count(*) AS n
         FROM tick WHERE id IS NOT NULL GROUP BY id)
SELECT s.id, {NAME_SQL.format(c='s.id')} AS name, {PRICE_LABEL_SQL.format(c='s.current_price')} AS price_label,
       {CHANGE_LABEL_SQL.format(c='s.price_change_pct_24h')} AS change_label,
       {TREND_SQL.format(c='s.price_change_pct_24h')} AS trend, s.n > 1 AS has_sparkline, rng.range_low, rng.range_high
FROM snap s LEFT JOIN rng ON rng.id = s.id""")
def q_coin_cards(spark, sf_dir):
    return W.coin_cards(V.ticks(spark, sf_dir))
