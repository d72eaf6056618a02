"""DuckDB twins of the fixture views, used to state each query's oracle SQL.

The driver registers the parquet tables as views (``events``, ``customer``,
``documents`` ...); these CTEs rebuild the fixture views with the same
expressions as ``plans/views.py``.
"""

TICK_CTE = """tick AS (
  SELECT event_type AS id,
         left(event_type, 3) AS symbol,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS current_price,
         CASE WHEN event_id % 11 = 0 THEN 0.0 WHEN event_id % 13 = 0 THEN NULL ELSE value - 20.0 END
           AS price_change_pct_24h,
         event_id * 1000 AS market_cap,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END
           AS total_volume,
         ts AS "timestamp",
         event_id AS seq
  FROM events)"""

EDGE_CTE = """edge AS (
  SELECT CASE WHEN seq % 37 = 0 THEN NULL ELSE id END AS id, symbol, current_price,
         CASE WHEN seq % 29 = 0 THEN NULL ELSE price_change_pct_24h END AS price_change_pct_24h, market_cap, total_volume,
         CASE WHEN seq % 31 = 0 THEN NULL ELSE "timestamp" END AS "timestamp", CASE WHEN seq % 43 = 0 THEN NULL ELSE seq END AS seq
  FROM tick, LATERAL (SELECT unnest(range(CASE WHEN seq % 41 = 0 THEN 2 ELSE 1 END))) AS twice)"""

NULL_COMMANDS_CTE = """cmdn AS (
  SELECT CASE WHEN seq % 17 = 0 THEN NULL ELSE email END AS email, CASE WHEN seq % 19 = 0 THEN NULL ELSE coin END AS coin, op, threshold, direction,
         CASE WHEN seq % 13 = 0 THEN NULL ELSE ts END AS ts, seq
  FROM cmd)"""

COIN_CASE = """CASE {x} WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                    WHEN 3 THEN 'signup' WHEN 4 THEN 'view' END"""

SUBS_CTE = """subs AS (
  SELECT CASE WHEN c_custkey % 23 = 0 THEN 'user' || c_custkey || 'example.com'
              ELSE 'user' || c_custkey || '@example.com' END AS email,
         """ + COIN_CASE.format(x="c_custkey % 5") + """ AS coin,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 0.5 + (c_custkey % 110) / 2.0 END AS threshold,
         CASE WHEN c_custkey % 2 = 0 THEN 'drop' ELSE 'rise' END AS direction,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS created_at
  FROM customer)"""

COMMANDS_CTE = """cmd AS (
  SELECT 'user' || (user_id % 20) || '@example.com' AS email,
         event_type AS coin,
         CASE WHEN event_id % 9 = 0 THEN 'delete' ELSE 'upsert' END AS op,
         value AS threshold,
         CASE WHEN event_id % 2 = 0 THEN 'drop' ELSE 'rise' END AS direction,
         ts, event_id AS seq
  FROM events)"""

ARTICLE_CTE = """art AS (
  SELECT doc_id,
         """ + COIN_CASE.format(x="doc_id % 5") + """ AS coin,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN doc_id % 7 = 0 THEN NULL
              WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1)
              ELSE '' END AS description,
         CASE WHEN doc_id % 9 = 0 THEN NULL ELSE source END AS source,
         lang,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         text
  FROM documents)"""

LEXICON_CTE = """lex(word, polarity) AS (
  VALUES ('that', 0.8), ('was', -0.6), ('with', 0.4), ('from', -0.9), ('this', 0.3), ('are', -0.2))"""

TOPIC_CTE = """topic(coin, terms) AS (
  VALUES ('t1', ['he', 'es']), ('t2', ['ha', 're']), ('t3', ['rewh']))"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
