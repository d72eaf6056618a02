"""Codecs (S3/S5/S13), payloads (S9-S11), selection (S12), scoring (X1) and
summaries (A1/A2) on edge rows."""

import json

from pyspark.sql import functions as F

from marketpulse.operators import sentiment as X
from marketpulse.sources import codec as C
from marketpulse.sources import payloads as PL
from tests.helpers import at, rows_of


def test_decode_edges(spark):
    msgs = ['{bad', None, '[{"id": "a"}]', '{"id": "a", "zzz": 1, "current_price": 5, "total_volume": 3.5, '
            '"market_cap": 7, "timestamp": "2026-01-01T00:00:00Z"}',
            '{"id": "b", "timestamp": "bad"}']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = C.decode_ticks(df).collect()
    assert [r["id"] for r in got[:3]] == [None, None, None]
    r = got[3]
    assert (r["current_price"], r["total_volume"], r["market_cap"]) == (5.0, None, 7)
    assert str(r["timestamp"]) == "2026-01-01 00:00:00"
    assert got[4]["id"] == "b" and got[4]["timestamp"] is None


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([("a", "A", 1.5, -2.0, 10, 20, at(3))],
                               "id string, symbol string, current_price double, price_change_pct_24h double, "
                               "market_cap long, total_volume long, timestamp timestamp_ntz")
    back = C.decode_ticks(C.encode(df)).collect()[0]
    assert back["timestamp"] == at(3) and back["price_change_pct_24h"] == -2.0


def test_market_payload_absent_vs_null(spark):
    payload = json.dumps([{"id": "a", "current_price": 1}, {"id": "b", "price_change_percentage_24h": None},
                          {"id": "c", "price_change_percentage_24h": 2.5}])
    df = spark.createDataFrame([(payload, at(0))], "payload string, polled_at timestamp_ntz")
    assert rows_of(PL.normalise_market(df), "id", "price_change_pct_24h") == [("a", 0.0), ("b", 0.0), ("c", 2.5)]
    assert rows_of(PL.normalise_market(df, null_change="keep"), "id", "price_change_pct_24h") == [
        ("a", 0.0), ("b", None), ("c", 2.5)]
    assert rows_of(PL.restrict(PL.normalise_market(df), ["a", "c"]), "id") == [("a",), ("c",)]


def test_news_payload_defaults(spark):
    payload = json.dumps({"articles": [{"title": None, "description": "d", "source": {"name": "s"}},
                                       {"title": "t", "description": None, "source": None, "publishedAt": "p"},
                                       {"title": "t"}]})
    df = spark.createDataFrame([("btc", payload, at(0))], "coin string, payload string, polled_at timestamp_ntz")
    got = rows_of(PL.normalise_articles(df), "text", "source", "published_at")
    assert got == sorted([(". d", "s", ""), ("t. ", "unknown", "p"), ("t. ", "unknown", "")], key=repr)


def test_score_text_rules(spark):
    lex = spark.createDataFrame([("good", 0.5), ("bad", -1.0)], "word string, polarity double")
    arts = spark.createDataFrame([(1, "nothing here"), (2, "Good good BAD"), (3, None), (4, "goodness")],
                                 "doc_id long, text string")
    got = rows_of(X.score_text(arts, lex), "doc_id", "sentiment_score", "sentiment_label")
    assert got == [(1, 0.0, "neutral"), (2, 0.0, "neutral"), (3, 0.0, "neutral"), (4, 0.0, "neutral")]
    arts2 = spark.createDataFrame([(5, "good good"), (6, "Bad, good")], "doc_id long, text string")
    assert rows_of(X.score_text(arts2, lex), "doc_id", "sentiment_score", "sentiment_label") == [
        (5, 0.5, "positive"), (6, -0.25, "negative")]


def test_select_articles(spark):
    rows = [(i, "alpha beta", "en", f"2024-01-01T00:{i:02d}:00Z") for i in range(12)]
    rows += [(100, "alpha beta", "en", "2024-01-01T00:11:00Z"),      # same time as 11 -> tie by id
             (200, "alpha beta", "de", "2024-01-01T01:00:00Z"),      # other language
             (300, "Alpha BETA gamma", "en", "2024-01-01T00:30:00Z")]  # matches both topics
    arts = spark.createDataFrame(rows, "doc_id long, text string, lang string, published_at string")
    topics = spark.createDataFrame([("t1", ["alpha", "beta"]), ("t2", ["gamma"])], "coin string, terms array<string>")
    got = X.select_articles(arts, topics)
    t1 = [r["doc_id"] for r in got.where("topic = 't1'").orderBy("rank").collect()]
    assert t1 == [300, 11, 100, 10, 9, 8, 7, 6, 5, 4]
    assert rows_of(got.where("topic = 't2'"), "doc_id") == [(300,)]


def test_summary_and_poll_average(spark):
    scored = spark.createDataFrame([("a", 0.5), ("a", None), (None, 1.0), ("b", -1.0)],
                                   "coin string, sentiment_score double")
    got = rows_of(X.sentiment_summary(scored, "2024-01-01 00:00:00"), "coin", "avg_sentiment", "article_count")
    assert got == sorted([("a", 0.5, 2), (None, 1.0, 1), ("b", -1.0, 1)], key=repr)
    coins = spark.createDataFrame([("a",), ("b",), ("c",)], "coin string")
    assert rows_of(X.poll_average(scored, coins), "coin", "avg_sentiment", "article_count") == [
        ("a", 0.5, 2), ("b", -1.0, 1), ("c", 0.0, 0)]


def test_restrict_by_table_is_a_semi_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    universe = spark.createDataFrame([("a",), ("c",), ("c",)], "coin string")
    assert rows_of(PL.restrict(df, universe), "id") == [("a",), ("c",)]


def test_decode_keeps_source_columns_and_kafka_sequence(spark):
    from pyspark.sql import functions as F
    raw = spark.createDataFrame([('{"id": "a", "timestamp": "2024-01-01T00:00:00Z"}', 3, 17)],
                                "value string, partition int, offset long")
    got = C.decode(raw.withColumn("seq", C.kafka_sequence()), keep=("seq",)).first()
    assert got["id"] == "a" and got["seq"] == (3 << 40) + 17
    assert raw.select(C.kafka_sequence().alias("s")).schema["s"].dataType.simpleString() == "bigint"
    assert F is not None


def test_filtered_messages_are_parsed_once(spark):
    """A filter on decoded columns doesn't parse the message again for each mention of them, and no message is lost."""
    n = F.col("id").cast("string")
    raw = spark.range(6).select(F.when(F.col("id") != 5, F.concat(F.lit('{"id": "a", "price_change_pct_24h": '), n, F.lit(', "timestamp": "2024-01-01T00:00:0'), n, F.lit('Z"}'))).alias("value"))
    ticks = C.decode_ticks(raw)
    found = ticks.where("id IS NOT NULL AND timestamp IS NOT NULL AND price_change_pct_24h <> 0 AND price_change_pct_24h < 4")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert rows_of(found, "id", "timestamp", "price_change_pct_24h") == [("a", at(i), float(i)) for i in (1, 2, 3)]
    assert ticks.where("id IS NULL").count() == 1


def test_times_with_and_without_a_zone(spark):
    times = {"2024-01-01T00:00:07Z": at(7), "2024-01-01 00:00:07 Z": at(7), "2024-01-01T00:00:07": at(7), "2024-01-01T01:00:07+01:00": at(7),
             "2024-01-01 13:00:07 NZ": at(7), "2024-01-01": at(0), "2024-01-01T00:00:07ZZ": None, "Z": None, "": None}
    df = spark.createDataFrame([(t, t) for t in times], "text string, timestamp string")
    assert {r["text"]: r["timestamp"] for r in C.parse_time(df).collect()} == times
