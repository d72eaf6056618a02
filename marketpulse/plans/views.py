"""Fixture views over the driver tables (FIXTURES.md §2).

Every view is a pure projection of a whole driver table: nulls and edge values
are injected by rule on the row's own id, never by dropping rows.  The DuckDB
twin of each view lives in ``plans/oracle.py`` and uses the same expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.labels import nan_to_null
from marketpulse.schemas import LEXICON, TOPIC
from marketpulse.session import ensure_utc

# fixed values of the fixture (FIXTURES.md §2)
COIN_BY_REMAINDER = ["click", "error", "purchase", "signup", "view"]
LEXICON_ROWS = [("that", 0.8), ("was", -0.6), ("with", 0.4), ("from", -0.9), ("this", 0.3), ("are", -0.2)]
TOPIC_ROWS = [("t1", ["he", "es"]), ("t2", ["ha", "re"]), ("t3", ["rewh"])]
ARTICLE_EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (the session zone is pinned to UTC first)."""
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def coin_of(remainder_col) -> F.Column:
    """Coin name from an id remainder 0..4."""
    expr = None
    for i, name in enumerate(COIN_BY_REMAINDER):
        expr = (F.when(remainder_col == i, F.lit(name)) if expr is None else expr.when(remainder_col == i, F.lit(name)))
    return expr


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a file stream (glob path: a plain file path is refused)."""
    ensure_utc(spark)
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tick`` view over ``events`` (one tick per event)."""
    return tick_projection(table(spark, sf_dir, "events"))


def tick_projection(events: DataFrame) -> DataFrame:
    """The tick columns of an ``events`` frame (batch or stream)."""
    eid = F.col("event_id")
    return events.select(
        F.col("event_type").alias("id"),
        F.substring("event_type", 1, 3).alias("symbol"),
        F.when(eid % 7 == 0, F.lit(None).cast("double")).otherwise(nan_to_null("value")).alias("current_price"),
        F.when(eid % 11 == 0, F.lit(0.0))
        .when(eid % 13 == 0, F.lit(None).cast("double"))
        .otherwise(nan_to_null(F.col("value") - 20.0)).alias("price_change_pct_24h"),
        (eid * 1000).alias("market_cap"),
        F.when(eid % 17 == 0, F.lit(None).cast("long"))
        .otherwise(F.get_json_object("props", "$.k").try_cast("long")).alias("total_volume"),
        F.col("ts").alias("timestamp"),
        eid.alias("seq"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``subscription`` view over ``customer`` (one subscription per customer)."""
    k = F.col("c_custkey")
    email = F.when(k % 23 == 0, F.concat(F.lit("user"), k.cast("string"), F.lit("example.com"))).otherwise(
        F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")))
    return table(spark, sf_dir, "customer").select(
        email.alias("email"),
        coin_of(k % 5).alias("coin"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.lit(0.5) + (k % 110) / F.lit(2.0)).alias("threshold"),
        F.when(k % 2 == 0, F.lit("drop")).otherwise(F.lit("rise")).alias("direction"),
        (F.lit(ARTICLE_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), k.cast("int"))).alias("created_at"),
    )


def subscription_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``subscription_command`` log over ``events`` (one command per event)."""
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), (F.col("user_id") % 20).cast("string"), F.lit("@example.com")).alias("email"),
        F.col("event_type").alias("coin"),
        F.when(eid % 9 == 0, F.lit("delete")).otherwise(F.lit("upsert")).alias("op"),
        F.col("value").alias("threshold"),
        F.when(eid % 2 == 0, F.lit("drop")).otherwise(F.lit("rise")).alias("direction"),
        F.col("ts").alias("ts"),
        eid.alias("seq"),
    )


def article_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news articles over ``documents`` (whole text: title line + rest)."""
    return article_projection(table(spark, sf_dir, "documents"))


def article_projection(documents: DataFrame) -> DataFrame:
    """The article columns of a ``documents`` frame (batch or stream)."""
    d = F.col("doc_id")
    text = F.col("text")
    nl = F.instr(text, "\n")
    rest = F.when(nl > 0, F.substr(text, nl + 1)).otherwise(F.lit(""))
    published = F.lit(ARTICLE_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), d.cast("int"))
    return documents.select(
        d.alias("doc_id"),
        coin_of(d % 5).alias("coin"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(d % 7 == 0, F.lit(None).cast("string")).otherwise(rest).alias("description"),
        F.when(d % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("source"),
        F.col("lang"),
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        text.alias("text"),
    )


def lexicon(spark: SparkSession) -> DataFrame:
    """The fixture's polarity lexicon (word, polarity)."""
    return spark.createDataFrame(LEXICON_ROWS, LEXICON)


def topics(spark: SparkSession) -> DataFrame:
    """The fixture's article topics (topic, terms)."""
    return spark.createDataFrame(TOPIC_ROWS, TOPIC)


def edge_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick messages with what real input has, injected by rule on the event's id:
    NaN changes, times that are no times, missing ids, missing sequences, and
    messages that are delivered twice."""
    eid = F.col("seq")
    t = ticks(spark, sf_dir)
    change = F.when(eid % 29 == 0, F.lit(float("nan"))).otherwise(F.col("price_change_pct_24h"))
    time = F.when(eid % 31 == 0, F.lit("soon")).otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    fields = {"id": F.when(eid % 37 != 0, F.col("id")), "symbol": F.col("symbol"), "current_price": F.col("current_price"), "price_change_pct_24h": change,
              "market_cap": F.col("market_cap"), "total_volume": F.col("total_volume"), "timestamp": time, "seq": F.when(eid % 43 != 0, eid)}
    message = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("value")
    return t.select(message, F.explode(F.sequence(F.lit(1), F.when(eid % 41 == 0, 2).otherwise(1)))).select("value")


def commands_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command log with missing times, emails and coins injected by rule."""
    eid = F.col("seq")
    return subscription_commands(spark, sf_dir).withColumns({
        "email": F.when(eid % 17 != 0, F.col("email")), "coin": F.when(eid % 19 != 0, F.col("coin")), "ts": F.when(eid % 13 != 0, F.col("ts"))})


def edge_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as several polls return them, injected by rule on the article's id:
    rows that come twice, ids that two texts share, and missing dates."""
    d = F.col("doc_id")
    twice = F.explode(F.sequence(F.lit(1), F.when(d % 4 == 0, 2).otherwise(1)))
    return article_inputs(spark, sf_dir).select(F.when(d % 5 == 0, d - 1).otherwise(d).alias("doc_id"),
                                                F.when(d % 3 != 0, F.col("published_at")).alias("published_at"), "lang", "text", twice).drop("col")
