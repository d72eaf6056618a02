"""Typed schemas of the data model (ticks, articles, summaries, subscriptions)."""

from pyspark.sql import types as T

# wire form of one tick message: the instant is ISO-8601 text
TICK_WIRE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("price_change_pct_24h", T.DoubleType()),
    T.StructField("market_cap", T.LongType()),
    T.StructField("total_volume", T.LongType()),
    T.StructField("timestamp", T.StringType()),
])

# wire form with our ingest sequence number (extra key, ignored by TICK_WIRE)
TICK_WIRE_SEQ = T.StructType(TICK_WIRE.fields + [T.StructField("seq", T.LongType())])

# stored tick: typed instant plus an ingest sequence used as a tie-break
TICK = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("price_change_pct_24h", T.DoubleType()),
    T.StructField("market_cap", T.LongType()),
    T.StructField("total_volume", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

TICK_VALUE_COLUMNS = ["symbol", "current_price", "price_change_pct_24h", "market_cap", "total_volume"]

ARTICLE_WIRE = T.StructType([
    T.StructField("coin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# market API payload element (a JSON array of these per poll)
MARKET_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("price_change_percentage_24h", T.DoubleType()),
    T.StructField("market_cap", T.LongType()),
    T.StructField("total_volume", T.LongType()),
])

# news API payload: {"articles": [{title, description, source: {name}, publishedAt}]}
NEWS_ARTICLE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("publishedAt", T.StringType()),
])
NEWS_PAYLOAD = T.StructType([T.StructField("articles", T.ArrayType(NEWS_ARTICLE))])

SENTIMENT_SUMMARY = T.StructType([
    T.StructField("coin", T.StringType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("article_count", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

SUBSCRIPTION = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("coin", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

SUBSCRIPTION_COMMAND = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("coin", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("polarity", T.DoubleType()),
])

TOPIC = T.StructType([
    T.StructField("coin", T.StringType()),
    T.StructField("terms", T.ArrayType(T.StringType())),
])
