"""Stand-ins for the remote sources of the registered queries: API payloads and
message files made from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.time import naive_utc
from marketpulse.sources.payloads import CHANGE_KEY


def market_payloads(ticks: DataFrame, poll_size: int = 10) -> DataFrame:
    """Inverse of S9 for fixtures and replays: ticks grouped into polls of at
    most ``poll_size`` consecutive sequence numbers, one JSON array per poll."""
    item = F.struct(F.col("id"), F.col("symbol"), F.col("current_price"),
                    F.col("price_change_pct_24h").alias(CHANGE_KEY), F.col("market_cap"), F.col("total_volume"))
    return (ticks.groupBy(F.floor(F.col("seq") / poll_size).alias("poll_id"))
            .agg(F.max("timestamp").alias("polled_at"), F.to_json(F.collect_list(item)).alias("payload")))


def news_payloads(articles: DataFrame, poll_size: int = 10) -> DataFrame:
    """Inverse of S11 for fixtures and replays: one ``{"articles": [...]}``
    object per coin and run of ``5 * poll_size`` consecutive article ids (the
    fixture spreads five coins over the ids, so a poll holds about
    ``poll_size`` articles; any input gives at most ``5 * poll_size``).  Null
    fields are left out."""
    art = F.struct(F.col("title"), F.col("description"), F.struct(F.col("source").alias("name")).alias("source"),
                   F.col("published_at").alias("publishedAt"))
    per_coin = F.floor(F.col("doc_id") / F.lit(5 * poll_size))
    return (articles.groupBy("coin", per_coin.alias("poll_id"))
            .agg(naive_utc(F.max("published_at").try_cast("timestamp")).alias("polled_at"),
                 F.to_json(F.struct(F.collect_list(art).alias("articles"))).alias("payload")))


def message_folder(df: DataFrame, base: str) -> str:
    """Stage messages as JSON-lines files: the offline stand-in of a topic."""
    path = f"{base}/topic"
    df.select("value").write.mode("overwrite").text(path)
    return path
