"""Flattening of source payloads into typed rows.

A payload is one API response: a JSON array of coin objects (market) or an
object with an ``articles`` array (news).  Both are exploded with built-in
generators on the executors; nothing is parsed on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketpulse.constants import UNKNOWN_SOURCE
from marketpulse.functions.labels import nan_to_null
from marketpulse.functions.time import now_utc
from marketpulse.schemas import MARKET_ITEM, NEWS_PAYLOAD

CHANGE_KEY = "price_change_percentage_24h"


def _as_of(as_of) -> F.Column:
    if as_of is None:
        return now_utc()
    if isinstance(as_of, str):
        return F.col(as_of)
    return as_of


def normalise_market(df: DataFrame, as_of="polled_at", payload: str = "payload", null_change: str = "zero") -> DataFrame:
    """Market payload (JSON array of coin objects) to ticks.

    Projects the six fields, renames the change key, stamps the poll time.  A
    missing change key gives 0.0; an explicit null gives 0.0 too, or stays null
    with ``null_change="keep"`` (the raw element is decoded once more as a map,
    which tells an absent key from a null one)."""
    elems = df.select(_as_of(as_of).alias("_at"),
                      F.explode(F.from_json(F.col(payload), T.ArrayType(T.StringType()))).alias("_e"))
    item = F.from_json("_e", MARKET_ITEM)
    change = nan_to_null(item[CHANGE_KEY])
    if null_change == "keep":
        present = F.map_contains_key(F.from_json("_e", T.MapType(T.StringType(), T.StringType())), CHANGE_KEY)
        change = F.when(present, change).otherwise(F.lit(0.0))
    else:
        change = F.coalesce(change, F.lit(0.0))
    return elems.select(
        item["id"].alias("id"), item["symbol"].alias("symbol"), nan_to_null(item["current_price"]).alias("current_price"),
        change.alias("price_change_pct_24h"), item["market_cap"].alias("market_cap"),
        item["total_volume"].alias("total_volume"), F.col("_at").alias("timestamp"))


def restrict(df: DataFrame, universe, key: str = "id") -> DataFrame:
    """Keep rows of a coin universe.  A short list becomes an ``IN``
    filter (pushed to the scan); a DataFrame of coins becomes a semi join."""
    if isinstance(universe, DataFrame):
        u = universe.select(F.col(universe.columns[0]).alias(key)).distinct()
        return df.join(u, key, "left_semi")
    return df.where(F.col(key).isin(list(universe)))


def normalise_articles(df: DataFrame, as_of="polled_at", payload: str = "payload", coin: str = "coin") -> DataFrame:
    """News payload to article rows: title and description default to
    empty, ``text = title + ". " + description``, source name defaults to
    ``unknown`` (also for an explicit null source), publishedAt to ``""``.

    ``article_id`` is a hash of the coin and the article's own fields, so a poll that
    returns an article again gives it the same id."""
    parsed = df.select(F.col(coin).alias("coin"), _as_of(as_of).alias("_at"),
                       F.from_json(F.col(payload), NEWS_PAYLOAD).alias("_p"))
    arts = parsed.select("coin", "_at", F.explode_outer("_p.articles").alias("a")).where(F.col("a").isNotNull())
    title = F.coalesce(F.col("a.title"), F.lit(""))
    desc = F.coalesce(F.col("a.description"), F.lit(""))
    ident = F.xxhash64("coin", "a.title", "a.description", "a.source.name", "a.publishedAt")
    return arts.select(
        ident.alias("article_id"), "coin", title.alias("title"), F.concat(title, F.lit(". "), desc).alias("text"),
        F.coalesce(F.col("a.source.name"), F.lit(UNKNOWN_SOURCE)).alias("source"),
        F.coalesce(F.col("a.publishedAt"), F.lit("")).alias("published_at"),
        F.col("_at").alias("timestamp"))
