"""The bodies of the two producers: API payloads to messages-to-be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.constants import ARTICLES_PER_COIN
from marketpulse.operators.sentiment import score_text, select_articles
from marketpulse.sources.payloads import normalise_articles, normalise_market, restrict


def ingest_ticks(payloads: DataFrame, universe, as_of="polled_at", null_change: str = "zero") -> DataFrame:
    """S9 + S10: market payloads to the ticks of a coin universe, ready for
    ``encode`` and ``publish`` (S13)."""
    return restrict(normalise_market(payloads, as_of, null_change=null_change), universe)


def ingest_articles(payloads: DataFrame, topics: DataFrame, lexicon: DataFrame, as_of="polled_at", lang: str | None = None,
                    k: int = ARTICLES_PER_COIN) -> DataFrame:
    """S11 + S12 + X1: news payloads to scored article messages, the ``k`` newest of
    each topic, ready for ``encode`` and ``publish`` (S13).

    An article that several polls return is one article.  Payloads of one poll are
    in one language, so there is none to select by default (``lang`` needs a column of that name).
    Only the chosen articles are scored."""
    found = normalise_articles(payloads, as_of).dropDuplicates(["article_id"])
    chosen = select_articles(found, topics, lang, k, "article_id", "text", "published_at", keep=("title", "text", "source", "timestamp"))
    scored = score_text(chosen, lexicon, "article_id", "text", keep=("topic", "title", "source", "published_at", "timestamp"))
    return scored.select(F.col("topic").alias("coin"), "title", "sentiment_score", "sentiment_label", "source", "published_at", "timestamp")
