"""Article scoring and sentiment summaries.

Text is tokenised and looked up in place: while the lexicon and the topics are under
the session's broadcast limit they are constants of the plan, and an article is scored
or matched inside its own row, without a join, an aggregate or a shuffle.  Larger ones
are joined to the tokens.  Whole texts are scored, and scores and means are not
rounded: polarities are summed in the order of the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.constants import ARTICLE_LANGUAGE, ARTICLES_PER_COIN
from marketpulse.functions.labels import sentiment_label
from marketpulse.functions.time import now_utc
from marketpulse.operators.joins import looked_up, measured_within_limit, one_of_each

# token = maximal run of letters (any script), case-folded
NON_LETTERS = r"[^\p{L}]+"


def tokens(text) -> F.Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(t), NON_LETTERS)


def _mean(polarities: Column) -> Column:
    """Mean of an array, summed from its start; 0.0 when there is none."""
    total = F.aggregate(polarities, F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(total, F.size(polarities).cast("double")), F.lit(0.0))


def score_text(articles: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text: str = "text",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """X1 + P5: polarity in [-1, 1] per article = mean polarity of its tokens
    found in the lexicon (every occurrence counts), 0.0 when none is found.

    One row per input row, also where ids repeat; ``keep`` columns ride along.  A word
    that the lexicon lists more than once (or in two cases) counts once, with its mean
    polarity.  The score is not rounded; polarities are summed in the order of the
    words, so it is the same in every run."""
    lex = lexicon.where(F.col("word").isNotNull()).groupBy(F.lower("word").alias("_tok")).agg(F.avg("polarity").alias("_pol"))
    if measured_within_limit(lex):
        polarity = looked_up([(r["_tok"], r["_pol"]) for r in lex.collect()], "double")
        scored = articles.select(id_col, *keep, F.coalesce(_mean(F.array_compact(F.transform(tokens(text), polarity))), F.lit(0.0)).alias("_score"))
    else:
        scored = _scored_by_join(articles, lex, id_col, text, keep)
    return scored.select(id_col, *keep, F.col("_score").alias("sentiment_score"), sentiment_label("_score").alias("sentiment_label"))


def _scored_by_join(articles: DataFrame, lex: DataFrame, id_col: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The same for a lexicon that is too large for the plan: tokens are joined, and a
    row's hits come back in the order of their places.  Rows are told apart by a number of their
    own; the first token's row carries the article's columns, the others only its number."""
    rows = articles.select(F.monotonically_increasing_id().alias("_row"), F.struct(id_col, *keep).alias("_keep"), tokens(text).alias("_toks"))
    toks = rows.select("_row", "_keep", F.posexplode_outer("_toks").alias("_pos", "_tok"))
    toks = toks.withColumn("_keep", F.when(F.coalesce(F.col("_pos") == 0, F.lit(True)), F.col("_keep")))
    hit = F.when(F.col("_pol").isNotNull(), F.struct("_pos", "_pol"))
    scored = toks.join(lex, "_tok", "left").groupBy("_row").agg(F.first("_keep", ignorenulls=True).alias("_keep"), F.sort_array(F.collect_list(hit)).alias("_hits"))
    return scored.select("_keep.*", _mean(F.col("_hits")["_pol"]).alias("_score"))


def with_scores(articles: DataFrame, lexicon: DataFrame, keep: tuple[str, ...] = ("coin",), id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Article id, the ``keep`` columns, score and label."""
    return score_text(articles, lexicon, id_col, text, keep)


def _topics_of(articles: DataFrame, topics: DataFrame, text: str) -> DataFrame:
    """``articles`` with a row per topic (``topic``) whose terms all occur in the text."""
    terms = (topics.select(F.col("coin").alias("topic"), F.explode("terms").alias("_tok"))
             .where("topic is not null and _tok is not null").select("topic", F.lower("_tok").alias("_tok")).distinct())
    terms = terms.join(terms.groupBy(F.col("topic").alias("t")).agg(F.count("*").alias("_n")), F.col("topic") == F.col("t")).drop("t")
    if measured_within_limit(terms):
        by_word: dict[str, list] = {}
        for r in terms.collect():
            by_word.setdefault(r["_tok"], []).append({"topic": r["topic"], "n": r["_n"]})
        of = looked_up(list(by_word.items()), "array<struct<topic:string,n:int>>")
        hits = F.array_sort(F.flatten(F.array_compact(F.transform(one_of_each(tokens(text)), of))))
        # distinct words and distinct terms: a topic has as many hits as terms that occur, side by side after the sort
        whole = F.filter(F.col("_hits"), lambda h, i: F.coalesce(
            (F.get("_hits", i + h["n"] - 1)["topic"] == h["topic"]) & ((i == 0) | ~F.get("_hits", i - 1)["topic"].eqNullSafe(h["topic"])), F.lit(False)))
        return articles.withColumn("_hits", hits).withColumn("topic", F.explode(F.transform(whole, lambda h: h["topic"]))).drop("_hits")
    rows = articles.withColumn("_row", F.monotonically_increasing_id())
    toks = rows.select("_row", F.struct(*articles.columns).alias("_keep"), F.explode(one_of_each(tokens(text))).alias("_tok"))
    matched = toks.join(terms, "_tok").groupBy("_row", "topic", "_n").agg(F.count(F.lit(1)).alias("_hit"), F.first("_keep").alias("_keep"))
    return matched.where(F.col("_hit") == F.col("_n")).select("_keep.*", "topic")


def _ranked(matched: DataFrame, k: int, published: str, id_col: str, ties: list[str]) -> DataFrame:
    w = Window.partitionBy("topic").orderBy(F.col(published).desc_nulls_last(), F.col(id_col).asc_nulls_last(), *ties)
    return matched.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def select_articles(articles: DataFrame, topics: DataFrame, lang: str | None = ARTICLE_LANGUAGE,
                    k: int = ARTICLES_PER_COIN,
                    id_col: str = "doc_id", text: str = "text", published: str = "published_at",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Per topic, the ``k`` newest articles (ties by id) in ``lang`` whose
    tokens contain every term of the topic (case-insensitive).  An article
    matching several topics is returned once per topic.

    Every row is an article by itself, also where ids repeat: it is matched on its own
    tokens, inside the row while the topics are under the session's broadcast limit.  Articles
    without a date come after those with one.  The top-k window gets a partial group
    limit before its shuffle, so ``keep`` columns travel with at most ``k`` rows per topic
    and input partition.  ``rank`` is the place within the topic."""
    src = articles if lang is None else articles.where(F.col("lang") == lang)
    columns = list(dict.fromkeys([id_col, published, text, *keep]))
    matched = _topics_of(src.select(*columns), topics, text).withColumn("_tie", F.xxhash64(text))
    return _ranked(matched.select("topic", id_col, published, *[c for c in keep if c not in (id_col, published)], "_tie"), k, published, id_col,
                   ["_tie"]).select("topic", id_col, published, "rank", *[c for c in keep if c not in (id_col, published)])


def newest_across_polls(before: DataFrame, poll: DataFrame, k: int = ARTICLES_PER_COIN, id_col: str = "doc_id", published: str = "published_at") -> DataFrame:
    """The top-k state of S12 after another poll: of two results of ``select_articles``
    (same columns) the ``k`` newest per topic, an article that both have once.  What a topic's
    state holds is all that later polls need, so older polls aren't read again."""
    both = before.unionByName(poll).drop("rank").dropDuplicates(["topic", id_col, published])
    return _ranked(both, k, published, id_col, []).select(*before.columns)


def sentiment_summary(scored: DataFrame, as_of=None, coin: str = "coin", score: str = "sentiment_score") -> DataFrame:
    """A1 + T4: per coin, mean score (nulls skipped) and row count (nulls
    counted); a null coin is its own group; one timestamp for the whole batch."""
    stamp = now_utc() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return scored.groupBy(coin).agg(
        F.avg(score).alias("avg_sentiment"),
        F.count(F.lit(1)).cast("int").alias("article_count"),
    ).withColumn("timestamp", stamp)


def poll_average(scored: DataFrame, coins: DataFrame, coin: str = "coin", score: str = "sentiment_score") -> DataFrame:
    """A2: per coin of the universe, mean score over the poll with 0.0 and 0
    for a coin without articles.  Both join sides are one row per coin."""
    agg = scored.groupBy(coin).agg(F.avg(score).alias("_avg"), F.count(F.lit(1)).alias("_n"))
    return coins.select(coin).join(agg, coin, "left").select(
        coin, F.coalesce("_avg", F.lit(0.0)).alias("avg_sentiment"),
        F.coalesce("_n", F.lit(0)).cast("int").alias("article_count"))
