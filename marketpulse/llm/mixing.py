"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target in words. Complete epochs come first; the rest of the
target is filled by whole documents in the order of exponential keys
``-ln(u) / weight``, ``u`` hashed from the id and ``weight`` the document's
quality. Keys are sorted in two steps, so that no task holds a source: a
histogram of the words per key bucket is summed up to the budget, and only the
bucket in which the budget ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketpulse.llm.common import WORD, discard, stored, table, whole

#: Weights of the sources in code-point order, repeating
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix"
#: Key buckets per source. Only one bucket of a source is sorted as rows.
BUCKETS = 4096
_NO_ID = -(1 << 63)


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def letter_quality(text: Column) -> Column:
    """0.25 to 1: the share of letters and white space in a text (empty: 0.25)."""
    kept = F.char_length(F.regexp_replace(whole(text), r"[^\p{L}\x20\x09-\x0D]+", ""))
    return F.lit(0.25) + F.lit(0.75) * F.coalesce(F.try_divide(kept.cast("double"), F.char_length(whole(text)).cast("double")), F.lit(0.0))


def exponential_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13), 16, 10)
    return -F.log((hashed.cast("double") + 0.5) / F.lit(float(1 << 52))) / weight


def _bucket(key: Column) -> Column:
    """Rises with the key, spread over the buckets for weights about 0.25 to 1."""
    return F.least(F.lit(BUCKETS - 1), F.floor((1.0 - F.exp(key * -0.625)) * BUCKETS)).cast("int")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` -> with ``target``: shares of ``SHARE`` of all words
    by weight, filled up to ``MOST_EPOCHS`` times a source's words.

    A table of sources has a row per source, not per document; its windows
    without a partition sort those few rows."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    everything, order = Window.partitionBy(), Window.orderBy("full_at", "nth")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    budget = F.col("total") * F.lit(SHARE)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    taken_up = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0))
    return (sizes.withColumn("nth", rank)
            .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("nth") - 1) % len(WEIGHTS) + 1))
            .withColumn("cap", F.col("source_size") * MOST_EPOCHS)
            .withColumn("full_at", F.col("cap") / F.col("weight"))
            .withColumn("total", F.sum("source_size").over(everything))
            .withColumn("full", F.col("full_at") <= level)
            .select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
                F.col("weight") * (budget - taken_up) / open_weight).alias("target")))


def quotas(rows: DataFrame) -> DataFrame:
    """``doc_id, source, size, key`` -> a row per source: ``source, source_size,
    target, epochs`` (complete ones), and up to where in the order of (bucket,
    key, doc_id) the documents are taken once more: ``last_bucket, last_key,
    last_id``. The document at the end of the budget is taken if that comes nearer
    to the target. Rows of equal key and id are taken together."""
    rows = rows.withColumn("bucket", _bucket(F.col("key"))).withColumn("nn_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    table_of_targets = stored(source_targets(sizes)
                  .withColumn("epochs", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)))
                  .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    plan = table_of_targets.withColumnRenamed("source", "p_source")
    mine = F.col("source").eqNullSafe(F.col("p_source"))
    up_to = Window.partitionBy("source").orderBy("bucket")
    edge = (rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
            .withColumn("through", F.sum("words").over(up_to)).withColumn("before", F.col("through") - F.col("words"))
            .join(plan.select("p_source", "rest"), mine).where("before < rest and through >= rest")
            .select(F.col("source").alias("e_source"), F.col("bucket").alias("e_bucket"), "before", "rest"))
    peers = Window.partitionBy("source").orderBy("key", "nn_id")
    there = F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("e_bucket"))
    ends = (rows.join(edge, there)
            .withColumn("through", F.col("before") + F.sum("size").over(peers))
            .withColumn("start", F.col("through") - F.sum("size").over(Window.partitionBy("source", "key", "nn_id")))
            .groupBy("source").agg(F.first("bucket").alias("last_bucket"), F.max(F.when(
                F.col("through") + F.col("start") < 2 * F.col("rest"), F.struct("key", "nn_id"))).alias("last"))
            .select(F.col("source"), "last_bucket", F.col("last.key").alias("last_key"), F.col("last.nn_id").alias("last_id")))
    found = stored(plan.join(ends, mine, "left").select(
        "p_source", "source_size", "target", "epochs", "last_bucket", "last_key", "last_id"), "quotas")
    discard(table_of_targets)
    return found


def _copies() -> Column:
    """Of a row with its key, nn_id and quota: how often the mix takes it."""
    once_more = (_bucket(F.col("key")) < F.col("last_bucket")) | ((_bucket(F.col("key")) == F.col("last_bucket")) & (
        (F.col("key") < F.col("last_key")) | ((F.col("key") == F.col("last_key")) & (F.col("nn_id") <= F.col("last_id")))))
    return F.col("epochs") + F.coalesce(once_more, F.lit(False)).cast("long")


def _keyed(docs: DataFrame, *more) -> DataFrame:
    text, nn_id = F.col("text"), F.coalesce("doc_id", F.lit(_NO_ID)).alias("nn_id")
    return docs.select(*more, F.col("source").alias("source"), nn_id, exponential_key(F.col("doc_id"), letter_quality(text)).alias("key"))


def mixed(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, size, source, source_size, target, taken``.

    Null texts have no words; null sources are one source, null ids one id. A
    source without words has target 0. An empty table gives an empty result.
    Columns other than ``doc_id``, ``text`` and ``source`` are not looked at."""
    rows = stored(_keyed(docs, "doc_id", n_words(F.col("text")).alias("size")), "mix-keys")
    return rows.join(quotas(rows), F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id", "size", "source", "source_size", "target", (F.col("size") * _copies()).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, all columns, a row for each time one is taken."""
    rows = stored(_keyed(docs, "doc_id", n_words(F.col("text")).alias("size")), "mix-keys")
    quota = quotas(rows)
    return (_keyed(docs, F.struct("*").alias("doc")).join(quota, F.col("source").eqNullSafe(F.col("p_source")))
            .select("doc", F.explode(F.array_repeat(F.lit(0), _copies().cast("int")))).select("doc.*"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
    / (0.25 + 0.75 * coalesce(length(regexp_replace(coalesce(text, ''), '[^\p{L}\x20\x09-\x0D]+', '', 'g'))::DOUBLE
                              / nullif(length(coalesce(text, '')), 0), 0)) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth, sum(source_size) OVER () AS total FROM s),
w AS (SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM r),
f AS (
  SELECT *, cap / weight <= (total * 1.5 - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM w),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE weight * (total::DOUBLE * 1.5 - coalesce(sum(cap) FILTER (is_full) OVER (), 0)::DOUBLE)
    / (sum(weight) FILTER (NOT is_full) OVER ())::DOUBLE END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id) AS through
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN 2 * through - size < 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM p
"""
