"""Exact de-duplication by content-defined chunk recipes.

A text without its ASCII white space is cut into chunks whose ends depend on the
content alone; a document's recipe is the ordered list of its chunks'
identifiers. Documents are equal when their recipes are. An identifier is a
64-bit hash that is verified: distinct chunks meet once, and where different chunks
share a hash, a recipe has the number of its chunk among them as well. So long
texts move once, as distinct chunks; everything after that handles recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketpulse.llm.common import BLANK, n_points, stored, table, whole

#: A chunk ends at the first sentence mark after 512 code points; where there is none up to 2048, after the first
#: doubled code point, so that text without such marks is cut by its content as well; or after 4096 code points.
#: Marks at strictly regular distances are the exception: cuts that an insertion shifted may then never meet the old ones.
CHUNK = r"(?s).{512,2047}?[.!?\u3002\uFF01\uFF1F]|.{512,4094}?(.)\1|.{1,4096}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(whole(text), BLANK + "+", "")


def chunks_of(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit(CHUNK), F.lit(0))


def _identifier(chunk: Column, bits: int) -> Column:
    return F.xxhash64(chunk) if bits == 64 else F.xxhash64(chunk).bitwiseAND(F.lit((1 << bits) - 1))


def _distinct_chunks(docs: DataFrame, bits: int) -> DataFrame:
    chunk = F.explode(chunks_of(normalised(F.col("text")))).alias("chunk")
    return docs.select(chunk).select(_identifier(F.col("chunk"), bits).alias("id"), "chunk").distinct()


def clashing_identifiers(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``id``: hashes that two different chunks share. By the birthday bound some
    N**2 / 2**65 of N distinct chunks do: none up to billions, hundreds in 100 TB, but
    any number in crafted text; so they stay a table."""
    return _distinct_chunks(docs, bits).groupBy("id").count().where("count > 1").select("id")


def recipe(normal: Column, bits: int = 64) -> Column:
    """Ordered identifiers of a text's chunks."""
    return F.transform(chunks_of(normal), lambda c: _identifier(c, bits))


def _marks(docs: DataFrame, clashes: DataFrame, bits: int) -> DataFrame:
    """Per text (``m_sha``) with clashing identifiers: ``marks``, their places and the
    chunk's number among those that share the identifier."""
    one_id = Window.partitionBy("id").orderBy("chunk")
    numbered = _distinct_chunks(docs, bits).join(clashes, "id").withColumn("nth", F.row_number().over(one_id)).select(
        F.col("id").alias("n_id"), F.col("chunk").alias("n_chunk"), "nth")
    normal = docs.select(normalised(F.col("text")).alias("normal")).distinct()
    places = normal.select(F.sha2("normal", 256).alias("m_sha"), F.posexplode(chunks_of(F.col("normal"))).alias("place", "chunk"))
    found = places.join(numbered, (_identifier(F.col("chunk"), bits) == F.col("n_id")) & (F.col("chunk") == F.col("n_chunk")))
    return found.groupBy("m_sha").agg(F.sort_array(F.collect_list(F.struct("place", "nth"))).alias("marks"))


def exact_classes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_chars`` (code points of the original text).

    Null and empty texts, and texts of white space alone, are one class. Of a
    class the row with the most code points stays, then the smallest ``doc_id``
    (null ids last); of repeated rows with all that equal, one. Texts of any
    length are read whole. An empty table gives an empty result; columns other
    than ``doc_id`` and ``text`` are not looked at. ``bits`` under 64 makes
    clashes likely, for tests."""
    docs = docs.select("doc_id", "text")
    clashes = stored(clashing_identifiers(docs, bits), "clashes")
    normal = docs.select("doc_id", n_points(whole(F.col("text"))).alias("n_chars"), normalised(F.col("text")).alias("normal"))
    rows = stored(normal.select(
        "doc_id", "n_chars", F.sha2("normal", 256).alias("text_sha256"), recipe(F.col("normal"), bits).alias("recipe"),
        F.monotonically_increasing_id().alias("row")), "recipes")
    # ~x turns the order of x round without overflow; null sorts below every value
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("last_id"), F.bitwise_not("row").alias("last_row")))
    key = ["recipe"]
    if not clashes.isEmpty():
        marked = rows.join(_marks(docs, clashes, bits), F.col("text_sha256") == F.col("m_sha"), "left").drop("m_sha")
        rows, key = stored(marked.withColumn("marks", F.coalesce("marks", F.array().cast("array<struct<place:int,nth:int>>"))), "marked-recipes"), ["recipe", "marks"]
    groups = stored(rows.groupBy(*key).agg(F.count("*").alias("group_size"), best.alias("best")), "classes")
    return rows.join(groups, key).select(
        "doc_id", F.bitwise_not("best.last_id").alias("keep_id"), "group_size",
        (F.col("row") == F.bitwise_not("best.last_row")).alias("kept"), "text_sha256", "n_chars")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_classes`` keeps, with all their columns."""
    key = ["k_id", "k_chars", "k_sha"]
    kept = exact_classes(docs).where("kept").select(
        F.col("doc_id").alias("c_id"), F.col("n_chars").alias("c_chars"), F.col("text_sha256").alias("c_sha"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("k_id"), n_points(whole(F.col("text"))).alias("k_chars"),
                       F.sha2(normalised(F.col("text")), 256).alias("k_sha"))
    on = F.col("k_id").eqNullSafe(F.col("c_id")) & (F.col("k_chars") == F.col("c_chars")) & (F.col("k_sha") == F.col("c_sha"))
    one = Window.partitionBy(*key).orderBy("k_id")  # repeated rows of one id and text
    return (rows.join(kept, on, "left_semi").withColumn("nth", F.row_number().over(one)).where("nth = 1").select("doc.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS normal
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size
  FROM n WINDOW w AS (PARTITION BY normal ORDER BY n_chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256 FROM k
"""
