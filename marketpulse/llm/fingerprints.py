"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text's fingerprint is the sum of wide vectors hashed from its paragraphs (its
lines), each lane modulo a power of two. Sums don't know an order, so texts of the same
paragraphs in any order agree, and a paragraph is inserted or deleted by adding
or subtracting its vector. A vector has two parts:

- 16 lanes modulo 2**32 from SHA-256 of the paragraph, for equality;
- 120 lanes modulo 2**14 that count, for each bit of a 120-bit MD5 prefix, the
  paragraph's pieces (runs of up to 8 words) with that bit set. The lanes of two
  texts differ by a random walk as long as their pieces differ, so the mean
  square of the differences estimates the pieces they don't share: a likeness.

Four counting lanes share a long, each with a guard bit that is cleared after
every addition, so no lane runs into the next and no sum overflows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketpulse.llm.common import n_points, table, whole

PIECE = r"[^\x20\x09-\x0D]+(?:[\x20\x09\x0B-\x0D]+[^\x20\x09-\x0D]+){0,7}"
EQUALITY_LANES = 16
STRIDE, FIELDS = 15, 4
LANES = 2 * STRIDE * FIELDS
_AT = [i * STRIDE for i in range(FIELDS)]
_BITS = sum(1 << at for at in _AT)
_FIELD = (1 << (STRIDE - 1)) - 1
_MASK = sum(_FIELD << at for at in _AT)
_GUARD = sum((_FIELD + 1) << at for at in _AT)
_WORD32 = (1 << 32) - 1


def _number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def _total(items: Column, lane) -> Column:
    """The sum of ``lane(item)``, masked after every addition."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: (a + lane(x)).bitwiseAND(F.lit(_MASK)))


def fingerprint_state(text: Column) -> Column:
    """Struct of ``equality`` (array of 16 longs), ``n`` (pieces) and ``pieces``
    (array of 30 longs). Of an empty or null text all are zero."""
    lines = F.filter(F.split(whole(text), "\n", -1), lambda p: p != "")
    digests = F.transform(lines, lambda p: F.concat(F.sha2(p, 256), F.sha2(F.concat(F.lit("2"), p), 256)))
    equality = F.aggregate(
        digests, F.array_repeat(F.lit(0).cast("long"), EQUALITY_LANES),
        lambda sums, d: F.transform(sums, lambda s, i: (s + F.conv(F.substring(d, i * 8 + 1, F.lit(8)), 16, 10).cast("long")).bitwiseAND(F.lit(_WORD32))))
    found = F.regexp_extract_all(whole(text), F.lit(PIECE), F.lit(0))
    halves = F.transform(F.transform(found, F.md5), lambda d: F.struct(_number(d, 1, 15).alias("a"), _number(d, 16, 15).alias("b")))
    # the halves are computed once: the outer transform binds them to a lambda's variable
    pieces = F.element_at(F.transform(F.array(halves), lambda hs: F.array(*[
        _total(hs, lambda h, half=half, k=k: F.shiftright(h[half], k).bitwiseAND(F.lit(_BITS))) for half in "ab" for k in range(STRIDE)])), 1)
    return F.struct(equality.alias("equality"), F.size(found).cast("long").alias("n"), pieces.alias("pieces"))


def combine(a: Column, b: Column) -> Column:
    """The state of the paragraphs of both: insertion."""
    return F.struct(
        F.zip_with(a["equality"], b["equality"], lambda x, y: (x + y).bitwiseAND(F.lit(_WORD32))).alias("equality"), (a["n"] + b["n"]).alias("n"),
        F.zip_with(a["pieces"], b["pieces"], lambda x, y: (x + y).bitwiseAND(F.lit(_MASK))).alias("pieces"))


def remove(a: Column, b: Column) -> Column:
    """The state of the paragraphs of ``a`` less those of ``b``: deletion."""
    return F.struct(
        F.zip_with(a["equality"], b["equality"], lambda x, y: (x + (1 << 32) - y).bitwiseAND(F.lit(_WORD32))).alias("equality"), (a["n"] - b["n"]).alias("n"),
        F.zip_with(a["pieces"], b["pieces"], lambda x, y: (x.bitwiseOR(F.lit(_GUARD)) - y).bitwiseAND(F.lit(_MASK))).alias("pieces"))


def fingerprint_text(state: Column) -> Column:
    """The whole state as text: equality lanes, pieces, counting lanes, in hex."""
    def hexed(xs: Column, digits: int) -> Column:
        return F.array_join(F.transform(xs, lambda x: F.lpad(F.lower(F.hex(x)), digits, "0")), "")
    return F.concat_ws("-", hexed(state["equality"], 8), F.lower(F.hex(state["n"])), hexed(state["pieces"], STRIDE))


def likeness(a: Column, b: Column) -> Column:
    """Estimated shared pieces over all pieces of two states, 0 to 1. Two texts
    without words: 1; one without words: 0."""
    more = a["n"] - b["n"]

    def square(x: Column, y: Column) -> Column:
        apart = None
        for at in _AT:
            step = F.shiftright(x, at).bitwiseAND(F.lit(_FIELD)) - F.shiftright(y, at).bitwiseAND(F.lit(_FIELD))
            walk = F.pmod(step * 2 - more + (_FIELD + 1), F.lit(2 * (_FIELD + 1))) - (_FIELD + 1)
            apart = walk * walk if apart is None else apart + walk * walk
        return apart
    off = F.aggregate(F.zip_with(a["pieces"], b["pieces"], square), F.lit(0).cast("long"), lambda s, x: s + x).cast("double")
    both = ((a["n"] + b["n"]) * LANES).cast("double")
    return (F.when((a["n"] == 0) & (b["n"] == 0), F.lit(1.0)).when((a["n"] == 0) | (b["n"] == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (both - off) / (both + off))))


#: Quantiles of doc_id between which buckets are dealt evenly
QUANTILES = 64


def _order_buckets(docs: DataFrame, least: int) -> Column | None:
    """A bucket number that rises with ``doc_id`` and spreads rows evenly: quantiles
    over all ids, and equal steps of id between them. Null ids come first."""
    row = docs.agg(F.percentile_approx("doc_id", [i / QUANTILES for i in range(1, QUANTILES)]), F.min("doc_id"), F.max("doc_id")).first()
    if row[1] is None:
        return None
    cuts = sorted({x for x in row[0] if x > row[1]})
    steps = -(-least // (len(cuts) + 1))
    edges = F.array(*[F.lit(float(x)) for x in [row[1], *cuts, row[2] + 1]])
    x = F.col("doc_id").cast("double")
    at = F.greatest(F.lit(1), F.size(F.filter(F.array(*[F.lit(x) for x in [row[1], *cuts]]), lambda c: c <= F.col("doc_id"))))
    low, high = F.element_at(edges, at), F.element_at(edges, at + 1)
    step = F.least(F.lit(steps - 1), F.floor(F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0)) * steps))
    return F.coalesce((at - 1) * steps + step, F.lit(0)).cast("int")


def with_next(docs: DataFrame, columns: list[str], nearest: list[str]) -> DataFrame:
    """Each row with the ``columns`` of the next row by descending ``doc_id`` (after
    the last: the first) as ``next_<column>``. Null ids come last; rows of one id
    are ordered by the columns ``nearest``.

    Rows are dealt by bucket of id. The first row of every bucket is also sent to
    the bucket before it, so one exchange does; the list of those first rows has
    an entry per bucket."""
    spark = docs.sparkSession
    bucket = _order_buckets(docs, max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = docs.withColumn("bucket", F.lit(0) if bucket is None else bucket)
    firsts = sorted((r["bucket"], r["id"]) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("id")).collect())
    if not firsts:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    targets = [*[b for b, _ in firsts[1:]], firsts[0][0]]
    guests = spark.createDataFrame([(b, i, t) for (b, i), t in zip(firsts, targets)], "own_bucket int, first_id long, guest_of int")
    at_home = (F.col("bucket") == F.col("own_bucket")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    places = F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest")), F.struct(F.col("guest_of").alias("b"), F.lit(1).alias("guest")))
    dealt = (rows.join(F.broadcast(guests), at_home, "left")
             .withColumn("place", F.explode(F.filter(places, lambda p: p["b"].isNotNull()))))
    order = Window.partitionBy("place.b").orderBy("place.guest", F.col("doc_id").desc_nulls_last(), *nearest)
    return (dealt.select(*docs.columns, "place", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
            .where("place.guest = 0").drop("place"))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    Null texts count as empty; texts of any length are read whole. Equal texts
    have equal fingerprints. A single document is its own next. Repeated rows of
    an id follow each other by text. An empty table gives an empty result;
    columns other than ``doc_id`` and ``text`` are not looked at."""
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn("state", fingerprint_state(F.col("text")))
    rows = with_next(rows, ["text", "state"], ["text"])
    size = n_points(F.col("text"))
    n_new = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (size - n_new).cast("int")), F.substring("next_text", F.lit(1), n_new))
    rows = rows.select("doc_id", size.alias("n_chars"), "state", "next_state", edited.alias("edited"))
    rows = rows.withColumn("edited_state", fingerprint_state(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint_text(F.col("state")).alias("fingerprint"),
        fingerprint_text(F.col("edited_state")).alias("edited_fingerprint"),
        likeness(F.col("state"), F.col("edited_state")).alias("near_edited"), likeness(F.col("state"), F.col("next_state")).alias("near_next"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"))


def _op2_sql() -> str:
    equality = ", ".join(f"sum(('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT)::BIGINT & {_WORD32} AS e{i}" for i in range(EQUALITY_LANES))
    counts = ", ".join(f"sum(({half} >> {k}) & {_BITS})::BIGINT & {_MASK} AS {half}{k}" for half in "ab" for k in range(STRIDE))
    names = [f"{half}{k}" for half in "ab" for k in range(STRIDE)]

    def hexed(columns: list[str], digits: int) -> str:
        return " || ".join(f"lpad(lower(to_hex(coalesce({c}, 0))), {digits}, '0')" for c in columns)

    def near(other: str) -> str:
        more = f"(s.n - {other}.n)"
        walks = [f"((((((coalesce(s.{c}, 0) >> {at}) & {_FIELD}) - ((coalesce({other}.{c}, 0) >> {at}) & {_FIELD})) * 2 - {more} + {_FIELD + 1}) % {2 * (_FIELD + 1)}"
                 f" + {2 * (_FIELD + 1)}) % {2 * (_FIELD + 1)} - {_FIELD + 1})" for c in names for at in _AT]
        off, both = "(" + " + ".join(f"{w} * {w}" for w in walks) + ")::DOUBLE", f"((s.n + {other}.n) * {LANES})::DOUBLE"
        return f"CASE WHEN s.n = 0 AND {other}.n = 0 THEN 1.0::DOUBLE WHEN s.n = 0 OR {other}.n = 0 THEN 0.0::DOUBLE ELSE greatest(0.0, ({both} - {off}) / ({both} + {off})) END"

    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS nth, count(*) OVER () AS n_docs FROM documents),
p AS (SELECT a.*, b.text AS next_text, b.nth AS next_nth, length(a.text) AS n_chars FROM d a JOIN d b ON b.nth = a.nth % a.n_docs + 1),
t AS (
  SELECT nth, 0 AS edited, text FROM p UNION ALL
  SELECT nth, 1, substr(text, 1, n_chars - n_chars // 3) || substr(next_text, 1, n_chars // 3) FROM p),
l AS (SELECT nth, edited, unnest(string_split(text, chr(10))) AS line FROM t),
e AS (SELECT nth, edited, {equality} FROM (SELECT nth, edited, sha256(line) || sha256('2' || line) AS digest FROM l WHERE line <> '') GROUP BY nth, edited),
m AS (SELECT nth, edited, md5(unnest(regexp_extract_all(text, '{PIECE}'))) AS digest FROM t),
h AS (SELECT nth, edited, ('0x' || substr(digest, 1, 15))::BIGINT AS a, ('0x' || substr(digest, 16, 15))::BIGINT AS b FROM m),
c AS (SELECT nth, edited, count(*) AS n_pieces, {counts} FROM h GROUP BY nth, edited),
s AS (
  SELECT t.nth, t.edited, t.text, coalesce(n_pieces, 0) AS n, c.* EXCLUDE (nth, edited, n_pieces),
    ({hexed([f"e{i}" for i in range(EQUALITY_LANES)], 8)}) || '-' || lower(to_hex(coalesce(n_pieces, 0))) || '-' || ({hexed(names, STRIDE)}) AS fingerprint
  FROM t LEFT JOIN e ON e.nth = t.nth AND e.edited = t.edited LEFT JOIN c ON c.nth = t.nth AND c.edited = t.edited)
SELECT p.doc_id, p.n_chars, sha256(x.text) AS edited_sha256, s.fingerprint, x.fingerprint AS edited_fingerprint, {near("x")} AS near_edited, {near("y")} AS near_next
FROM p JOIN s ON s.nth = p.nth AND s.edited = 0 JOIN s x ON x.nth = p.nth AND x.edited = 1 JOIN s y ON y.nth = p.next_nth AND y.edited = 0
"""


OP2_SQL = _op2_sql()
