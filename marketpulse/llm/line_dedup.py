"""Fuzzy line de-duplication.

Lines are normalised (letters and digits in lower case, single spaces) and get a
SimHash of their distinct words. Equal lines are one node, its first occurrence standing
for it. Nodes meet in buckets by two pigeonhole schemes. SimHashes within two bits
agree in at least two of four blocks, a bucket for each pair of blocks. And words are
dealt by hash into five blocks: a replaced word alters two of them at most, so the
others agree. What meets within ``DISTANCE`` bits is confirmed by edit distance.
Of each connected group one occurrence stays. ``linking`` sees to it that large
groups aren't paired in full.
"""

from __future__ import annotations

from decimal import Decimal
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import discard, stored, table, whole
from marketpulse.llm.linking import linked_components, with_partner

#: Bits of the SimHash, and how many of them a long counts at once: seven in lines of up to 511 distinct
#: words, three in longer ones
BITS = 63
SHORT, LONG = 7, 3
#: SimHashes may differ in so many bits: one of five words replaced moves 13 of 63 on average, give or take 3
DISTANCE = 20
#: SimHashes within so many bits always meet; blocks as (first bit, width), of which two agree then
CLOSE = 2
BLOCKS = ((0, 16), (16, 16), (32, 16), (48, 15))
#: Blocks of words, and the keys made of them by the line's number of words (from, to), blocks in a key and
#: words that a key must have. The ranges overlap by two words, so that lines a word or two apart share one.
WORD_BLOCKS = 5
WORD_KEYS = ((1, 11, 3, 2), (10, 21, 2, 3), (20, 1 << 62, 1, 2))
#: Bits of a count of a block's words, and words of a line from which on the counts aren't looked at
HELD, MANY = 12, 4000
#: Distinct words up to which seven fields hold the counts, and UTF-8 bytes of every raw line that has more. A word
#: takes two bytes and a blank (or a letter that ends its word, as a dotted I), but for 36 words of one byte.
FEW_WORDS = (1 << BITS // SHORT) - 1
LONG_BYTES = 2 * (FEW_WORDS + 1) - 1
#: Words of longer lines are counted in runs: the fields of 21 bits hold no more
CHUNK = 20
#: Edits allowed per hundred code points of the longer line
PERCENT_EDITS = 20
#: Long lines are compared in cuts of up to so many code points; within a cut, more edits than this count as all of it.
CUT, CUT_EDITS = r"(?s).{512,1023}? |.{1,1024}", 1024 * PERCENT_EDITS // 100
#: Looked for first: a distance takes time in proportion to its limit, and most near lines have few edits.
FEW_EDITS = 16
#: Words of two lines that may stand for each other where the lines part, fewest first
GAPS = ((1, 1), (0, 1), (1, 0), (1, 2), (2, 1), (0, 2), (2, 0), (2, 2))
#: A place is doc_id * _LINES + line_no, exact as a decimal; a missing id comes after all others
_LINES, _NO_ID = Decimal(1 << 31), Decimal(1 << 63)


def normalised_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _lines(docs: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``doc_id, line_no, line`` (normalised), ``h``, ``n`` (code points) of lines with a letter or digit
    (and so many bytes before they are normalised)."""
    split = docs.select("doc_id", F.posexplode(F.split(whole(F.col("text")), "\n", -1)).alias("line_no", "raw"))
    if least_bytes:
        split = split.where(F.octet_length("raw") >= least_bytes)
    return (split.select("doc_id", F.col("line_no").cast("long").alias("line_no"), normalised_line(F.col("raw")).alias("line")).where("line <> ''")
            .withColumn("h", F.xxhash64("line")).withColumn("n", F.char_length("line")))


_LINE = ["doc_id", "line_no", "h", "n"]
_BLOCK = [f"b{i}" for i in range(WORD_BLOCKS)]


def _counted(lines: DataFrame, fields: int) -> DataFrame:
    """Per line of every row: ``words`` (distinct ones), how many have bit i as ``f<i>``,
    the words of each block as the sum of their hashes, and ``held``, how many words the
    blocks have. A row's lines are counted on their own, so repeated rows don't add
    up. Lines of many words are counted by runs of words, whose counts fit their fields."""
    stride = BITS // fields
    ones = sum(1 << i * stride for i in range(fields))
    whole_line = [*_LINE, "row"]
    run = ["run"] if fields == LONG else []
    hashed = lines.select(*whole_line, F.posexplode("hashes").alias("pos", "w")).withColumn("run", F.shiftright("pos", CHUNK))
    hashed = hashed.withColumn("block", F.pmod("w", F.lit(WORD_BLOCKS)).cast("int"))
    sums = [F.sum(F.shiftright("w", k).bitwiseAND(F.lit(ones))).alias(f"c{k}") for k in range(stride)]
    sums += [F.coalesce(F.sum(F.when(F.col("block") == i, F.shiftrightunsigned("w", 32))), F.lit(0)).alias(b) for i, b in enumerate(_BLOCK)]
    # beyond MANY words, when a sum may run over, nothing looks at it
    sums.append(F.coalesce(F.try_sum(F.expr(f"shiftleft(1L, block * {HELD})")), F.lit(0)).alias("held"))
    counted = hashed.groupBy(*whole_line, *run).agg(F.count("*").alias("words"), *sums)
    bits = [F.shiftright(f"c{k}", f * stride).bitwiseAND(F.lit((1 << stride) - 1)).alias(f"f{f * stride + k}") for f in range(fields) for k in range(stride)]
    counted = counted.select(*whole_line, "words", "held", *_BLOCK, *bits)
    if not run:
        return counted
    return counted.groupBy(*whole_line).agg(F.sum("words").alias("words"), F.max("held").alias("held"), *[F.sum(b).alias(b) for b in _BLOCK],
                                            *[F.sum(f"f{i}").alias(f"f{i}") for i in range(BITS)])


def with_simhash(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, h, n, sim, words, held, b0..b4``: bit i of ``sim`` is set
    when it is in the hashes of more than half of the line's distinct words."""
    out = None
    for fields, least_bytes in ((SHORT, 0), (LONG, LONG_BYTES)):
        hashes = F.array_distinct(F.transform(F.split("line", " "), lambda word: F.xxhash64(word)))
        part = docs.where(F.octet_length("text") >= least_bytes) if least_bytes else docs
        lines = _lines(part, least_bytes).withColumn("row", F.monotonically_increasing_id()).select(*_LINE, "row", hashes.alias("hashes"))
        lines = lines.where(F.size("hashes") <= FEW_WORDS if fields == SHORT else F.size("hashes") > FEW_WORDS)
        sim = F.lit(0).cast("long")
        for i in range(BITS):
            sim = sim.bitwiseOR(F.when(F.col(f"f{i}") * 2 > F.col("words"), F.lit(1 << i)).otherwise(F.lit(0).cast("long")))
        own = _counted(lines, fields).select(*_LINE, sim.alias("sim"), "words", "held", *_BLOCK)
        out = own if out is None else out.unionByName(own)
    return out.dropDuplicates(_LINE)


def _keys() -> Column:
    """A bucket for each pair of blocks of the SimHash and each group of blocks of words."""
    def block(i: int) -> Column:
        first, width = BLOCKS[i]
        return F.shiftright("sim", first).bitwiseAND(F.lit((1 << width) - 1))
    pairs = combinations(range(len(BLOCKS)), len(BLOCKS) - CLOSE)
    keys = [F.shiftleft(block(i), 16).bitwiseOR(block(j)).bitwiseOR(F.lit(no << 32)) for no, (i, j) in enumerate(pairs)]
    for no, (low, high, n_blocks, least) in enumerate(WORD_KEYS):
        for group in combinations(range(WORD_BLOCKS), n_blocks):
            held = sum((F.shiftright("held", i * HELD).bitwiseAND(F.lit((1 << HELD) - 1)) for i in group), F.lit(0))
            enough = F.col("words").between(low, high) & ((F.col("words") > MANY) | (held >= least))
            keys.append(F.when(enough, F.xxhash64(F.lit(no), *[F.lit(i) for i in group], *[F.col(_BLOCK[i]) for i in group])))
    return F.array_compact(F.array(*keys))


def _bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}.sim").bitwiseXOR(F.col(f"{b}.sim")))


def _alike(a: str, b: str) -> Column:
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (_bits_apart(a, b) <= DISTANCE) & ((F.greatest(n_a, n_b) - F.least(n_a, n_b)) * 100 <= F.greatest(n_a, n_b) * PERCENT_EDITS)


def _edits_by_word(xs: Column, ys: Column) -> Column:
    """Edits that turn one line into the other word by word, enough if not the fewest, in
    time that grows with the number of words. Equal words are passed; where the
    lines part, the first of ``GAPS`` after which two words agree (one at the end of a line) takes the place of
    the other's words, or else one word of the other's. ``xs``, ``ys``: columns, or they are made anew for every word."""
    nx, ny = F.size(xs), F.size(ys)

    def step(at: Column, _: Column) -> Column:
        i, j, n = at["i"], at["j"], at["n"]

        def agree(di: int, dj: int) -> Column:
            return F.get(xs, i + di).eqNullSafe(F.get(ys, j + dj))

        def size(words: Column, first: Column, n_words: int) -> Column:
            return sum((F.coalesce(F.char_length(F.get(words, first + k)) + 1, F.lit(0)) for k in range(n_words)), F.lit(0))

        def past(di: int, dj: int) -> Column:
            more = F.greatest(size(xs, i, di), size(ys, j, dj))
            return F.struct((i + di).alias("i"), (j + dj).alias("j"), (n + more).alias("n"))

        same = F.struct((i + 1).alias("i"), (j + 1).alias("j"), n.alias("n"))
        out = F.when((i >= nx) & (j >= ny), at).when(agree(0, 0), same)
        for di, dj in GAPS:
            out = out.when(agree(di, dj) & agree(di + 1, dj + 1), past(di, dj))
        return out.when(i >= nx, past(0, 1)).when(j >= ny, past(1, 0)).otherwise(past(1, 1))

    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("n"))
    return F.aggregate(F.concat(xs, ys), start, step, lambda at: at["n"])


def _first_known(*edits: Column) -> Column:
    """The first that isn't -1; none is worked out twice, or after it."""
    first, *others = edits
    if not others:
        return first
    return F.get(F.transform(F.array(first), lambda n: F.when(n >= 0, n).otherwise(_first_known(*others))), 0)


def _within(x: Column, y: Column, xs: Column, ys: Column, most: Column) -> Column:
    """Whether two lines (``xs``, ``ys``: their words) are at most so many edits apart. The edits of word
    against word, then those of cut against cut, are enough in all, if not the fewest; only where they don't show it, and
    there is more than one cut, the whole lines are compared, in time that grows with the square of
    their length."""
    def apart(a: Column, b: Column) -> Column:
        a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
        few, edits = (F.call_function("levenshtein", a, b, F.least(most, F.lit(limit))) for limit in (FEW_EDITS, CUT_EDITS))
        longer = F.greatest(F.char_length(a), F.char_length(b))
        return F.when(a == b, F.lit(0)).otherwise(_first_known(few, edits, longer))
    cuts = [F.regexp_extract_all(c, F.lit(CUT), F.lit(0)) for c in (x, y)]
    by_cut = F.aggregate(F.zip_with(*cuts, apart), F.lit(0), lambda n, d: n + d)
    several = F.greatest(F.char_length(x), F.char_length(y)) > 512
    return (_edits_by_word(xs, ys) <= most) | (by_cut <= most) | (several & (F.call_function("levenshtein", x, y, most) >= 0))


def _unpacked(place: str, doc_id: str, line_no: str) -> list[Column]:
    line = F.pmod(F.col(place), F.lit(_LINES).cast("decimal(38,0)")).cast("long")
    owner = F.floor((F.col(place) - line.cast("decimal(38,0)")) / F.lit(_LINES).cast("decimal(38,0)")).cast("decimal(38,0)")
    return [F.when(owner < F.lit(_NO_ID).cast("decimal(38,0)"), owner.cast("long")).alias(doc_id), line.alias(line_no)]


def fuzzy_lines(docs: DataFrame) -> DataFrame:
    """One row per line that has a letter or digit: ``doc_id, line_no`` (from 0),
    ``keep_doc_id, keep_line_no`` (the occurrence that stays) and ``kept``.

    Lines are linked when they share a bucket, their SimHashes differ in at most
    ``DISTANCE`` bits and their normalised texts by at most ``PERCENT_EDITS`` edits per
    hundred code points. The first occurrence by ``doc_id`` (null ids last) and line of a linked group stays.
    Lines without a letter or digit are not listed, so they stay. Null and empty
    texts have no lines. Lines of any length are taken whole. Rows that repeat an id
    and a line's text are listed once. Lines count as equal when a 64-bit hash and
    the length agree. An empty table gives an empty
    result; columns other than ``doc_id`` and ``text`` are not looked at."""
    docs = docs.select("doc_id", "text")
    place = (F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.lit(_NO_ID).cast("decimal(38,0)")) * F.lit(_LINES).cast("decimal(18,0)")
             + F.col("line_no").cast("decimal(18,0)")).cast("decimal(38,0)")
    lines = stored(with_simhash(docs).withColumn("place", place), "line-hashes")
    nodes = stored(lines.groupBy("h", "n").agg(F.min("place").alias("first"), *[F.min(c).alias(c) for c in ("sim", "words", "held", *_BLOCK)])
                   .withColumn("node", F.monotonically_increasing_id()), "lines")
    entries = nodes.select(F.explode(_keys()).alias("key"), "node")
    # nearly every key is one node's alone: those go before anything but the key is moved
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    entries = stored(entries.join(shared, "key"), "bucket-members")
    members = stored(with_partner(entries, nodes.select("node", "n", "sim"), _alike), "members")
    paired = nodes.join(members.select("node").distinct(), "node", "left_semi")
    details = stored(paired.select("node", "n", "sim"), "paired")
    wanted = paired.select("node", F.col("h").alias("w_h"), F.col("n").alias("w_n"), *_unpacked("first", "w_id", "w_line"))
    there = (F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("line_no") == F.col("w_line")) & (F.col("h") == F.col("w_h")) & (F.col("n") == F.col("w_n")))
    some = docs.join(wanted.select(F.col("w_id").alias("s_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("s_id")), "left_semi")
    texts = stored(_lines(some).join(wanted, there).select("node", "line").dropDuplicates(["node"]), "paired-lines")

    def confirm(pairs: DataFrame) -> DataFrame:
        a, b = texts.select(F.col("node").alias("x"), F.col("line").alias("line_a")), texts.select(F.col("node").alias("y"), F.col("line").alias("line_b"))
        both = pairs.join(a, F.col("a.node") == F.col("x")).join(b, F.col("b.node") == F.col("y"))
        # distances cost far more than their bytes: dealt over all tasks, whatever their size
        both = both.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "x", "y")
        most = F.floor(F.greatest("a.n", "b.n") * PERCENT_EDITS / 100).cast("int")
        both = both.select("x", "y", "line_a", "line_b", F.split("line_a", " ").alias("words_a"), F.split("line_b", " ").alias("words_b"), most.alias("most"))
        # as a generator: a filter would be moved below the exchange
        linked = F.array(F.struct(F.col("x").alias("u"), F.col("y").alias("v")))
        return both.select(F.inline(F.when(_within(*map(F.col, ("line_a", "line_b", "words_a", "words_b", "most"))), linked)))

    parts = linked_components(members, details, _alike, _bits_apart, confirm)
    linked = nodes.select("node", "first").join(parts, "node")
    firsts = stored(linked.groupBy(F.col("component").alias("k_component")).agg(F.min("first").alias("keep")), "firsts")
    keepers = linked.join(firsts, F.col("component") == F.col("k_component")).select(F.col("node").alias("k_node"), "keep")
    keepers = stored(keepers, "keepers")
    choice = stored(nodes.join(keepers, F.col("node") == F.col("k_node"), "left").select(
        F.col("h").alias("c_h"), F.col("n").alias("c_n"), F.coalesce("keep", "first").alias("keep")), "line-choices")
    discard(parts, firsts, keepers, nodes, entries, members, details, texts)
    return (lines.join(choice, (F.col("h") == F.col("c_h")) & (F.col("n") == F.col("c_n")))
            .select("doc_id", "line_no", *_unpacked("keep", "keep_doc_id", "keep_line_no"), (F.col("place") == F.col("keep")).alias("kept")))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, each text without the lines that ``fuzzy_lines`` drops."""
    gone = fuzzy_lines(docs).where("not kept").groupBy(F.col("doc_id").alias("g_id")).agg(F.collect_set("line_no").alias("g_lines"))
    left = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains("g_lines", i.cast("long")))
    rows = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")), "left")
    return rows.withColumn("text", F.when(F.col("g_lines").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))).select(*docs.columns)


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf_dir, "documents"))
