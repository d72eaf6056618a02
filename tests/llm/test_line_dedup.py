import random

from marketpulse.llm.line_dedup import DISTANCE, PERCENT_EDITS, _lines, fuzzy_lines, with_simhash, without_repeated_lines
from tests.llm.odd import LONG, SCHEMA, frame, odd_rows
from tests.llm.test_linking import roots


def rows_with_near_lines():
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(900)}" for _ in range(150)]
    out = []
    for i in range(36):
        words = list(base)
        for _ in range(i % 3):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10 ** 6)}"
        out.append((500 + i, f"Own line {i} of many\n{' '.join(words)}\n!!!\nShared LINE, of all", "a"))
    return out


def edits(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
        if min(now) > most:
            break
    return min(before[-1], most + 1)


def test_groups_equal_brute_force(spark):
    rows = [r for r in odd_rows() if r[0] not in (12, 13)] + rows_with_near_lines()
    docs = frame(spark, rows)
    lines = {(r.doc_id, r.line_no): (r.line, r.h, r.n) for r in _lines(docs).collect()}
    sims = {(r.h, r.n): r.sim for r in with_simhash(docs).collect()}
    first = {}
    for (i, no), (line, h, n) in lines.items():
        place = (i is None, i or 0, no)
        if (h, n) not in first or place < first[h, n][0]:
            first[h, n] = (place, line, i)
    nodes = sorted(first)
    near = [(a, b) for a in range(len(nodes)) for b in range(a + 1, len(nodes))
            if ((sims[nodes[a]] ^ sims[nodes[b]]) & (2 ** 64 - 1)).bit_count() <= DISTANCE]
    links = [(a, b) for a, b in near if first[nodes[a]][1] == first[nodes[b]][1] or edits(
        first[nodes[a]][1], first[nodes[b]][1], most := max(nodes[a][1], nodes[b][1]) * PERCENT_EDITS // 100) <= most]
    assert links
    root = roots(links)
    keep = {}
    for a, node in enumerate(nodes):
        r = root.get(a, a)
        keep[r] = min(keep.get(r, first[node][0]), first[node][0])
    want = {}
    for place, (_, h, n) in lines.items():
        k = keep[root.get(nodes.index((h, n)), nodes.index((h, n)))]
        want[place] = (None if k[0] else k[1], k[2])
    got = fuzzy_lines(docs).collect()
    assert {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in got} == want
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.keep_doc_id, r.keep_line_no)) for r in got)


def test_texts_without_repeated_lines(spark):
    docs = frame(spark, [(1, "Same line here\n***\nmore", "a"), (2, "***\nsame line, HERE\nnew", "b"), (3, None, "c"), (4, "", "c")])
    out = without_repeated_lines(docs)
    assert out.schema == docs.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Same line here\n***\nmore", 2: "***\nnew", 3: None, 4: ""}


def test_very_long_lines_and_empty(spark):
    got = fuzzy_lines(frame(spark, [(1, LONG, None), (2, LONG.upper(), None), (3, LONG + " a few words more", None)])).collect()
    assert {r.doc_id: r.keep_doc_id for r in got} == {1: 1, 2: 1, 3: 1}
    assert fuzzy_lines(spark.createDataFrame([], SCHEMA)).count() == 0 and fuzzy_lines(frame(spark, [(1, None, None)])).count() == 0


def test_planted_changes_are_linked(spark):
    """Against edit similarity alone: lines with one and two words replaced, by length."""
    rnd = random.Random(4)

    def word():
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9)))
    rows, planted = [], []
    for n_words in (6, 14, 28, 60):
        for changed in (1, 2):
            for _ in range(60):
                words = [word() for _ in range(n_words)]
                other = list(words)
                for at in rnd.sample(range(n_words), changed):
                    other[at] = word()
                a, b = " ".join(words), " ".join(other)
                if a != b and edits(a, b, most := max(len(a), len(b)) * PERCENT_EDITS // 100) <= most:
                    planted.append((n_words, changed, len(rows)))
                    rows += [(len(rows), a, "a"), (len(rows) + 1, b, "a")]
    keep = {r.doc_id: r.keep_doc_id for r in fuzzy_lines(frame(spark, rows)).collect()}
    for n_words, changed, least in ((6, 1, 0.8), (14, 1, 0.9), (28, 1, 1), (60, 1, 1), (14, 2, 0.6), (28, 2, 0.9), (60, 2, 0.95)):
        linked = [keep[i + 1] == i for n, c, i in planted if (n, c) == (n_words, changed)]
        assert len(linked) > 20 and sum(linked) >= least * len(linked), (n_words, changed, sum(linked), len(linked))


def test_text_missing_at_the_start_of_two_cuts(spark):
    rnd = random.Random(6)
    rows = []
    for n in (600, 800, 1000):
        line = " ".join(f"w{rnd.randrange(10 ** 4)}" for _ in range(n // 6))
        rows += [(n, "x" * (n // 8) + " " + line, "a"), (n + 1, line, "a")]
    assert {r.doc_id: r.keep_doc_id for r in fuzzy_lines(frame(spark, rows)).collect()} == {n + i: n for n in (600, 800, 1000) for i in (0, 1)}


def test_counts_of_many_words(spark):
    """Over two million words in one line, or in repeated rows of one."""
    many = spark.range(250_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'the quick brown fox jumps over a lazy dog' AS text")
    docs = many.unionByName(spark.createDataFrame([(1, "the quick brown fox jumps over a lazy dog"), (2, "fox " * 2_200_000), (3, "fox")], "doc_id long, text string"))
    sims = {r.doc_id: r.sim for r in with_simhash(docs).collect()}
    assert sims[None] == sims[1] and sims[2] == sims[3]


def test_repeated_words_make_no_common_bucket(spark):
    """Words that repeat don't cancel: lines of one repeated word share no bucket of words."""
    from pyspark.sql import functions as F

    from marketpulse.llm.line_dedup import CLOSE, _keys
    n_sim = 6 if CLOSE == 2 else 0
    names = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    rows = [(i, " ".join([w] * n), "a") for i, (w, n) in enumerate((w, n) for w in names for n in (1, 2, 20, 21, 4100))]
    rows += [(100 + i, f"{w} {v} " * 12, "a") for i, (w, v) in enumerate(zip(names, names[1:]))]
    found = with_simhash(frame(spark, rows)).withColumn("keys", _keys()).collect()
    assert all(r.words == 1 and len(r.keys) == n_sim for r in found if r.doc_id < 100)  # a key takes two words
    keys = [set(r.keys[n_sim:]) for r in found if r.doc_id >= 100]
    assert all(keys) and all(not (a & b) for i, a in enumerate(keys) for b in keys[i + 1:])


def test_lines_around_the_limit_of_short_counts(spark):
    from marketpulse.llm.line_dedup import FEW_WORDS
    rnd = random.Random(3)
    rows = []
    for n in (FEW_WORDS - 1, FEW_WORDS, FEW_WORDS + 1, 3 * FEW_WORDS):
        words = [f"{rnd.randrange(10 ** 9)}q" for _ in range(n)]
        rows += [(n, " ".join(words), "a"), (10_000 + n, " ".join(words + words[:50]), "a"), (20_000 + n, " ".join(words[1:]), "a")]
    docs = frame(spark, rows + [(7, "a b " * 1500, "a")])
    found = {r.doc_id: r for r in with_simhash(docs).collect()}
    assert len(found) == 13 and found[7].words == 2
    for n in (FEW_WORDS - 1, FEW_WORDS, FEW_WORDS + 1, 3 * FEW_WORDS):
        assert found[n].words == n and found[10_000 + n].sim == found[n].sim
        assert (found[20_000 + n].sim ^ found[n].sim).bit_count() < 8
    keep = {r.doc_id: r.keep_doc_id for r in fuzzy_lines(docs).collect()}
    assert all(keep[20_000 + n] == n for n in (FEW_WORDS - 1, FEW_WORDS, FEW_WORDS + 1, 3 * FEW_WORDS))


def test_edits_by_word_are_enough_and_few(spark):
    """Never fewer than the edits; of words replaced, dropped, added and split, at most what the words hold."""
    from pyspark.sql import functions as F

    from marketpulse.llm.line_dedup import _edits_by_word
    rnd = random.Random(5)

    def word():
        return "".join(rnd.choice("abcdeéŏ語𝄞") for _ in range(rnd.randrange(1, 9)))
    rows = [("a", "a", 0), ("", "", 0), ("a", "b c", None), ("", "b c d", None), ("a b c d", "", None), ("x a b", "a b x", None)]
    rows += [(" ".join(word() for _ in range(rnd.randrange(1, 9))), " ".join(word() for _ in range(rnd.randrange(1, 9))), None) for _ in range(60)]
    for _ in range(80):
        words = [word() for _ in range(rnd.randrange(30, 60))]
        other, most = [], 0
        for k, w in enumerate(words):
            kind, new = rnd.randrange(4) if k % 10 == 4 else -1, f"{word()}{k}"
            other += {0: [new], 1: [], 2: [w, new], 3: [w[:1] + "q", w[1:] + "q"]}.get(kind, [w])
            most += {0: max(len(w), len(new)) + 1, 1: len(w) + 1, 2: len(new) + 1, 3: len(w) + 4}.get(kind, 0)
        rows.append((" ".join(words), " ".join(other), most if len(set(words)) == len(words) else None))
    df = spark.createDataFrame(rows, "x string, y string, most int").withColumn("xs", F.split("x", " ")).withColumn("ys", F.split("y", " "))
    for r in df.withColumn("n", _edits_by_word(F.col("xs"), F.col("ys"))).collect():
        assert r.n >= edits(r.x, r.y, 10 ** 6), r
        assert r.most is None or r.n <= r.most, r


def test_scattered_edits_of_a_very_long_line_cost_no_square(spark):
    """Words added at many places shift every later cut; comparing the whole lines would take minutes."""
    import time

    from pyspark.sql import functions as F

    from marketpulse.llm.line_dedup import _within
    rnd = random.Random(7)
    line = [f"{rnd.randrange(10 ** 7)}w" for _ in range(60_000)]
    other = [w for k, word in enumerate(line) for w in ((word, "added") if k % 8 == 0 else (word,))]
    most = len(" ".join(other)) * PERCENT_EDITS // 100
    rows = spark.createDataFrame([(" ".join(line), " ".join(other), line, other, most)], "x string, y string, xs array<string>, ys array<string>, most int")
    began = time.time()
    assert rows.select(_within(*map(F.col, rows.columns)).alias("near")).first().near and time.time() - began < 60


def test_shortest_lines_of_many_words(spark):
    from marketpulse.llm.line_dedup import FEW_WORDS, LONG_BYTES
    one = [chr(c) for c in (*range(48, 58), *range(97, 123))]
    two = [a + b for a in one for b in one][:FEW_WORDS + 1 - 36]
    dotted = [w[:-1] + "\u0130" for w in two if w[-1] == "i"]  # in lower case i and a mark, which parts words
    shortest = " ".join(one + two)
    joined = "".join(dotted) + " " + " ".join(one + [w for w in two if w[-1] != "i"])
    rows = [(1, shortest, "a"), (2, joined, "a"), (3, " ".join((one + two)[1:]), "a")]
    assert len(shortest.encode()) >= LONG_BYTES and len(joined.encode()) >= LONG_BYTES
    found = {r.doc_id: r.words for r in with_simhash(frame(spark, rows)).collect()}
    assert found == {1: FEW_WORDS + 1, 2: FEW_WORDS + 1, 3: FEW_WORDS}
