"""Rows that every operator must bear, and helpers of these tests."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, score double, key string, node long, row string, doc string, state int, bucket int, place int, h int, n int, line string, "
          "target int, label string, features string, normal string, recipe int, edited int, w_id int, u int, v int, p_source string, nth int, s_doc int, nn_id int")
N_EXTRA = SCHEMA.count(",") - 4
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000)) + "."


def frame(spark, rows):
    """Documents (doc_id, text, source) with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, s, None, *[None] * N_EXTRA) for i, t, s in rows], SCHEMA)


def odd_rows():
    rnd = random.Random(5)

    def prose(n, k=400):
        return " ".join(f"w{rnd.randrange(k)}" for _ in range(n)) + "."
    base = prose(200)
    words = base.split()
    near = " ".join(words[:100] + ["other"] + words[101:])
    far = " ".join(words[:60] + prose(140).split())
    return [
        (None, None, None), (None, "only text", "a"), (None, base, "b"),
        (1, "", "a"), (2, " \t\n\x0b\x0c\r ", "b"), (3, None, None), (4, "one", "a"), (5, "ONE", "a"), (6, "one", None),
        (7, base, "b"), (8, base.replace(" ", "\n"), "b"), (9, base, "c"), (9, base, "c"), (10, near, "c"), (11, far, ""), (12, LONG, "a"), (13, LONG + " end", "a"),
        (14, "Ünïcödé 😀 　  İstanbul ß", "é"), (15, "a b", "a"), (16, "b a", "a"), (17, "!!! ***\n\n???", "a"), (18, "x" * 50_000, "a"),
        (19, prose(900), "a"), (20, prose(30), "a"), (-5, prose(50), "zz"), (2 ** 62, prose(40), "b"),
        (21, "<|endoftext|> it's <|end|>", "b"),
    ]


def collected(df, *columns):
    return [tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()]
