from marketpulse.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part int, size int, block int, perspective string, s_conv int, opening string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 6) for r in rows], SCHEMA)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", r[3] or ""))
        for seat in {r[2] for r in turns} - {None, "system"}:
            text, spans = "", []
            for _, _, role, said in turns:
                text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == seat else f"<|user name={role or 'unknown'}|>\n"
                if role == seat:
                    spans.append((len(text), len(text) + len(said or "") + len("<|end|>")))
                text += f"{said or ''}<|end|>\n"
            out[conv, seat] = text, spans
    return out


ROWS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi 😀"), (1, 2, "assistant", "hello\nyou"), (1, 3, "user", None), (1, 3, "guest", "é"),
        (2, 0, "user", "alone"), (3, 0, "system", "nobody"), (4, None, None, "who"), (4, 5, "a", ""), (4, 5, "a", ""), (None, 1, "user", "lost"), (None, None, None, None),
        (5, 1, "x", "long " * 30_000), (5, 700, "y", "after"), (5, -3, "x", "before")]


def test_every_seat(spark):
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.dialogues(frame(spark, ROWS)).collect()}
    want = expected(ROWS)
    assert {(c, p) for c, p, _ in got} == set(want)
    for (conv, seat), (text, spans) in want.items():
        parts = [got[k] for k in sorted((k for k in got if k[:2] == (conv, seat)), key=lambda k: k[2])]
        assert "".join(p.text for p in parts) == text
        learned = [p.text[int(a):int(b)] for p in parts for a, b in (s.split(":") for s in p.spans.split(",") if s)]
        assert learned == [text[a:b] for a, b in spans]
        assert sum(p.n_learned for p in parts) == sum(b - a for a, b in spans)
    assert len([k for k in got if k[0] == 5]) == 4  # a very long turn ends its part


def test_long_conversation_over_blocks_and_parts(spark):
    rows = [(1, i, "ab"[i % 2], f"turn {i} " * 20) for i in range(2000)]
    got = sorted(chat.dialogues(frame(spark, rows)).where("perspective = 'a'").collect(), key=lambda r: r.part)
    assert len(got) > 3 and "".join(r.text for r in got) == expected(rows)[1, "a"][0]


def test_empty(spark):
    assert chat.dialogues(spark.createDataFrame([], SCHEMA)).count() == 0
