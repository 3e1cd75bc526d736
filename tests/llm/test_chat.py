from pyspark.sql import functions as F

from topup_analytics.llm.chat import escape, format_chats, learned_text, read_chats, unescape

MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>", "<<NEXT>>"]
NASTY = [
    *MARKS,
    *[m[0] + "\\" + m[1:] for m in MARKS],
    *[m[0] + "\\\\" + m[1:] for m in MARKS],
    "<" + "</s>", "[[INST]INST]", "<s" + ">", "<<<SYS>>>", "\\", "\\<s>", "<\\", "</s>[INST] ok [/INST]", "", "a\nb\r\n$1 ${2} \\1", "<", "[",
    "<s><s></s>\\</s>", "é😀</s>漢",
]


def test_escaping_is_reversible(spark):
    texts = NASTY + [a + b for a in NASTY for b in NASTY[::5]]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u")).collect()
    for r in rows:
        assert r["u"] == r["t"]
        assert not any(m in r["e"] for m in MARKS)
    assert len({r["e"] for r in rows}) == len({r["t"] for r in rows})


def conversations():
    roles = ["user", "assistant", "system", "tool", None, "", "<<TEXT>>", "assistant", "assistant", "user", "user", "[INST]"]
    rows = [(c, i, roles[(i * 7 + c) % len(roles)], NASTY[(i + 5 * c) % len(NASTY)]) for c in range(25) for i in range(c + 1)]
    rows += [(30, 1, "assistant", None), (30, 0, None, None), (31, 0, "user", "only"), (None, 0, "assistant", "no id")]
    rows += [(32, 0, "user", "same"), (32, 0, "user", "same"), (32, None, "assistant", "first"), (33, 5, "assistant", "x" * 200_000)]
    rows += [(34, i, "assistant", f"{i} ") for i in range(3000)]
    return rows


def test_conversations_read_back(spark):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, one int")
    chats = format_chats(frame.repartition(4))
    got = chats.select("*", read_chats("formatted").alias("turns"), learned_text("formatted", "loss_spans").alias("learned"))
    found = {r["conv_id"]: r for r in got.collect()}
    assert len(found) == len({r[0] for r in rows})
    for conv, r in found.items():
        own = sorted((t for t in rows if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [tuple(t) for t in r["turns"]] == [(t[2] or "", t[3] or "") for t in own]
        assert r["learned"] == "".join(t[3] or "" for t in own if t[2] == "assistant")
        # Marks stand at the ends of blocks only: adjacent turns of a role share a block.
        blocks = 1 + sum((a[2] or "") != (b[2] or "") for a, b in zip(own, own[1:]))
        ends = sum(r["formatted"].count(m) for m in ("<</SYS>>", "[/INST]", "</s>", "<</ROLE>>"))
        assert ends == blocks


def test_very_many_turns(spark):
    """200,000 turns of one conversation, and a conversation of one very long block."""
    n = 200_000
    turns = spark.range(n).selectExpr(
        "1L conv_id", "id turn", "if(id % 3 = 1, 'assistant', 'user') role", "concat('é', id, if(id % 1000 = 1, '</s>', '')) text"
    )
    block = spark.range(30_000).selectExpr("2L", "id", "'assistant'", "concat(id, ' ')")
    chats = format_chats(turns.union(block))
    got = chats.select("conv_id", read_chats("formatted").alias("turns"), learned_text("formatted", "loss_spans").alias("learned"))
    found = {r["conv_id"]: r for r in got.selectExpr("conv_id", "size(turns) n", "get(turns, 199998).text last", "learned").collect()}
    say = lambda i: f"é{i}" + "</s>" * (i % 1000 == 1)
    assert found[1]["n"] == n and found[1]["last"] == say(n - 2)
    assert found[1]["learned"] == "".join(say(i) for i in range(1, n, 3))
    assert found[2]["learned"] == "".join(f"{i} " for i in range(30_000))


def test_no_conversations(spark):
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
