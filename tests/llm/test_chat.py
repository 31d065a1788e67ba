"""Chat formatting: reversible templates, loss spans and digests read back."""

import hashlib
import random

import numpy as np
import pytest

from oracle import compare, duck
from parcelflow.llm import chat, queries

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"
SPAN = [c.decode() for c in chat.CONTROLS] + ["\\", "<", ">", "/", "[", "]", "<<", "é", "ok", "\n", "INST", "s>"]


def fuzz(rnd, n=12):
    return "".join(rnd.choice(SPAN) for _ in range(rnd.randrange(n)))


def plain(rows):
    """Digests from the turns themselves; rows are (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        whole = "".join((a + chat.escape((r[3] or "").encode()) + b).decode() for r in mine for a, b in [chat.marks((r[2] or "").encode())])
        out.append((conv, len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
    return sorted(out, key=str)


def test_query_equals_plain_digests(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert sorted(map(tuple, queries.op3_chat(spark, SF).collect()), key=str) == plain(rows)


def test_query_equals_sql(spark):
    assert compare(queries.op3_chat(spark, SF), duck(SF), queries.ORACLES["op3_chat"]) == []


def test_texts_and_roles_come_back():
    rnd = random.Random(1)
    for _ in range(2000):
        turns = [(rnd.choice(["system", "user", "assistant", "", "tool", fuzz(rnd)]).encode(), fuzz(rnd).encode()) for _ in range(rnd.randrange(5))]
        data = b"".join(t for _, t in turns)
        offsets = np.cumsum([0] + [len(t) for _, t in turns])
        out, ends, starts, lengths = chat.assemble(np.frombuffer(data, np.uint8), offsets, [r for r, _ in turns])
        made = out.tobytes()
        assert made == b"".join(a + chat.escape(t) + b for r, t in turns for a, b in [chat.marks(r)])
        assert chat.parse(made) == turns
        for (_, text), a, n in zip(turns, starts, lengths):
            assert chat.unescape(made[a : a + n]) == text


def test_control_strings_across_rows_are_left_alone():
    data = np.frombuffer(b"a</s>b<s>", np.uint8)
    assert chat.escape_places(data, np.array([0, 3, 9])).tolist() == [6]
    assert chat.escape_places(data, np.array([0, 9])).tolist() == [1, 6]


def test_cut_text_is_refused():
    with pytest.raises(ValueError):
        chat.parse(b"[INST]never closed")
    with pytest.raises(ValueError):
        chat.parse(b"[INST]a</s>")


def test_long_conversations_are_spread_and_joined_again(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_BYTES", 200)
    rnd = random.Random(2)
    rows = [(1, t, rnd.choice(["user", "assistant"]), fuzz(rnd, 30)) for t in range(700)] + [(2, 0, "system", "x" * 100_000), (2, 1, "assistant", "y" * 50_000)]
    segments = chat.format_turns(spark.createDataFrame(rows, TURNS).repartition(3))
    assert segments.filter("conv_id = 1").count() > 8
    assert sorted(map(tuple, chat.digests(segments).collect()), key=str) == plain(rows)


def test_edge_rows(spark):
    rows = [(1, None, "user", None), (1, 0, None, "a"), (1, 0, None, "a"), (None, 1, "assistant", "lost"), (None, 2, "assistant", None), (3, 5, "weird<s>", "<</TURN>>"), (4, 1, "assistant", "")]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS segment", "'x' AS tie")
    assert sorted(map(tuple, chat.digests(chat.format_turns(frame)).collect()), key=str) == plain(rows)
    assert chat.digests(chat.format_turns(spark.createDataFrame([], TURNS))).collect() == []
