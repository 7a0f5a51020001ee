import hashlib

from conftest_llm import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from cobble.llm import chat as C
from cobble.llm.queries import ODD_CHAT, op4_chat


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = []
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out.append((conv, len(own), sha(turns), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, sf):
    rows = rows_of(spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    got = rows_of(op4_chat(spark, sf))
    assert sorted((r[:5] for r in got), key=str) == brute(rows + ODD_CHAT)
    assert all(r[5] > 0 for r in got)


ODD = [
    (1, 0, "user", None),
    (1, None, "assistant", "before"),
    (1, 0, "user", None),
    (1, 1, None, "x"),
    (1, 2, "assistant", ""),
    (2, 0, "assistant", "a\\b\\\\<s>[/INST]</s>[ROLE]\\"),
    (2, 1, "[/ROLE]x\n", "[\\INST] <\\s> 日本😀"),
    (None, 1, "user", "no id"),
    (None, 2, "assistant", "none"),
    (3, 0, "assistant", "long " * 50_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9) for r in rows], "conv_id bigint, turn int, role string, text string, piece int")


def test_odd_rows(spark):
    assert sorted((r[:5] for r in rows_of(C.chat_output(frame(spark, ODD)))), key=str) == brute(ODD)


def test_long_conversation_over_many_batches(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(5000)]
    rows += [(i, 0, "user", "hi") for i in range(8, 40)]
    pieces = C.format_chats(frame(spark, rows))
    assert pieces.filter("conv_id = 7").count() > 4
    assert sorted((r[:5] for r in rows_of(C.chat_output(frame(spark, rows)))), key=str) == brute(rows)


def test_mask_lies_on_assistant_texts(spark):
    for p in C.format_chats(frame(spark, ODD)).collect():
        raw = p.formatted.encode()
        for a, b in zip(p.loss_starts, p.loss_ends):
            assert raw[:a].endswith(b"assistant[/ROLE] ") and raw[b : b + 4] == b"</s>"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*C.CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "a", " "]), max_size=12).map("".join))
def test_escape_is_reversible_and_complete(text):
    import pyarrow as pa

    own = C.escape(pa.array([text]))[0].as_py()
    assert C.unescape(own) == text
    assert not any(c in own for c in C.CONTROLS)


def test_empty(spark):
    assert C.chat_output(frame(spark, [])).count() == 0
