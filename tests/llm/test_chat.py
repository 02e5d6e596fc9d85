import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from tidemart.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(df, rows):
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    convs = {}
    null_first = lambda v: (v is not None, v or 0) if not isinstance(v, str) else (True, v)
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        turns.sort(key=lambda t: ((t[0] is not None, t[0] or 0), (t[1] is not None, t[1] or ""), (t[2] is not None, t[2] or "")))
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns))
        loss = "".join(text or "" for _, role, text in turns if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_test_table(stored):
    turns = stored("conversations", "/root/testdata/sf0.01")
    check(turns, [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (2, None, None, "x"), (2, 0, "a\nb%0A%", "y\n<|end|>\n<|turn|>"),
        (None, 0, "assistant", "é</s>[INST]"), (3, 0, "assistant", "z" * 3_000_000), (3, 1, "assistant", "<\\\\|end|>"),
        (4, 0, "user", "q"), (4, 0, "user", "q"), (5, 9, "assistant", "<|end|><\\|end|>\\"), (5, 10, "system", "[/INST] <s>"),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as formatted", "2 as learned")
    check(df, rows)
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_control_strings_are_only_the_templates(spark):
    rows = [(1, i, "user", "</s>[INST] ok [/INST]<|turn|>") for i in range(5)]
    (r,) = chat.format_chats(spark.createDataFrame(rows, TURNS)).collect()
    assert r.formatted.count(chat.BEGIN) == 5 and r.formatted.count(chat.END) == 5
    assert "</s>" not in r.formatted and "[INST]" not in r.formatted


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"<|[\\/>]sx\n%0A", "INST]", "end|>", "turn|>"]), max_size=20))
def test_escapes_are_reversible(parts):
    text = "".join(parts)
    (escaped,) = chat.escape(pa.array([text])).to_pylist()
    assert chat.unescape(escaped) == text
    assert chat.BEGIN not in escaped and "<|" not in escaped and "</s>" not in escaped
    (role,) = chat.escape_role(pa.array([text])).to_pylist()
    assert chat.unescape_role(role) == text and "\n" not in role
