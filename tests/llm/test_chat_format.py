import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from chainsight.llm import chat_format, queries
from .messy import empty, messy

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def escaped(text):
    out = text.replace("\\", "\\\\")
    out = re.sub(r"<(?=\||/?s>)", r"<\\", out)
    out = re.sub(r"\|(?=>)", r"|\\", out)
    return re.sub(r"\[(?=/?INST\])", r"[\\", out)


def unescaped(text):
    return re.sub(r"(?s)\\(.)", r"\1", text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\<|>/s[]INTa \n😀", max_size=30))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    """The rule of the module, in Python."""
    out = escaped(text)
    assert unescaped(out) == text
    assert not re.search(r"<\||<\|end\|>|\|>|</?s>|\[/?INST\]", out)


def test_columns_follow_the_rule(spark):
    texts = ["", "\\", "<|end|>\n", "<\\|end|>", "|>\n", "<s></s>[INST] ok [/INST]", "a|>b<|user|>\n", "\\\\<|", "<<||>>", "😀\\n",
             "x" * 100_000 + "<|end|>", "[INST", "<|", "|", "\x00\x1f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    e = chat_format.escape(chat_format.F.col("t"))
    for r in df.select("t", e.alias("e"), chat_format.unescape(e).alias("u")).collect():
        assert r.e == escaped(r.t) and r.u == r.t


def n_tokens(text):
    return len(re.findall(r"[^\W\d_]+|\d|[^\w\s]|_", text)) + chat_format.MARKS


def parse(formatted):
    pieces = formatted.split("<|end|>\n")
    assert pieces.pop() == ""
    out = []
    for p in pieces:
        role, text = re.fullmatch(r"(?s)<\|(.*?)\|>\n(.*)", p).groups()
        out.append((unescaped(role), unescaped(text)))
    return out


def check(rows, windows, budget, history):
    """Every rule of the windows, on ASCII texts."""
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    got = {}
    for w in sorted(windows, key=lambda w: (w.block is not None, w.block or 0, w.window)):
        got.setdefault(w.conv_id, []).append(w)
    assert set(got) == set(want)
    for c, own in got.items():
        turns = [x[1:] for x in sorted(want[c])]
        done = 0
        targets = []
        for w in own:
            held = parse(w.formatted)
            fresh = held[w.repeated:]
            assert len(held) == w.turns and w.tokens == sum(n_tokens(t) for _, t in held)
            assert fresh and fresh == turns[done:done + len(fresh)]
            again = held[:w.repeated]
            if done and turns[0][0] == "system" and again:
                assert again[0] == turns[0]
                again = again[1:]
            assert again == turns[done - len(again):done]
            assert sum(n_tokens(t) for _, t in again) <= history
            assert w.tokens <= budget or len(fresh) == 1
            masked = [w.formatted[s.start:s.end] for s in w.loss]
            assert [unescaped(m) for m in masked] == [t for r, t in fresh if r == "assistant"]
            targets += masked
            done += len(fresh)
        assert done == len(turns)
        if turns[0][0] == "system" and None not in [x[0] for x in want[c]]:
            assert all(parse(w.formatted)[0] == turns[0] for w in own)


def test_windows(spark):
    rng = np.random.default_rng(3)
    words = ["alpha", "b", "12", "x|>", "<|end|>", "\\", "[INST]", "c.", "\n"]
    rows = []
    for c in range(25):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be good " * rng.integers(1, 6)))
        for t in range(1, int(rng.integers(1, 40))):
            rows.append((c, t, ["user", "assistant"][int(rng.integers(2))], " ".join(rng.choice(words, rng.integers(0, 25)))))
    rows += [(90, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1500)]        # several blocks
    rows += [(91, 0, "system", "sys")] + [(91, t, "user", f"t {t}") for t in range(250, 1000, 3)]
    rows += [(92, 0, "user", "word " * 5000), (92, 1, "assistant", "word " * 5000)]               # over the budget
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for budget, history in ((100, 30), (60, 0), (1024, 256)):
        windows = chat_format.format_chats(df, budget, history).collect()
        check(rows, windows, budget, history)
        if budget == 100:
            assert any(w.repeated > 1 for w in windows) and max(w.window for w in windows) > 3
        # no window could have taken the first new turn of the next one in its block
        after = {(w.conv_id, w.block, w.window): w for w in windows}
        for (c, b, k), w in after.items():
            nxt = after.get((c, b, k + 1))
            if nxt is not None:
                system = [t for r, t in parse(w.formatted)[:1] if r == "system"]
                fresh = sum(n_tokens(t) for _, t in parse(w.formatted)[w.repeated:])
                more = n_tokens(parse(nxt.formatted)[nxt.repeated][1])
                assert fresh + more + sum(map(n_tokens, system)) > budget - history


def test_query_digests(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op11_chat_formatting(spark, SF).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        own = sorted(x[1:] for x in rows if x[0] == c)
        targets = [t or "" for _, role, t in own if role == "assistant"]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t or ''}\n" for _, a, t in own).encode()).hexdigest()
        assert r.loss_chars == len("".join(targets))
        assert r.loss_sha256 == hashlib.sha256("".join(targets).encode()).hexdigest()
        assert r.formatted_chars >= sum(len(a) + len(t or "") for _, a, t in own)


def test_no_python_in_the_plan(spark):
    plan = queries.op11_chat_formatting(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_messy_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (1, None, None, None), (1, None, "assistant", ""), (1, 5, "user", "x"),
            (1, 5, "user", "x"), (2, -700, "system", "s"), (2, 3, "assistant", "y" * 200_000), (3, 0, "a|>\n<|end|>\n", "\\")]
    df = spark.createDataFrame(rows, SCHEMA)
    windows = chat_format.format_chats(df).collect()
    assert sum(w.turns - w.repeated for w in windows) == len(rows)
    check([r for r in rows if r[0] in (2, 3)], [w for w in windows if w.conv_id in (2, 3)], 1024, 256)
    docs = messy(spark).selectExpr("*", "doc_id AS conv_id", "0 AS turn", "'user' AS role", "'x' AS conv", "'y' AS block")
    got = chat_format.format_chats(docs, text_col="text").collect()
    assert sum(w.turns - w.repeated for w in got) == docs.count()
    none = empty(spark).selectExpr("doc_id AS conv_id", "doc_id AS turn", "text AS role", "text")
    assert chat_format.format_chats(none).count() == 0
