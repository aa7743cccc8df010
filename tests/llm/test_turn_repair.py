import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from chainsight.llm import queries, turn_repair
from .messy import empty, messy

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """All columns for one conversation's rows (turn, role, text), by search over all edits."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for t, role, text in rows:
        if not text.strip(SPACE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif text.rstrip(SPACE)[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    inits = [r[1][:1] for r in rows]
    grammar = re.compile(r"(s?(ua)+)?")

    @lru_cache(None)
    def best(i, out):
        """Least (cost, audit) from row i on, after the output's last two initials."""
        if grammar.fullmatch(out) and i == len(rows):
            yet = [(0, "")]
        else:
            yet = []
        def go(nxt):  # what matters of the output so far: a prefix of the grammar
            return nxt if re.fullmatch(r"s?(ua)*u?", nxt) else None
        def short(x):
            return x if len(x) < 4 else x[:1] * (x[0] == "s") + ("ua" if x[-1] == "a" else "uau")
        if i < len(rows):
            f = faults[i]
            c, a = best(i + 1, out)
            yet.append((c + 2, "D" + a))
            if f not in ("blank", "duplicate"):
                extra = 5 * (f == "truncated")
                if inits[i] and go(out + inits[i]) is not None:
                    c, a = best(i + 1, short(out + inits[i]))
                    yet.append((c + extra, "K" + a))
                for x in "ua":
                    if go(out + x) is not None:
                        c, a = best(i + 1, short(out + x))
                        yet.append((c + 1 + extra, "R" + a))
        # inserts: at most two in a row can help
        for x in ("u", "a", "ua", "au"):
            if i == len(rows):
                if grammar.fullmatch(out + x):
                    yet.append((5 * len(x), "I" * len(x)))
            elif go(out + x) is not None:
                c, a = after_insert(i, short(out + x))
                yet.append((c + 5 * len(x), "I" * len(x) + a))
        return min(yet) if yet else (10**9, "")

    @lru_cache(None)
    def after_insert(i, out):
        yet = []
        f = faults[i]
        c, a = best(i + 1, out)
        yet.append((c + 2, "D" + a))
        if f not in ("blank", "duplicate"):
            extra = 5 * (f == "truncated")
            if inits[i] and re.fullmatch(r"s?(ua)*u?", out + inits[i]):
                c, a = best(i + 1, out + inits[i])
                yet.append((c + extra, "K" + a))
            for x in "ua":
                if re.fullmatch(r"s?(ua)*u?", out + x):
                    c, a = best(i + 1, out + x)
                    yet.append((c + 1 + extra, "R" + a))
        return min(yet)

    cost, audit = best(0, "")
    lines, i, out = [], 0, ""
    for letter in audit:
        want = "a" if out.endswith("u") else "u"
        if letter == "I":
            lines.append({"u": "user:", "a": "assistant:"}[want])
            out += want
            continue
        if letter == "K":
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
            out += inits[i]
        elif letter == "R":
            lines.append({"u": "user:", "a": "assistant:"}[want] + rows[i][2])
            out += want
        i += 1
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(inits, inits[1:]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            "\n".join(lines))


def test_plain_version_on_written_cases():
    def audit(*roles, text="ok."):
        return plain([(i, r, f"{i} {text}") for i, r in enumerate(roles)])[5:7]
    assert audit("user", "assistant") == (0, "KK")
    assert audit("system", "user", "assistant", "user", "assistant") == (0, "KKKKK")
    assert audit("user", "user") == (1, "KR")
    assert audit("assistant",) == (2, "D")
    assert audit("system",) == (2, "D")
    assert audit("user", "user", "assistant") == (2, "DKK")
    assert audit() == (0, "")


def collected(repaired):
    turns = {}
    for r in sorted(repaired.turns.collect(), key=lambda r: (r.part, r.seq, r.place)):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                        "\n".join(turns.get(r.conv_id, []))) for r in repaired.reports.collect()}


def random_rows(seed, conversations, most):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", None, "umpire", ""]
    texts = ["Yes.", "no", "Why?", "", " \t", None, "Go! ", "wait\n", "é.", "x" * 50 + "."]
    rows = []
    for c in range(conversations):
        for t in range(int(rng.integers(0, most))):
            turn = None if rng.random() < 0.05 else int(t * rng.integers(1, 3))
            role = roles[int(rng.choice(7, p=[0.4, 0.35, 0.08, 0.05, 0.04, 0.04, 0.04]))]
            text = texts[int(rng.integers(len(texts)))] if rng.random() < 0.4 else f"text {t}{'.' * int(rng.integers(2))}"
            rows += [(c, turn, role, text)] * int(rng.choice([1, 1, 1, 1, 2, 3]))
    return rows


@pytest.mark.parametrize("seed,chunk,most", [(0, 4096, 14), (1, 2, 14), (2, 1, 9), (3, 5, 60)])
def test_equals_search_over_all_edits(spark, seed, chunk, most):
    rows = random_rows(seed, 60 if most < 20 else 25, most)
    want = {}
    for c, *r in rows:
        want.setdefault(c, []).append(tuple(r))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = collected(turn_repair.repair(df, chunk=chunk))
    assert got == {c: plain(r) for c, r in want.items()}


def test_long_conversation_in_chunks_equals_one_chunk(spark):
    """Many passes: stretches of blank rows hand the vector on unchanged."""
    rng = np.random.default_rng(9)
    rows = [(1, t, ["user", "assistant", "system"][int(rng.choice(3, p=[.5, .45, .05]))],
             "" if 300 < t < 420 else f"say {t}" + "." * int(rng.integers(2))) for t in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = collected(turn_repair.repair(df))
    assert collected(turn_repair.repair(df.repartition(4), chunk=50)) == whole
    assert whole[1][6].count("D") >= 119


def test_query(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        own = want.setdefault(r.conv_id, [])
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", r.text) if kind == 2 else r.text
        own += [(r.turn, "user" if kind == 4 else r.role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_turn_repair(spark, SF).collect()}
    assert set(got) == set(want)
    for c, rows in want.items():
        *first, text = plain(rows)
        assert got[c] == (*first, hashlib.sha256(text.encode()).hexdigest())


def test_messy_rows(spark):
    rows = [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (5, None, None, None), (6, 0, "user", "word " * 50_000 + "end."),
            (6, 1, "assistant", "ok.")]
    got = collected(turn_repair.repair(spark.createDataFrame(rows, SCHEMA)))
    assert got[None][5:] == (0, "KK", "user:a.\nassistant:b.") and got[5][1] == 1 and got[6][6] == "KK"
    docs = messy(spark).selectExpr("*", "0 AS turn", "'user' AS role", "'x' AS ck", "'y' AS conv")
    reports = turn_repair.repair(docs, id_col="doc_id").reports
    assert reports.count() == docs.select("doc_id").distinct().count()
    none = empty(spark).selectExpr("doc_id AS conv_id", "doc_id AS turn", "text AS role", "text")
    repaired = turn_repair.repair(none)
    assert repaired.reports.count() == 0 and repaired.turns.count() == 0
