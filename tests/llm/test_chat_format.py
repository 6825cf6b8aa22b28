from __future__ import annotations

import hashlib
import random

import pytest

from thermocline.llm import chat_format as C

DDL = "conv_id long, turn long, role string, text string, pos string, seg string, tokens string, start string, loss string, conv string"
MARKS = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<\\s>", "[\\/INST]", "<", "</s", " [/INST] ", "\\\\", "a", "é", "\n", " ", "😀"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "s", "t", "s", "l", "c") for r in rows], DDL)


def conversations():
    rng = random.Random(11)
    odd = lambda: "".join(rng.choice(MARKS) for _ in range(rng.randrange(8)))
    plain = lambda: " ".join(rng.choice(["word", "number12", "x."]) for _ in range(rng.randrange(40)))
    rows = []
    for c in range(40):
        for t in range(rng.randrange(1, 14)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "assistant", "system", None, odd()])
            rows.append((c, t, role, rng.choice([odd(), plain(), plain(), None])))
    rows += [(50, 0, "system", "s " * 2000), (50, 1, "user", "u"), (50, 2, "assistant", "a"), (51, 0, "assistant", "long " * 30_000), (51, 1, "assistant", "b")]
    rows += [(52, 0, "system", "alone"), (53, None, "user", "n"), (53, None, "assistant", "m"), (None, 0, "user", "q"), (None, 1, "assistant", "r")]
    return rows + [(54, t, "user", "same") for t in (1, 1, 2)] + [(54, 2, "user", "same")]


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: r[:3])
        turns = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        loss = "".join(x for *_, r, x in own if r == "assistant")
        out.append((conv, len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"budget": 90, "history": 20}, {"budget": 90, "history": 30, "segment": 3}, {"budget": 10, "history": 0}])
def test_read_back(spark, options):
    rows = conversations()
    got = C.conversation_digests(C.chat_windows(frame(spark, rows), **options))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == expected(rows)


def test_windows(spark):
    rows, budget, history = conversations(), 90, 30
    windows = C.chat_windows(frame(spark, rows), budget, history).collect()
    repeats = 0
    by_conv: dict = {}
    for w in sorted(windows, key=lambda w: (w.seg, w.start)):
        turns = w.formatted.split(C.CLOSE)[:-1]
        assert len(turns) == w.n_turns and all(t.startswith(C.OPEN) and t.count(C.OPEN) == 1 and t.count(C.MIDDLE) >= 1 for t in turns)
        own = w.n_turns - w.n_repeated - (w.n_repeated == 0 and w.n_turns > 1 and turns[0].startswith(C.OPEN + "system"))
        assert w.tokens <= budget or own == 1
        earlier = by_conv.setdefault(w.conv_id, [])
        again, new = turns[: w.n_repeated], turns[w.n_repeated :]
        if again and again[0].startswith(C.OPEN + "system") and again[0] == earlier[0]:
            again = again[1:]
        assert again == earlier[len(earlier) - len(again) :]  # the last turns of what came before
        if earlier and earlier[0].startswith(C.OPEN + "system") and w.conv_id is not None and w.conv_id % 3 == 0 and w.conv_id < 40 and len(earlier[0]) < 100:
            assert turns[0] == earlier[0]
        targets = [w.formatted[s.start : s.start + s.length] for s in w.loss]
        assert targets == [t.split(C.MIDDLE, 1)[1] for t in new if t.startswith(f"{C.OPEN}assistant{C.MIDDLE}")]
        repeats += len(again)
        earlier += new
    assert repeats > 20


def test_no_python_workers(spark):
    plan = C.conversation_digests(C.chat_windows(frame(spark, conversations())))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_own_token_count(spark):
    from pyspark.sql import functions as F

    df = frame(spark, [(1, t, "user", "x") for t in range(6)])
    windows = C.chat_windows(df, 3 * (C.MARKS + 5), 0, tokens=F.lit(5)).collect()
    assert sorted(w.n_turns for w in windows) == [3, 3]


def test_empty_table(spark):
    assert C.chat_windows(frame(spark, []).limit(0)).collect() == []
