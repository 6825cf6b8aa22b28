from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from thermocline.llm import conversation_repair as R

DDL = "conv_id long, turn long, role string, text string, pos string, letter string, seg string, row string, conv string, cost string"
WHITE = " \t\n\x0b\f\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "l", "s", "r", "c", "x") for r in rows], DDL)


def cheapest(rows):
    """(cost, letters, roles) by trying all edits: rows are (initial, fault)."""
    best = {"": (0, "", "")}  # by roles so far, least (cost, letters); at most one insertion pair fits between rows

    def insert(held):
        for _ in range(2):
            held = dict(held)
            for roles, (cost, letters, _) in list(held.items()):
                for r in "ua":
                    way = (cost + 5, letters + "I", roles + r)
                    if roles + r not in held or way < held[roles + r]:
                        held[roles + r] = way
        return {k: v for k, v in held.items() if re.fullmatch("s?(ua)*u?", k)}

    for initial, fault in rows:
        held, best = insert(best), {}
        for roles, (cost, letters, _) in held.items():
            ways = [(cost + 2, letters + "D", roles)]
            if fault in (R.GOOD, R.TRUNCATED):
                more = 5 if fault == R.TRUNCATED else 0
                ways.append((cost + more, letters + "K", roles + initial))
                ways += [(cost + 1 + more, letters + "R", roles + r) for r in "ua"]
            for way in ways:
                if re.fullmatch("s?(ua)*u?", way[2]) and (way[2] not in best or way < best[way[2]]):
                    best[way[2]] = way
    return min(v for k, v in insert(best).items() if re.fullmatch("(s?(ua)+)?", k))


def run(rows, **options):
    out = list(R.repair(rows, **options))
    return out[-1][1], "".join(x[0] for x in out)


def test_search_equals_all_edits():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice("suuaa?"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(7))]
        cost, letters, _ = cheapest(rows)
        assert run(rows) == (cost, letters), rows


def test_memory_is_bounded_by_what_is_undecided():
    search = R.Survivors({R.START: 0})
    most = 0
    for k in range(20_000):
        search.step("ua"[k % 2], R.GOOD)
        most = max(most, search.nodes())
    assert most < 40


def brute_force(conversations, damaged):
    """The report by its definition; rows of one turn in order of role only where these differ."""
    out = []
    for conv in {r[0] for r in conversations}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in damaged if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(WHITE)
            faults.append(R.BLANK if not bare else R.DUPLICATE if (role, text) in seen else R.GOOD if bare[-1] in ".!?" else R.TRUNCATED)
            seen.add((role, text))
        initials = [(r or " ")[0] for _, r, _ in own]
        cost, letters, roles = cheapest([(i if i in "sua" else "?", f) for i, f in zip(initials, faults, strict=True)])
        lines, rows, n = [], iter(own), 0
        for letter in letters:
            role, text = (None, "") if letter == "I" else next(rows)[1:]
            if letter != "D":
                lines.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[roles[n]]}:{text}")
                n += 1
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = [faults.count(k) for k in (R.BLANK, R.DUPLICATE, R.TRUNCATED)]
        out.append((conv, gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(conversations, damaged, **options):
    return sorted((tuple(r) for r in R.repair_report(conversations, damaged, **options).select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "Why?", "", " \n", "cut off", "ok. ", "Yes.", None, "é.\x0b", "long " * 5000 + "."]
    out = [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]), rng.choice(texts)) for c in range(60) for t in range(rng.randrange(7))]
    out += [(70, None, "user", "Hi."), (70, 3, "assistant", "Ho."), (70, None, "assistant", "Ha."), (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho.")]
    return out + [(71, 5, "user", "a."), (71, 5, "user", "a."), (72, -3, "user", "x"), (72, 9, "assistant", "y."), (73, None, "user", None)]


def test_report_equals_brute_force(spark, conversations):
    df = frame(spark, conversations)
    expected = brute_force(conversations, conversations)
    assert report(df, df) == expected
    assert report(df, df, segment=2) == expected  # every conversation of more than two rows in segments


def test_long_conversation_in_segments(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", f"B{t}.", f"C{t}", "", f"D{t}!"])) for t in range(300)]
    df = frame(spark, rows)
    assert report(df, df, segment=7) == brute_force(rows, rows) == report(df, df)


def test_damage(spark, conversations):
    def broken():
        for c, t, r, x in conversations:
            r, x = " " if r is None else r, " " if x is None else x
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            x = "" if code == 1 else re.sub("[.!?]", "", x) if code == 2 else x
            yield from [(c, t, "user" if code == 4 else r, x)] * (0 if code == 0 else 2 if code == 3 else 1)

    df, expected = frame(spark, conversations), list(broken())
    got = R.damage(df)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert report(df, got) == brute_force(conversations, expected)


def test_nothing_left_and_empty_table(spark):
    df = frame(spark, [(4, 0, "user", "x.")])
    nothing = hashlib.sha256(b"").hexdigest()
    assert report(df, df.limit(0)) == [(4, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert report(df.limit(0), df.limit(0)) == []
