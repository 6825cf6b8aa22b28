from __future__ import annotations

import re
from collections import defaultdict

import pytest

from thermocline.llm import common
from thermocline.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

ROWS = [(1, "a b"), (2, "a \t\n b"), (3, None), (4, ""), (5, " "), (6, "x" * 50), (7, "x" * 50), (8, "x" * 49 + "y"), (9, "y" + "x" * 49),
        (3, None), (10, "ab" * 40), (11, "ab" * 40), (12, "ab" * 41), (None, "a b"), (13, "é漢😀" * 9), (14, "é漢😀" * 9), (15, " "), (16, "a b c")]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None, len(ids)) for i in ids]
    return sorted(map(str, out))


@pytest.mark.parametrize("hot_rows", [64, 2])
def test_against_brute_force(make_docs, monkeypatch, hot_rows):
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    docs = make_docs(ROWS).repartition(4)
    got = exact_duplicates(docs, block_chars=4).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got) == brute(ROWS)
    assert sum(r.kept for r in got) == len({(r.keep_id, r.text_sha256) for r in got})
    left = drop_exact_duplicates(docs, block_chars=4)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_empty_and_clashing_columns(make_docs):
    docs = make_docs([(1, "a"), (2, "a")]).selectExpr("*", "1 AS row", "2 AS kept", "'z' AS name", "3 AS pos")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_duplicates(docs).collect()} == {(1, 1, True), (2, 1, False)}
    assert exact_duplicates(docs.limit(0)).count() == 0
    assert drop_exact_duplicates(docs).columns == docs.columns
