from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import pytest

from thermocline.llm.ngram_join import keep_one_of_each, ngram_components
from thermocline.llm.queries import QUERIES
from thermocline.llm.set_join import CountTree, _vectors, candidates, point, similar


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row, through an index of all shingles."""
    sets, index = [shingles(t) for _, t in rows], defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            index[x].append(k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for m in index[x]:
                if m < k:
                    shared[m] += 1
        for m, c in shared.items():
            if 100 * c >= 75 * (len(s) + len(sets[m]) - c):
                root[find(k)] = find(m)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    return sorted(str((i, len(sets[k]), least[find(k)])) for k, (i, _) in enumerate(rows))


def near_copies(rng, n):
    base = [[rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(rng.randrange(1, 90))] for _ in range(12)]
    common = [f"c{k}" for k in range(30)]
    rows = []
    for k in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        if k % 3 == 0:
            words = words + common + [f"u{k}-{j}" for j in range(rng.randrange(25))]
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(w.upper() if k % 5 == 0 else w for w in words)))
    return rows


@pytest.mark.parametrize("hot", [512, 6])
def test_against_brute_force(make_docs, hot):
    rows = near_copies(random.Random(hot), 260)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "One  two"), (None, "one two"), (None, "alone here"), (3, rows[3][1]), (1005, "É é"), (1006, "é é")]
    rows += [(1007, "w " * 40_000), (1008, "w " * 30_000)]
    docs = make_docs(rows).selectExpr("*", "1 AS node", "2 AS center").repartition(6)
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in ngram_components(docs, hot).collect())
    assert got == brute(rows)


def test_stage_and_empty(make_docs):
    docs = make_docs([(2, "a b c"), (1, "A b c"), (3, "q"), (None, "q"), (5, None), (6, "")]).selectExpr("*", "1 AS __x")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6]
    assert ngram_components(docs.limit(0)).count() == 0


def test_stage_keeps_one_of_each_component(make_docs):
    """Null ids and rows of one doc_id are told apart by their texts."""
    rows = [(None, "first text"), (None, "second text"), (None, "Second  text"), (None, ""), (None, " "), (None, "known one"), (4, "known one"),
            (7, "one of seven"), (7, "another of seven"), (7, "another of  seven"), (7, "another of seven"), (8, ""), (8, "")]
    got = sorted((r.doc_id is None, r.doc_id, " ".join(r.text.lower().split())) for r in keep_one_of_each(make_docs(rows).repartition(4)).collect())
    want = [(False, 4, "known one"), (False, 7, "another of seven"), (False, 7, "one of seven"), (False, 8, "")]
    assert got == [*want, (True, None, ""), (True, None, ""), (True, None, "first text"), (True, None, "second text")]


def test_whole_table(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in QUERIES["op7_ngram_join"](spark, "/root/testdata/sf0.01").collect())
    assert got == brute(rows)


def test_tree_finds_all_similar_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    pool = rng.integers(-(2**63), 2**63 - 1, 400)
    sets = [np.unique(rng.choice(pool[a : a + 120], rng.integers(1, 110))) for a in rng.integers(0, 280, 200)]
    sets += [np.unique(np.concatenate([s[: int(0.9 * len(s)) + 1], rng.choice(pool, 3)])) for s in sets]
    counts, sizes = _vectors([point(s) for s in sets]), np.array([len(s) for s in sets])
    tree = CountTree(counts, sizes)
    for i, s in enumerate(sets):
        assert {j for j, t in enumerate(sets) if similar(s, t)} <= set(tree.search(i).tolist())
    q, at = candidates(sizes, counts, np.arange(len(sets)) // 3)
    pairs = [(max(a, b), min(a, b)) for a, b in zip(q.tolist(), at.tolist(), strict=True)]
    assert len(set(pairs)) == len(pairs)
    assert {(i, j) for i in range(len(sets)) for j in range(i) if i // 3 != j // 3 and similar(sets[i], sets[j])} <= set(pairs)


def test_large_group_of_near_copies(make_docs):
    """2000 edits of one text, some similar to it, some only to one another: all links, and fewer rows out than in."""
    import random

    from thermocline.llm import set_join

    rng = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for i in range(2000):
        words = list(base)
        for at in rng.sample(range(80), rng.choice([1, 2, 2, 3, 3, 8])):
            words[at] = f"e{at}x{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(76)} for _, t in rows]
    root = list(range(2000))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i in range(2000):
        for j in range(i):
            if (a := find(i)) != (b := find(j)) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[max(a, b)] = min(a, b)
    searched = []
    plain = set_join._to_search
    with pytest.MonkeyPatch.context() as m:
        m.setattr(set_join, "_to_search", lambda *a: searched.append(plain(*a)) or searched[-1])
        got = {r.doc_id: r.component_id for r in ngram_components(make_docs(rows), hot=128).collect()}
    assert got == {i: find(i) for i in range(2000)} and len(set(got.values())) > 1
    keys = ["center", "block", "block_b"]
    row = f"{set_join.GROUP}, node long, n long, counts binary, root long, mine long"
    left = searched[0].groupBy(*keys).applyInArrow(set_join._nodes_left, row)
    assert 0 < left.count() <= searched[0].count()


def test_a_frequent_shingle_does_not_bring_unlike_documents_together(spark, monkeypatch):
    """Unlike texts that share one line meet in no group, and similar ones are still found, whatever the order."""
    import numpy as np

    from thermocline.llm import ngram_join
    from thermocline.llm.shingles import shingle_set

    r = random.Random(5)
    word = lambda: f"w{r.randrange(10**6)}"
    line = " ".join(f"common{k}" for k in range(14))
    bodies = [[word() for _ in range(60)] for _ in range(120)]
    texts = [f"{line} {' '.join(b)}" for b in bodies] + [f"{line} {' '.join(b[:-2])} x y" for b in bodies[:10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    seen = []
    plain = ngram_join.groups_of
    monkeypatch.setattr(ngram_join, "groups_of", lambda keyed: seen.append(plain(keyed)) or seen[-1])
    got = {x.doc_id: x.component_id for x in ngram_components(docs, hot=32).collect()}
    assert got == {i: i - 120 if i >= 120 else i for i in range(130)}
    assert seen[0].groupBy("center").count().agg({"count": "max"}).first()[0] <= 3
    sets = [shingle_set(t) for t in texts]
    for frequent in (np.zeros(0, np.uint64), ngram_join.frequent_shingles(docs, 0, 32), r.choices(sets[0], k=30)):
        frequent = np.unique(np.array(frequent, np.uint64))
        for a in range(10):
            one, two = (ngram_join.prefix(sets[k], frequent) for k in (a, a + 120))
            assert len(one) == len(sets[a]) - -(-3 * len(sets[a]) // 4) + 1
            assert len(np.intersect1d(one, two))
