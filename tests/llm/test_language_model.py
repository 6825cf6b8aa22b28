from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from thermocline.llm.language_model import DEPTH, in_blocks, is_held_out, log_kt, score_documents
from thermocline.llm.queries import QUERIES


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def base_scores(rows):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", lowered(t)), None] for _, t in rows]
    counts = Counter(w for (i, _), x in zip(rows, tokens, strict=True) if not is_held_out(i) for w in x)
    n, v = sum(counts.values()), len(counts)
    return [(len(x), sum(counts[w] > 0 for w in x), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x)) for x in tokens]


class PlainTree:
    """Context-tree weighting by the definition, on one machine, with probabilities as logarithms."""

    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        for t in texts:
            for _, path, bit in self.steps(t):
                for node in path:
                    self.n[node][bit] += 1
        self.children = defaultdict(set)
        for context, node in self.n:
            if context:
                self.children[context[:-1], node].add((context, node))
        self.kept = {}

    @staticmethod
    def steps(text):
        data = lowered(text).encode() + b"\0"
        for i, byte in enumerate(data):
            before = bytes(data[i - d] if i >= d else 0 for d in range(1, DEPTH + 1))
            for b in range(8):
                node, bit = (1 << b) | byte >> (8 - b), byte >> (7 - b) & 1
                yield i, [(before[:d], node) for d in range(DEPTH + 1)], bit

    def kt(self, node):
        a, b = self.n.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.kept:
            own = self.kt(node)
            rest = sum(self.weighted(c) for c in self.children[node])
            self.kept[node] = own if len(node[0]) == DEPTH else np.logaddexp(own, rest) - math.log(2)
        return self.kept[node]

    def chance(self, path):
        a, b = self.n.get(path[0], (0, 0))
        one = (b + 0.5) / (a + b + 1)
        if len(path) == 1:
            return one
        stop = 0.5 * math.exp(self.kt(path[0]) - self.weighted(path[0])) if path[0] in self.n else 0.5
        return stop * one + (1 - stop) * self.chance(path[1:])

    def score(self, text):
        out = 0.0
        for _, path, bit in self.steps(text):
            p = self.chance(path)
            out += math.log10(p if bit else 1 - p)
        return out


def random_rows(rng, n):
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 5))) for _ in range(30)]
    rows = [(k, " ".join(rng.choice(words).upper() if rng.random() < 0.1 else rng.choice(words) for _ in range(rng.randrange(25)))) for k in range(n)]
    return rows + [(900, None), (901, ""), (3, rows[3][1]), (None, "ab cd"), (902, "never seen 漢字"), (903, "a" * 3000)]


@pytest.mark.parametrize("block_bytes", [16 << 20, 700])
def test_against_plain_tree(make_docs, block_bytes):
    rows = random_rows(random.Random(6), 60)
    docs = make_docs(rows).selectExpr("*", "1 AS block", "2 AS kind", "3 AS key").repartition(3)
    got = sorted(score_documents(docs, block_bytes).collect(), key=lambda r: (str(r.doc_id), r.n_bytes))
    tree = PlainTree([t for i, t in rows if not is_held_out(i)])
    want = sorted(((i, *b, t) for (i, t), b in zip(rows, base_scores(rows), strict=True)), key=lambda r: (str(r[0]), len(lowered(r[-1]).encode())))
    assert len(got) == len(want)
    for r, (i, tokens, known, n, base, text) in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, is_held_out(i), tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(tree.score(text), rel=1e-9)


def test_blocks_are_bounded_by_bytes(make_docs):
    """Long texts side by side do not make a long block, and a long text is alone."""
    rng, limit = random.Random(8), 20_000
    sizes = [rng.randrange(300) for _ in range(1500)] + [3000] * 60 + [50_000, 10, 10] + [rng.randrange(300) for _ in range(500)]
    docs = make_docs([(k, "x" * n) for k, n in enumerate(sizes)]).coalesce(1)
    blocks, rows = defaultdict(list), in_blocks(docs, limit).collect()
    for r in rows:
        blocks[r.block].append(len(r.text) + 1)
    assert sorted((r.doc_id, len(r.text)) for r in rows) == list(enumerate(sizes))
    assert all(sum(x) <= 1.25 * limit or len(x) == 1 for x in blocks.values()) and len(blocks) <= 60
    odd = make_docs([(1, None), (2, "a b " * 400), (None, "a b"), (3, "b c " * 300), (4, "")]).coalesce(1)
    whole, cut = ({str(r.doc_id): (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in score_documents(odd, n).collect()} for n in (1 << 20, 900))
    assert whole == cut and len(cut) == 5


def test_empty_and_untrained(make_docs):
    assert score_documents(make_docs([(1, "a")]).limit(0)).count() == 0
    held = next(i for i in range(100) if is_held_out(i))
    r = score_documents(make_docs([(held, "ab")])).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens) == (2, 0, 0) and r.score == pytest.approx(3 * 8 * math.log10(0.5))


def test_kt_of_large_counts():
    for a, b in ((0, 0), (3, 0), (4095, 4095), (5000, 1), (10**7, 10**6)):
        want = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
        assert log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(want, rel=1e-9)


def test_table_beats_the_base(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.1/documents.parquet'").fetchall()
    base = {i: b for (i, _), b in zip(rows, base_scores(rows), strict=True)}
    got = QUERIES["op9_language_model"](spark, "/root/testdata/sf0.1").collect()
    assert {r.doc_id for r in got} == set(base)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == base[r.doc_id][:3] and r.base_score == pytest.approx(base[r.doc_id][3], rel=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
