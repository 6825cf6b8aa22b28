from __future__ import annotations

import random
from collections import defaultdict

import duckdb
import numpy as np

from thermocline.llm.queries import QUERIES
from thermocline.llm.substring_dedup import MIN_PASSAGE, MIN_WORDS, paragraphs, remove_repeats, repeated_paragraphs, without_words


def prose(rng, n):
    return [rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randrange(5000)) for _ in range(n)]


def test_planted_passages(make_docs):
    rng = random.Random(2)
    rows, planted = [], defaultdict(set)
    passages = [prose(rng, 55) for _ in range(20)]
    for i in range(200):
        words = prose(rng, rng.randrange(60, 200))
        if i % 2:
            k = rng.randrange(20)
            at = rng.randrange(len(words))
            words[at:at] = passages[k]
            planted[k].add(i)
        for at in range(20, len(words), 60):
            words[at] += "\n" if i % 2 == 0 else ""
        rows.append((i, " ".join(words)))
    line = prose(rng, 30)
    for i, text in enumerate((line, [*line[:-1], "other"], [*line[:-2], "x", "y"])):
        rows.append((900 + i, "\n".join([" ".join(prose(rng, 40)), " ".join(text), " ".join(prose(rng, 40))])))
    got = repeated_paragraphs(make_docs(rows).selectExpr("*", "1 AS node", "2 AS line").repartition(5)).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    want = {i for ids in planted.values() if len(ids) > 1 for i in ids} | {900, 901, 902}
    assert set(by_doc) <= want and len(want - set(by_doc)) <= 2
    clusters = defaultdict(list)
    for r in got:
        clusters[r.cluster_id].append(r)
    assert all(len(c) == c[0].occurrences and sum(not r.removed for r in c) == 1 for c in clusters.values())
    assert {r.doc_id for r in max(clusters.values(), key=lambda c: {r.doc_id for r in c} == {900, 901, 902}) if r.doc_id >= 900} == {900, 901, 902}
    left = {r.doc_id: r.text for r in remove_repeats(make_docs(rows)).collect()}
    assert all(left[i] == t for i, t in rows if i not in by_doc) and sum(map(len, left.values())) < sum(len(t) for _, t in rows)


def test_odd_rows(make_docs):
    text = " ".join(prose(random.Random(1), 40))
    docs = make_docs([(1, None), (2, ""), (3, text), (3, text), (None, text.upper()), (4, "short line"), (5, "short line"), (6, "a " * 50_000)])
    got = repeated_paragraphs(docs).collect()
    assert {r.doc_id for r in got} == {3, None}
    # a repeated row repeats its paragraphs: of the three rows, one of document 3 keeps them
    lines = [r for r in got if r.start_word == 0 and r.n_words == 40]
    assert sorted((r.doc_id or 0, r.removed) for r in lines) == [(0, True), (3, False), (3, True)]
    assert repeated_paragraphs(docs.limit(0)).count() == 0
    assert without_words("a  b\nc d", [(1, 2)]) == "a   d"


def test_rows_that_share_an_id(make_docs):
    """Rows are told apart whatever their ids: none collapses into another, no span is cut from another row's text."""
    rng = random.Random(8)
    passage, other, third = (prose(rng, n) for n in (60, 30, 50))
    text = " ".join(prose(rng, 20) + passage)
    rows = [(None, text), (None, text), (7, " ".join(other)), (7, " ".join(third + passage)), (8, " ".join(passage + prose(rng, 9)))]
    left = [(r.doc_id, r.text.split()) for r in remove_repeats(make_docs(rows)).collect()]
    assert (7, other) in left and (7, third + passage) in left and len(left) == 5
    assert all(not set(passage) & set(words) for i, words in left if i != 7)


def test_whole_passages_are_found(make_docs):
    """Of passages of 51 and 80 words inside longer lines, every word is reported in every document, and no other."""
    rng = random.Random(11)
    rows, planted = [], {}
    for k in range(150):
        passage = prose(rng, 51 if k % 2 else 80)
        for _ in range(2):
            before = prose(rng, rng.randrange(5, 90))
            planted[len(rows)] = set(range(len(before), len(before) + len(passage)))
            rows.append((len(rows), " ".join(before + passage + prose(rng, rng.randrange(5, 90)))))
    rows += [(len(rows) + k, " ".join(prose(rng, 120))) for k in range(100)]
    found = defaultdict(set)
    for r in repeated_paragraphs(make_docs(rows)).collect():
        found[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
    assert set(found) <= set(planted)
    words = sum(len(p) for p in planted.values())
    assert sum(len(planted[i] & found[i]) for i in planted) >= 0.98 * words
    assert sum(len(found[i] - planted[i]) for i in found) <= 0.01 * words


def _places(rows):
    """Words of each paragraph text that occurs more than once -> its places."""
    places = defaultdict(set)
    for i, t in rows:
        words = t.lower().split()
        _, start, end, _ = paragraphs(t)
        for a, b in zip(start.tolist(), end.tolist(), strict=True):
            places[tuple(words[a:b])].add((i, a, b - a))
    return {k: v for k, v in places.items() if len(v) > 1}


def _words(spans):
    found = defaultdict(set)
    for i, start, n in spans:
        found[i] |= set(range(start, start + n))
    return found


def test_whole_table_exact_repeats(spark):
    """Every paragraph text that occurs twice is reported at each place; the query leaves only those away that do not
    occur twice within runs of MIN_PASSAGE words or more."""
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    places = _places(rows)
    want = _words(p for x in places.values() for p in x)
    every = _words((r.doc_id, r.start_word, r.n_words) for r in repeated_paragraphs(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), MIN_WORDS).collect())
    assert len(want) > 100 and all(want[i] <= every[i] for i in want)
    # grown words are equal to another document's beyond the paragraph, near copies of lines are few
    assert sum(map(len, every.values())) <= 1.3 * sum(map(len, want.values()))
    got = _words((r.doc_id, r.start_word, r.n_words) for r in QUERIES["op4_substring_dedup"](spark, "/root/testdata/sf0.01").collect())
    long_runs = defaultdict(set)
    for i, words in want.items():
        run = []
        for w in [*sorted(words), None]:
            if run and w != run[-1] + 1:
                long_runs[i] |= set(run) if len(run) >= MIN_PASSAGE else set()
                run = []
            run.append(w)
    in_runs = [[p for p in x if p[1] in long_runs[p[0]]] for x in places.values()]
    passages = _words(p for x in in_runs if len(x) > 1 for p in x)
    assert len(passages) > 50 and all(passages[i] <= got[i] for i in passages)


def test_paragraphs_cover_the_text():
    words = prose(random.Random(4), 300)
    _, start, end, line = paragraphs(" ".join(words))
    assert line.sum() == 1 and (end - start >= MIN_WORDS).all() and np.diff(start[~line]).min() > 0


def test_short_pieces_are_not_lost():
    """All words between the first and the last cut of a passage belong to a paragraph that moves with it."""
    rng, lost, first_cut = random.Random(6), 0, []
    for _ in range(300):
        passage, found = prose(rng, 60), []
        for _ in range(2):
            before = prose(rng, rng.randrange(20, 60))
            _, start, end, line = paragraphs(" ".join(before + passage + prose(rng, 40)))
            found.append({(a - len(before), b - len(before)) for a, b in zip(start[~line].tolist(), end[~line].tolist(), strict=True) if a >= len(before) and b <= len(before) + 60})
        spans = sorted(found[0] & found[1])
        covered = {w for a, b in spans for w in range(a, b)}
        first_cut.append(len(covered))
        lost += bool(spans) and len(covered) < max(b for _, b in spans) - spans[0][0]
    assert lost == 0 and sum(first_cut) / 300 > 0.64 * 60


def test_tables_between_the_steps_are_deleted(make_docs, spark, monkeypatch, tmp_path):
    """When the passages are there, what led to them no longer takes disk; the result can still be read, twice."""
    from thermocline import session

    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(tmp_path))
    passage = " ".join(prose(random.Random(3), 60))
    got = repeated_paragraphs(make_docs([(1, passage), (2, "first " + passage), (3, passage + " last"), (4, "none of it")]))
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "thermocline").iterdir()}
    assert not left & {"paragraphs-all", "key-runs", "paragraphs", "line-sets", "line-points", "paragraphs-placed", "paragraph-sides"}
    assert {"texts-numbered", "passages"} <= left
    assert {r.doc_id for r in got.collect()} == {1, 2, 3} and got.count() == got.count() > 0


def test_tasks_leave_nothing_in_their_workers(make_docs):
    """A worker that waits for its next task no longer holds the words of the last one."""
    import pyarrow as pa

    from thermocline.llm import shingles
    from thermocline.llm.packing import _TOKENIZERS
    from thermocline.llm.substring_dedup import _paragraph_rows

    words = prose(random.Random(5), 200)
    batch = pa.RecordBatch.from_pydict({"row": [1], "doc_id": [1], "text": [" ".join(words)]})
    _TOKENIZERS["a file"] = None  # of the packing stage, which is over when other tasks run
    tasks = _paragraph_rows(iter([batch]))
    assert next(tasks).num_rows and len(shingles._HASHES) >= len(set(words))
    assert list(tasks) == [] and not shingles._HASHES and not _TOKENIZERS

    def kept(batches):
        from thermocline.llm.shingles import _HASHES

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(_HASHES)]})

    docs = make_docs([(i, " ".join(prose(random.Random(i), 100))) for i in range(40)])
    assert repeated_paragraphs(docs).count() == 0
    assert {r.n for r in docs.repartition(16).mapInArrow(kept, "n long").collect()} == {0}


def test_spans_asked_for_are_read_many_texts_at_a_time():
    """Sets of lines and sides of spans come in a batch for many texts, not one for each, and are those of the definition."""
    import pyarrow as pa

    from thermocline.llm.shingles import shingle_hashes, word_hashes
    from thermocline.llm.substring_dedup import REACH, _line_sets, _span_sides

    rng = random.Random(12)
    texts = ["A  b\nc d E f g h\x1c i", "", *[" ".join(prose(rng, rng.randrange(8, 150))) for _ in range(300)]]
    words, spans = [t.encode().lower().split() for t in texts], []
    for k, w in enumerate(words):
        starts = [rng.randrange(len(w) - 7) for _ in range(k % 4)] if w else []
        spans.append([{"node": 1000 * k + n, "start": a, "n_words": rng.randrange(8, len(w) - a + 1)} for n, a in enumerate(starts)])
    kind = pa.list_(pa.struct([("node", pa.int64()), ("start", pa.int64()), ("n_words", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(7, len(texts) + 7)), pa.array(texts), pa.array(spans, kind)], names=["row", "text", "spans"])
    sets, sides = (list(f(iter([batch.slice(0, 2), batch.slice(2)]))) for f in (_line_sets, _span_sides))
    assert len(sets) <= 2 and len(sides) <= 2
    hashes, asked = [word_hashes(w) for w in words], [(k, s, s["start"], s["start"] + s["n_words"]) for k, x in enumerate(spans) for s in x]
    got = [r for b in sets for r in b.to_pylist()]
    assert got == [{"node": s["node"], "elements": np.unique(shingle_hashes(hashes[k][a:b])).view(np.int64).tolist()} for k, s, a, b in asked]
    short = [(h >> np.uint64(32)).astype(np.uint32) for h in hashes]
    got = [r for b in sides for r in b.to_pylist()]
    assert got == [{"node": s["node"], "row": k + 7, "start": a, "n_words": b - a, "left": short[k][max(0, a - REACH) : a][::-1].tobytes(), "right": short[k][b : b + REACH].tobytes()} for k, s, a, b in asked]


def test_few_words_are_kept_with_their_hashes():
    """A large dictionary of words is slower than hashing them; hashes are the same whether kept or not."""
    from thermocline.llm import shingles

    shingles._HASHES.clear()
    words = [b"w%d" % i for i in range(30_000)]
    one, two = shingles.word_hashes(words), shingles.word_hashes(words)
    assert len(shingles._HASHES) == shingles.KEPT_WORDS <= 10_000 and (one == two).all() and len(set(one.tolist())) == len(words)
    shingles._HASHES.clear()
    assert (shingles.word_hashes(words[:100]) == one[:100]).all() and len(shingles._HASHES) == 100
    shingles._HASHES.clear()
