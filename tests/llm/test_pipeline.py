from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_ngram_join import brute  # noqa: E402
from test_packing import check_pieces  # noqa: E402

from thermocline.llm.common import table  # noqa: E402
from thermocline.llm.toxicity import score_documents  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "secret_scan", "packing"]
    toxic = {r.doc_id for r in score_documents(docs, table(spark, SF, "labels")).collect() if r.predicted}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        found = docs.collect()
        if name == "toxicity":
            want = {i for i in rows if i not in toxic}
        elif name == "exact_dedup":
            least = {}
            for i in sorted(rows):
                least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i].text or ""), i)
            want = set(least.values())
        elif name == "ngram_join":
            want = {i for i, _, c in map(eval, brute([(i, r.text) for i, r in rows.items()])) if i == c}
        elif name == "secret_scan":
            want = set(rows)
            assert any("<SECRET>" in r.text for r in found) and not any(re.search("AKIA[0-9A-Z]{16}", r.text) for r in found)
        else:
            padding, seqs = check_pieces(found, {i: r.text for i, r in rows.items()}, 4096)
            assert padding <= 0.02 * sum(map(len, seqs.values()))
            break
        assert docs.columns == columns and len(found) == len(want) and {r.doc_id for r in found} == want
        if name != "secret_scan":
            assert all(r == rows[r.doc_id] for r in found)
        rows = {r.doc_id: r for r in found}


def test_run_and_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, row int"
    odd = [(1, None, None, None, None, None, None), (2, "", "en", "s", 0, "x", 1), (3, "a b", "en", "s", 3, "x", 1), (3, "a b", "en", "s", 3, "x", 1), (None, "c d", "en", "s", 3, "x", 1)]
    spark.createDataFrame(odd, schema).write.parquet(f"{tmp_path}/odd/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/odd/labels.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r.doc_id for r in out} == {1, 3, None} and sum(r.length for r in out) == 7
