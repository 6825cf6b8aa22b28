from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from thermocline.llm.common import table
from thermocline.llm.toxicity import FEATURES, Words, drop_toxic, features, score_documents

SF = "/root/testdata/sf0.01"


def test_features_see_what_they_name():
    words = Words(frozenset({"grumb"}))
    got = dict(zip(FEATURES, features("You are an 1d10t and a GRUMBLER !!", words), strict=True))
    assert got["hidden_rate"] > 0 and got["learned_count"] > 0 and got["aimed_rate"] > 0 and got["shouted_rate"] > 0 and got["exclamation_rate"] > 0
    assert set(features("", words)) == {0.0}


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scores = score_documents(docs, labels).cache()
    rows = scores.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = scores.where("held_out").join(labels.where("toxic is not null"), "doc_id")
    right, clean_hit, toxic = held.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.sum((1 - F.col("toxic")) * F.col("predicted")), F.sum("toxic")).first()
    assert right >= 0.95 and clean_hit <= 0.02 * len(rows) and toxic > 0
    left = drop_toxic(docs.withColumn("score", F.lit("x")), labels)
    assert left.columns == [*docs.columns, "score"]
    assert {r.doc_id for r in left.select("doc_id").collect()} == {r.doc_id for r in rows if not r.predicted}


def test_odd_rows(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, None), (2, 0, 0), (2, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, None), (2, "a " * 50_000), (2, "b"), (None, "c"), (3, "")])
    rows = score_documents(docs, labels).collect()
    assert len(rows) == 5 and all(r.score == 0.0 and r.predicted == 0 for r in rows)
    assert score_documents(docs.limit(0), labels).count() == 0
    assert score_documents(docs, labels.limit(0)).count() == 5
