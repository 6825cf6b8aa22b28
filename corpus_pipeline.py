"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of documents:

* toxicity drops the documents whose score reaches the threshold; it learns from the labels;
* exact_dedup keeps, of equal texts, the row with the smallest doc_id;
* ngram_join keeps, of each component of near-duplicates, the document with the smallest doc_id;
* secret_scan masks the secrets in the texts and drops nothing;
* packing cuts what is left into token pieces and places them in sequences.

Nulls, empty texts, repeated rows, ties and empty tables are treated as the operators' modules
state. A model stage and component search cannot be put in SQL, so there is no ORACLE_SQL; the
tests hold the pipeline against a brute-force version of its stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from thermocline.llm.common import table
from thermocline.llm.exact_dedup import drop_exact_duplicates
from thermocline.llm.ngram_join import keep_one_of_each
from thermocline.llm.packing import pack_documents
from thermocline.llm.secret_scan import mask_secrets
from thermocline.llm.toxicity import drop_toxic
from thermocline.session import materialize

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join), ("secret_scan", secret_scan), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
