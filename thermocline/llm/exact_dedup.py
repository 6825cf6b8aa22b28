"""Exact deduplication by deterministic block naming.

Each normalised text is cut into blocks of a fixed number of characters. Blocks are
sorted, and equal blocks get one integer name: the number of the first of them. Then
neighbouring names are paired, pairs are named in the same way, and so on, until each
document has one name. Two documents with equal numbers of blocks have the same name
exactly if their texts are equal: names stand for contents and no hash is trusted (hashes
only find frequent blocks, whose rows are salted). DataFrame functions only.

Defined results: a null text is an empty text and all empty texts are equal; a repeated
row is a copy, of which one stays; a null doc_id sorts after all others; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermocline.llm.common import attach_group, hot_fingerprints, id_and_text, mark_hot
from thermocline.session import materialize

#: Characters in a block.
BLOCK_CHARS = 2048
#: Parts into which the rows of a hot block are dealt.
SALTS = 64
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text):
    return F.regexp_replace(text, SPACE, " ")


def _blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """A row for each block: row (number of the document's row), doc_id, pos, block, occ (number of
    the block) and, in the first block only, the text's hash."""
    rows = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", normalised(F.col("text")).alias("norm"))
    cut = F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    out = rows.select("row", "doc_id", F.sha2("norm", 256).alias("sha"), F.posexplode_outer(cut).alias("pos", "block"))
    return out.select(
        "row", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("doc_id")).alias("doc_id"), F.coalesce("pos", F.lit(0)).alias("pos"),
        F.coalesce("block", F.lit("")).alias("block"), F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("sha")).alias("sha"),
        F.monotonically_increasing_id().alias("occ"),
    )


def _name_blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """Blocks with their names instead of their texts. The texts are shuffled once; a hot block is
    dealt over SALTS parts, which are named apart and then brought together through one row each."""
    blocks = _blocks(docs, block_chars)
    fp = F.xxhash64("block")
    marked = mark_hot(blocks, fp, hot_fingerprints(blocks, fp), "is_hot")
    salted = marked.withColumn("salt", F.when(F.col("is_hot"), F.pmod(F.col("occ"), F.lit(SALTS))).otherwise(F.lit(-1)))
    named = salted.withColumn("part", F.min("occ").over(Window.partitionBy("block", "salt")))
    named = named.select("row", "doc_id", "pos", "sha", "occ", "part", F.when(F.col("is_hot") & (F.col("occ") == F.col("part")), F.col("block")).alias("block"))
    named = materialize(named, "block-names")
    firsts = named.where("block is not null").select("part", "block")  # at most SALTS for each hot block
    names = firsts.withColumn("name", F.min("part").over(Window.partitionBy("block"))).select("part", "name")
    return named.drop("block").join(F.broadcast(names), "part", "left").withColumn("name", F.coalesce("name", "part")).drop("part")


def name_documents(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row: row, doc_id, sha, n_blocks and name; equal (n_blocks, name) means equal texts."""
    names = materialize(_name_blocks(docs, block_chars), "names-0")
    heads = names.where("pos = 0").select("row", "doc_id", "sha")
    sizes = names.groupBy("row").agg(F.count(F.lit(1)).alias("n_blocks"))
    most = sizes.agg(F.max("n_blocks")).first()[0] or 0
    level = names.select("row", "pos", "occ", "name")
    roots, depth = level.where("pos = 0").join(sizes.where("n_blocks = 1"), "row").select("row", "n_blocks", "name"), 0
    if most > 1:
        level = level.join(sizes.where("n_blocks > 1"), "row")
    while most > 1:
        depth, most = depth + 1, (most + 1) // 2
        even = F.col("pos") % 2 == 0
        pairs = level.groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("half")).agg(
            F.min("occ").alias("occ"), F.max(F.when(even, F.col("name"))).alias("left"), F.max(F.when(~even, F.col("name"))).alias("right")
        )
        pairs = materialize(pairs.withColumnRenamed("half", "pos"), f"pairs-{depth}")
        level = attach_group(pairs, ["left", "right"], {"name": F.min("occ")}).drop("left", "right")
        done = F.col("n_blocks") <= 2**depth
        level = materialize(level, f"names-{depth}")
        roots = roots.unionByName(level.where(done).select("row", "n_blocks", "name"))
        level = level.where(~done)
    return heads.join(roots, "row")


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``."""
    named = materialize(name_documents(docs, block_chars), "named-documents")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("at")))
    out = attach_group(named, ["n_blocks", "name"], {"first": first, "group_size": F.count(F.lit(1))})
    return out.select("doc_id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.at")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without all but one of each group of equal texts, all columns kept."""
    kept = exact_duplicates(docs, block_chars).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    rows = docs.withColumn("__text_sha", F.sha2(normalised(F.coalesce("text", F.lit(""))), 256))
    out = rows.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_sha") == F.col("__sha")), "left_semi")
    return out.dropDuplicates(["doc_id", "__text_sha"]).select(*[F.col(c) for c in docs.columns])
