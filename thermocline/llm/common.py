"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A group key is hot from this many rows on, and at most so many keys are treated as hot:
#: that bounds the broadcast of hot keys; all rows of every key are processed either way.
HOT_ROWS = 64
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table, whatever other columns it has; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def hot_fingerprints(df: DataFrame, fp: Column) -> list[int]:
    """The at most HOT_KEYS most frequent fingerprints among those with HOT_ROWS rows or more."""
    counts = df.groupBy(fp.alias("fp")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= HOT_ROWS).orderBy(F.col("n").desc(), "fp").limit(HOT_KEYS)
    return [r.fp for r in top.collect()]


def mark_hot(df: DataFrame, fp: Column, hot: list[int], flag: str) -> DataFrame:
    """Boolean column ``flag``: the row's fingerprint is one of ``hot`` (at most HOT_KEYS of them)."""
    if not hot:
        return df.withColumn(flag, F.lit(False))
    keys = F.broadcast(df.sparkSession.createDataFrame([(x, True) for x in hot], "__fp long, __hot boolean"))
    return df.withColumn("__fp", fp).join(keys, "__fp", "left").withColumn(flag, F.coalesce("__hot", F.lit(False))).drop("__fp", "__hot")


def attach_group(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Add to each row aggregates over all rows with equal ``keys`` (nulls equal).

    Rows of hot keys stay where they are: their groups are aggregated with map-side
    combining and come back as a broadcast of at most HOT_KEYS fingerprints' groups.
    All other groups are windows of a bounded size. ``df`` is read twice; give a table.
    """
    fp = F.xxhash64(*keys)
    hot = hot_fingerprints(df, fp)
    marked = mark_hot(df, fp, hot, "__is_hot")
    window = Window.partitionBy(*keys)
    cold = marked.where(~F.col("__is_hot")).withColumns({k: a.over(window) for k, a in aggs.items()})
    if not hot:
        return cold.drop("__is_hot")
    rows = marked.where("__is_hot")
    groups = rows.groupBy(*[F.col(k).alias(f"__g_{k}") for k in keys]).agg(*[a.alias(k) for k, a in aggs.items()])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    joined = rows.join(F.broadcast(groups), same).drop(*[f"__g_{k}" for k in keys])
    return cold.unionByName(joined).drop("__is_hot")


#: What a worker keeps between the batches of a task; emptied when the task ends.
TASK_CACHES: list[dict] = []


def give_back() -> None:
    """Gives memory that a task has used and no longer needs back to the system."""
    for cache in TASK_CACHES:
        cache.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not the GNU library


def tidy(run):
    """``run`` (batches to batches), after which its worker is small again: Spark keeps the workers of ended tasks
    and takes them in turn, so that an executor holds more of them than it has tasks at a time."""

    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
