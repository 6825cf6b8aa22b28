"""Successor-in-order and position within a key group, safe under key skew.

``Window.partitionBy(keys).orderBy(order)`` puts every row of one key into one task. A
profile keyed by location alone (the original application's form) has a handful of huge
groups, and any single station may carry a third of all rows, so that plan has a straggler
that grows with the data.

Here the groups with more than ``rows_per_slice`` rows are cut into slices along their
order. The cuts (splitters) are quantiles of a sample of the group's own order values; the
sample is chosen by a hash of these values, so it does not depend on how the rows are dealt
out. They enter the plan as literals: the slice of a row is a function of the row alone (a
binary search), every branch of the plan agrees on it, and nothing has to be written and
reread. ``lead``/``row_number`` then run per (key, slice) after one shuffle of the rows.

Only two rows of a slice need anything from outside it: its last row needs the first row of
the key's next slice (for ``lead``), and all rows need the number of the key's earlier rows
(for ``row_number``). Both come from a per-slice summary, aggregated on the map side, with at
most one row for each slice.

Bounds, with ``N`` rows in all groups larger than ``rows_per_slice``: a slice holds about
max(rows_per_slice, N / MAX_SLICES) rows, so fewer than MAX_SLICES groups are cut and there are
at most 2 * MAX_SLICES slices. That bounds the literals, the table of cut keys and the
corrections, which are broadcast. Groups below the bound take slice 0 and need no correction.

Cost: one count by key (only the key columns are read), one shuffle of the rows; for data
with larger groups also a sample and a summary, without a shuffle of rows. The input is read
again for each of these, so it must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that one slice should hold, and slices at most (beyond it they grow in size).
ROWS_PER_SLICE = 4_000_000
MAX_SLICES = 1024
#: Rows of the sample for each slice.
SAMPLE_PER_SLICE = 128

_HOT, _SLICE, _RN, _CNT, _OFF, _LAST = "_tc_hot", "_tc_slice", "_tc_rn", "_tc_cnt", "_tc_off", "_tc_last"


def _names(carry: Sequence[str], names: dict[str, str] | None) -> dict[str, str]:
    return {c: (names or {}).get(c, f"next_{c}") for c in carry}


def _sortable(field: T.StructField) -> Column:
    """The column as a value of the same order that a Python value can carry exactly as a literal."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(field.dataType, T.FloatType):
        return c.cast("double")
    return c


def order_value(df: DataFrame, order: Sequence[str]) -> Column:
    """One comparable value of a row's place in its group: nulls first, as ``Window.orderBy`` sorts."""
    return F.struct(*[_sortable(df.schema[o]).alias(f"o{i}") for i, o in enumerate(order)])


def _same_keys(keys: Sequence[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{i}")) for i, k in enumerate(keys)], F.lit(True))


def large_groups(df: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> tuple[DataFrame | None, list[int], int]:
    """(table of the keys to be cut with their number, its sizes in that order, rows of a slice), or no table."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_CNT)).where(F.col(_CNT) > rows_per_slice)
    groups, rows = counts.agg(F.count(F.lit(1)), F.sum(_CNT)).first()
    if not groups:
        return None, [], rows_per_slice
    per = max(rows_per_slice, -(-rows // MAX_SLICES))
    found = counts.where(F.col(_CNT) > per).collect()  # fewer than MAX_SLICES
    if not found:
        return None, [], per
    schema = T.StructType([T.StructField(f"_tc_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)] + [T.StructField(_HOT, T.IntegerType())])
    table = df.sparkSession.createDataFrame([(*[r[k] for k in keys], n) for n, r in enumerate(found)], schema)
    return table, [r[_CNT] for r in found], per


def _marked(df: DataFrame, keys: Sequence[str], table: DataFrame, how: str) -> DataFrame:
    return df.join(F.broadcast(table), _same_keys(keys, "_tc_k"), how).drop(*[f"_tc_k{i}" for i in range(len(keys))])


def splitters(df: DataFrame, keys: Sequence[str], order: Sequence[str], table: DataFrame, sizes: list[int], per: int) -> list[list]:
    """For each group of ``table`` the sorted order values at which its slices begin (but for the first)."""
    value = order_value(df, order)
    one_in = max(1, per // SAMPLE_PER_SLICE)
    sample = _marked(df, keys, table, "inner").select(_HOT, value.alias("v"))
    sample = sample.where(F.pmod(F.xxhash64("v"), F.lit(one_in)) == 0).distinct()
    in_order, all_of = Window.partitionBy(_HOT).orderBy("v"), Window.partitionBy(_HOT)
    parts = F.element_at(F.lit([-(-n // per) for n in sizes]), F.col(_HOT) + 1)
    ranked = sample.select(_HOT, "v", F.row_number().over(in_order).alias("r"), F.count(F.lit(1)).over(all_of).alias("n")).withColumn("parts", parts)
    # the last of each of the sample's equal parts, but for the last part: fewer than ``parts`` rows a group
    cuts = ranked.where("floor(r * parts / n) > floor((r - 1) * parts / n) AND r < n")
    out: list[list] = [[] for _ in sizes]
    for r in cuts.orderBy(_HOT, "r").select(_HOT, "v").collect():
        out[r[_HOT]].append(r["v"])
    return out


def _slice_of(df: DataFrame, order: Sequence[str], cuts: list[list]) -> Column:
    """Number of the group's splitters at or below the row's order value; 0 for groups that are not cut."""
    kind = df.select(order_value(df, order).alias("v")).schema["v"].dataType
    literal = lambda v: F.struct(*[F.lit(v[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(kind.fields)])
    empty = F.array().cast(T.ArrayType(kind))
    held = F.array(*[F.array(*[literal(v) for v in own]).cast(T.ArrayType(kind)) if own else empty for own in cuts])
    value, own = order_value(df, order), F.element_at(held, F.col(_HOT) + 1)
    steps = max(len(c) for c in cuts).bit_length()

    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        below = F.get(own, middle) <= value
        return F.when(acc["low"] >= acc["high"], acc).otherwise(
            F.struct(F.when(below, middle + 1).otherwise(acc["low"]).alias("low"), F.when(below, acc["high"]).otherwise(middle).alias("high"))
        )

    start = F.struct(F.lit(0).alias("low"), F.size(own).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, steps))), start, halve, lambda acc: acc["low"])
    return F.when(F.col(_HOT).isNull(), F.lit(0)).otherwise(found)


def with_successor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    names: dict[str, str] | None = None,
    position_col: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add, for each ``c`` in ``carry``, the value of ``c`` on the next row in
    ``order`` within ``keys`` (NULL on a group's last row), named ``names[c]``
    (default ``next_<c>``). With ``position_col`` also add the 1-based row number.

    ``order`` should be a total order (end it with a unique id); ties are broken
    arbitrarily otherwise, as with any window function, and rows that tie on all of it
    cannot be parted. Ordering is ascending with NULLs first, as ``Window.orderBy`` does by default.
    """
    keys, order, carry = list(keys), list(order), list(carry)
    names = _names(carry, names)
    table, sizes, per = large_groups(df, keys, rows_per_slice)
    if table is None:
        return with_successor_window(df, keys, order, carry, names, position_col)

    sliced = _marked(df, keys, table, "left").withColumn(_SLICE, _slice_of(df, order, splitters(df, keys, order, table, sizes, per)))
    piece = Window.partitionBy(*keys, _SLICE).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    local = sliced.withColumns(
        {
            **{f"_tc_n_{i}": F.lead(c, 1).over(piece) for i, c in enumerate(carry)},
            _RN: F.row_number().over(piece),
            _LAST: F.lead(F.lit(1), 1).over(piece).isNull(),
        }
    )
    # Per (key, slice): row count and first row (map-side partial aggregate).
    first = F.min_by(F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]), order_value(df, order))
    summary = sliced.where(F.col(_HOT).isNotNull()).groupBy(_HOT, _SLICE).agg(F.count(F.lit(1)).alias(_CNT), first.alias("_tc_first"))
    across = Window.partitionBy(_HOT).orderBy(_SLICE)
    fixes = summary.select(
        F.col(_HOT).alias("_tc_fix_hot"),
        F.col(_SLICE).alias("_tc_fix_slice"),
        F.coalesce(F.sum(_CNT).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(_OFF),
        F.lead("_tc_first", 1).over(across).alias("_tc_x"),
    )
    joined = local.join(F.broadcast(fixes), (F.col(_HOT) == F.col("_tc_fix_hot")) & (F.col(_SLICE) == F.col("_tc_fix_slice")), "left")
    out = {names[c]: F.when(F.col(_LAST), F.col(f"_tc_x.c{i}")).otherwise(F.col(f"_tc_n_{i}")) for i, c in enumerate(carry)}
    if position_col:
        out[position_col] = (F.coalesce(F.col(_OFF), F.lit(0)) + F.col(_RN)).cast("long")
    return joined.select(*df.columns, *[v.alias(k) for k, v in out.items()])


def with_successor_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    names: dict[str, str] | None = None,
    position_col: str | None = None,
) -> DataFrame:
    """Plain window form, one task per key group: what ``with_successor`` comes to where no group is
    large (and the brute-force form of the tests and of ``tools/skew_demo.py``)."""
    names = _names(carry, names)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    cols = {names[c]: F.lead(c, 1).over(w) for c in carry}
    if position_col:
        cols[position_col] = F.row_number().over(w).cast("long")
    return df.withColumns(cols)
