"""Parsing helpers shared by batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json_once(text_col: str, schema: T.StructType) -> Column:
    """``from_json`` evaluated exactly once per row, as a generator output.

    Filters on fields of a plain ``from_json`` result are pushed below the
    projection with the alias replaced by its definition, and the JSON optimizer
    then turns each field reference into a parse of its own: a filter over ten
    fields parses every message ten more times. Predicates are not pushed
    below a generator's output, so parsing inside ``explode(array(...))`` (one
    element; a malformed message gives an all-NULL struct) keeps one parse.
    """
    return F.explode(F.array(F.from_json(F.col(text_col), schema)))
