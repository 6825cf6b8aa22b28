"""Whitespace-separated station text files.

A station file has two header lines (field names, then units) and one
observation per line after them. Columns are resolved by *header name*, not by
position, and the event time comes from the YY MM DD hh mm fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.schemas import READING_COLUMNS
from thermocline.sources.landing import file_stem

# FIXED VALUES: standard field order of the station text format (used when a file
# has no usable header line), and which field feeds which reading column.
STANDARD_FIELDS = [
    "YY", "MM", "DD", "hh", "mm", "WDIR", "WSPD", "GST", "WVHT", "DPD",
    "APD", "MWD", "PRES", "ATMP", "WTMP", "DEWP", "VIS", "PTDY", "TIDE",
]
FIELD_FOR = {
    "temperature": "WTMP",
    "salinity": "DEWP",  # stand-in, as in the original; overridable
    "current_speed": "WSPD",
    "current_direction": "WDIR",
}
TIME_FIELDS = ["YY", "MM", "DD", "hh", "mm"]
HEADER_LINES = 2


def _tokens(text: Column) -> Column:
    return F.split(F.trim(text), r"\s+")


def _wanted(fmap: dict[str, str]) -> list[str]:
    return list(dict.fromkeys([*TIME_FIELDS, *fmap.values()]))


def _pos_col(name: str) -> str:
    # Field names differ only by case ("MM" month, "mm" minute) and Spark column
    # names are case-insensitive, so the position columns are numbered.
    return f"_i{STANDARD_FIELDS.index(name) if name in STANDARD_FIELDS else 'x_' + name.lower()}"


def _position_expr(names: Column, name: str) -> Column:
    """1-based position of header field ``name``. Only without a usable header, one that names any
    standard field, is it the standard position; a field that a header lacks has none, time fields too."""
    pos = F.array_position(names, F.lit(name))
    fallback = F.lit(STANDARD_FIELDS.index(name) + 1) if name in STANDARD_FIELDS else F.lit(None)
    usable = F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, STANDARD_FIELDS))), F.lit(False))
    fallback = F.when(~usable, fallback)
    return F.when(pos > 0, pos).otherwise(fallback).cast("int")


def _position(names: Column, name: str) -> Column:
    return _position_expr(names, name).alias(_pos_col(name))


def _positions(names: Column, fmap: dict[str, str]) -> list[Column]:
    """Field positions, computed once per file from its header (never per row)."""
    return [_position(names, n) for n in _wanted(fmap)]


def _field(name: str) -> Column:
    """Value of header field ``name`` on this row (NULL past the row's end)."""
    idx = F.col(_pos_col(name))
    return F.when(idx <= F.size("_fields"), F.element_at(F.col("_fields"), idx))


def _number(name: str, missing: str) -> Column:
    parsed = _field(name).try_cast("double")
    return F.coalesce(parsed, F.lit(0.0)) if missing == "zero" else parsed


def _names_from_header(header: Column) -> Column:
    return F.coalesce(_tokens(F.regexp_replace(header, r"^\s*#", "")), F.array().cast("array<string>"))


def _finish(
    data: DataFrame,
    missing: str,
    on_bad_row: str,
    fmap: dict[str, str],
    ingest_time: bool = False,
    default_minute: int | None = None,
    location: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """data: (file, line_no, line, _fields, field positions, _bad, _file_bad) -> (readings, rejects)."""
    if on_bad_row == "drop_file":
        drop = F.col("_file_bad")
    elif on_bad_row == "drop_row":
        drop = F.col("_bad")
    else:
        raise ValueError(f"on_bad_row must be drop_file or drop_row, not {on_bad_row!r}")
    t = [_field(f).try_cast("int") for f in TIME_FIELDS]
    if default_minute is not None:
        t[4] = F.when(F.col(_pos_col("mm")).isNull(), F.lit(default_minute)).otherwise(t[4])
    event_time = F.try_make_timestamp(t[0], t[1], t[2], t[3], t[4], F.lit(0), F.lit("UTC"))
    data = data.withColumn("_time", event_time)
    reason = F.when(F.col("_bad"), F.lit("fewer than 15 fields")).when(drop, F.lit("file has a short row"))
    rejected = drop | F.col("_time").isNull()
    rejects = data.filter(rejected).select("file", "line_no", "line", reason.otherwise(F.lit("no valid event time")).alias("reason"))
    readings = data.filter(~rejected).select(
        F.col("_time").alias("timestamp"),
        (file_stem("file") if location is None else location).alias("location"),
        _number(fmap["temperature"], missing).alias("temperature"),
        _number(fmap["salinity"], missing).alias("salinity"),
        _number(fmap["current_speed"], missing).alias("current_speed"),
        _number(fmap["current_direction"], missing).alias("current_direction"),
    )
    if ingest_time:
        # when the row was read, kept apart from the observation time
        readings = readings.withColumn("ingest_time", F.current_timestamp())
    return readings, rejects


def parse_station_text(
    text: DataFrame,
    missing: str = "zero",
    on_bad_row: str = "drop_file",
    field_for: dict[str, str] | None = None,
    ingest_time: bool = False,
    default_minute: int | None = None,
    location: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(file, value) whole station files -> (readings, rejects), in one pass with
    no shuffle: the header and the "any short row" test are evaluated on each
    file's own line array (a whole-text read keeps a file in one row anyway).
    Same rules as ``parse_station_lines``."""
    fmap = {**FIELD_FOR, **(field_for or {})}
    lines = F.split(F.regexp_replace(F.col("value"), r"\r?\n$", ""), r"\r?\n")
    per_file = text.select(
        "file",
        _names_from_header(F.element_at(lines, 1)).alias("_names"),
        F.filter(
            F.transform(lines, lambda line, i: F.struct(i.cast("long").alias("line_no"), line.alias("line"))),
            lambda x: (x["line_no"] >= HEADER_LINES) & (F.trim(x["line"]) != ""),
        ).alias("_rows"),
    )
    per_file = per_file.withColumn(
        "_file_bad", F.exists("_rows", lambda x: F.size(_tokens(x["line"])) < F.lit(TH.STATION_MIN_FIELDS))
    )
    per_file = per_file.select("file", "_file_bad", "_rows", *_positions(F.col("_names"), fmap))
    pos_cols = [_pos_col(n) for n in _wanted(fmap)]
    data = per_file.select("file", "_file_bad", *pos_cols, F.explode("_rows").alias("_r")).select(
        "file", "_file_bad", *pos_cols, "_r.line_no", "_r.line"
    )
    data = data.withColumn("_fields", _tokens(F.col("line"))).withColumn(
        "_bad", F.size("_fields") < F.lit(TH.STATION_MIN_FIELDS)
    )
    return _finish(data, missing, on_bad_row, fmap, ingest_time, default_minute, location)


def parse_station_lines(
    lines: DataFrame,
    missing: str = "zero",
    on_bad_row: str = "drop_file",
    field_for: dict[str, str] | None = None,
    ingest_time: bool = False,
    default_minute: int | None = None,
    location: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(file, line_no, line) -> (readings, rejects).

    * missing="zero": an unparsable number (e.g. ``MM``) becomes 0.0, as the
      original does; "null" keeps NULL.
    * A data row with fewer than 15 fields is bad; on_bad_row="drop_file"
      discards the whole file (the original's behaviour), "drop_row" only the row.
    * Blank lines are ignored.
    * Time fields are found by name, as all others; a row whose date and time fields make no valid time is
      rejected. default_minute: the minute of files whose header has no ``mm`` (None: their rows are rejected).
    * location: an expression over ``file`` for the station id, its base name without extension by default.
    * ingest_time=True adds the read time as a separate ``ingest_time`` column.

    readings: the station frame with the common column names (timestamp from the
    row's own date fields, location = file name without extension).
    rejects: (file, line_no, line, reason).

    Per-file facts (field positions from the header, whether any row is short)
    come from one aggregate over the lines — numeric and boolean buffers only, so
    it is a map-side-combined hash aggregate, at most one row per file — joined
    back once; AQE broadcasts it when it is small.
    """
    fmap = {**FIELD_FOR, **(field_for or {})}
    is_data = (F.col("line_no") >= HEADER_LINES) & (F.trim("line") != "")
    short = F.size(_tokens(F.col("line"))) < F.lit(TH.STATION_MIN_FIELDS)
    names = _names_from_header(F.col("line"))  # evaluated on header rows only
    is_header = F.col("line_no") == 0
    info = lines.groupBy("file").agg(
        F.max(is_data & short).alias("_file_bad"),
        F.max(is_header).alias("_headed"),
        *[F.max(F.when(is_header, _position_expr(names, n))).alias(_pos_col(n)) for n in _wanted(fmap)],
    )
    pos_cols = [_pos_col(n) for n in _wanted(fmap)]
    data = lines.filter(is_data).withColumn("_fields", _tokens(F.col("line")))
    data = data.withColumn("_bad", F.size("_fields") < F.lit(TH.STATION_MIN_FIELDS))
    defaults = _positions(F.array().cast("array<string>"), fmap)  # files without a header line
    data = data.join(info, "file", "left").select(
        "file",
        "line_no",
        "line",
        "_fields",
        "_bad",
        F.coalesce(F.col("_file_bad"), F.lit(False)).alias("_file_bad"),
        *[F.when(F.col("_headed"), F.col(c)).otherwise(d).alias(c) for c, d in zip(pos_cols, defaults)],
    )
    return _finish(data, missing, on_bad_row, fmap, ingest_time, default_minute, location)


def station_list(lines: DataFrame) -> DataFrame:
    """Station ids = first whitespace token of every line after the two
    header lines of the station table."""
    rows = lines.filter((F.col("line_no") >= HEADER_LINES) & (F.trim("line") != ""))
    return rows.select(_tokens(F.col("line")).getItem(0).alias("station_id"))


def conform_station(df: DataFrame) -> DataFrame:
    """Surface buoys: depth 0.0; dissolved oxygen, pH, turbidity and
    chlorophyll are not measured (NULL)."""
    none = F.lit(None).cast("double")
    cols = {
        "timestamp": F.col("timestamp"),
        "location": F.col("location"),
        "depth": F.lit(0.0),
        "temperature": F.col("temperature"),
        "salinity": F.col("salinity"),
        "dissolved_oxygen": none,
        "ph": none,
        "turbidity": none,
        "chlorophyll": none,
        "current_speed": F.col("current_speed"),
        "current_direction": F.col("current_direction"),
    }
    return df.select(*[cols[c].alias(c) for c in READING_COLUMNS])
