"""Landed-feed test inputs rendered by Spark from ``events`` (FIXTURES.md §4).

Each renderer returns the frame a landing-folder read would give, so the parsers
run on the same shapes as in production:

* station files and the station table as (file, line_no, line);
* observatory documents and inventory documents as (file, value);
* float list as (file, line_no, line); float profiles and product rows as tables;
* the product catalogue as (file, value) XML.

Documents are cut into bounded chunks (at most 64 points, 7 datasets or one
node's instruments) so no rendering step gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocline.fixtures import events, reading_columns
from thermocline.session import ensure_utc

STATION_BASE = 41000
STATION_FILES = 50
DOC_CHUNK = 64
RETIRED_INSTRUMENT = "error"  # in the data, but not in the inventory

# FIXED VALUES: the two header lines of a station file (field names, units).
STATION_HEADER = [
    "#YY  MM DD hh mm WDIR WSPD GST  WVHT   DPD   APD MWD   PRES  ATMP  WTMP  DEWP  VIS PTDY  TIDE",
    "#yr  mo dy hr mn degT m/s  m/s     m   sec   sec degT   hPa  degC  degC  degC  nmi  hPa    ft",
]


def _readings_plus(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    ensure_utc(spark)
    ev = events(spark, sf_dir)
    return ev.select(*reading_columns(ev), *extra)


def _num(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("MM"))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per user_id % 50; WTMP = temperature ('MM' when event_id % 13 = 0),
    DEWP = salinity, WDIR/WSPD = current direction/speed ('MM' when NULL), other
    fields constant; station 3 has short rows at event_id % 7 = 0."""
    r = _readings_plus(spark, sf_dir, (F.col("user_id") % STATION_FILES).alias("_st"))
    ts = F.col("timestamp")
    fields = [
        F.date_format(ts, "yyyy"),
        F.date_format(ts, "MM"),
        F.date_format(ts, "dd"),
        F.date_format(ts, "HH"),
        F.date_format(ts, "mm"),
        _num("current_direction"),
        _num("current_speed"),
        F.lit("2.0"),
        F.lit("0.3"),
        F.lit("5.0"),
        F.lit("4.0"),
        F.lit("90"),
        F.lit("1019.2"),
        F.lit("20.5"),
        F.when(F.col("event_id") % 13 == 0, F.lit("MM")).otherwise(F.col("temperature").cast("string")),
        _num("salinity"),
        F.lit("10.0"),
        F.lit("0.0"),
        F.lit("2.0"),
    ]
    short = (F.col("_st") == 3) & (F.col("event_id") % 7 == 0)
    line = F.when(short, F.concat_ws(" ", *fields[:10])).otherwise(F.concat_ws(" ", *fields))
    file = F.concat(F.lit("landing/stations/"), (F.lit(STATION_BASE) + F.col("_st")).cast("string"), F.lit(".txt"))
    data = r.select(file.alias("file"), (F.col("event_id") + 2).alias("line_no"), line.alias("line"))
    header = F.array(*[F.lit(h) for h in STATION_HEADER])
    headers = (
        data.select("file")
        .distinct()
        .select("file", F.posexplode(header).alias("line_no", "line"))
        .withColumn("line_no", F.col("line_no").cast("long"))
    )
    return headers.unionByName(data)


def station_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two header lines, then '<id> Station <id>' for each station in the data."""
    ev = events(spark, sf_dir)
    ids = ev.select((F.col("user_id") % STATION_FILES).alias("_st")).distinct()
    sid = (F.lit(STATION_BASE) + F.col("_st")).cast("string")
    rows = ids.select(
        (F.col("_st") + 2).cast("long").alias("line_no"), F.concat(sid, F.lit(" Station "), sid).alias("line")
    )
    head = ev.sparkSession.createDataFrame(
        [(0, "# STATION_ID | NAME"), (1, "# (text) | (text)")], "line_no long, line string"
    )
    return head.unionByName(rows).withColumn("file", F.lit("landing/station_table.txt")).select(
        "file", "line_no", "line"
    )


def observatory_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): one JSON document per (node=location, instrument=event type,
    64-id chunk); ``to_json`` leaves NULL fields out, so they default to 0.0."""
    r = _readings_plus(spark, sf_dir, "event_type")
    point = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
        F.col("location").alias("platform_code"),
        "depth",
        "temperature",
        "salinity",
        "dissolved_oxygen",
        "ph",
        "turbidity",
        F.col("chlorophyll").alias("fluorescence"),
        "current_speed",
        "current_direction",
    )
    file = F.concat_ws(
        "/",
        F.lit("landing/observatory"),
        F.col("location"),
        F.col("event_type"),
        F.concat(F.lit("part-"), F.floor(F.col("event_id") / DOC_CHUNK).cast("string"), F.lit(".json")),
    )
    return r.groupBy(file.alias("file")).agg(F.to_json(F.struct(F.collect_list(point).alias("data"))).alias("value"))


def inventory_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): per node, a JSON array of {node, instrument}; the retired
    instrument type is left out."""
    r = _readings_plus(spark, sf_dir, "event_type")
    pairs = (
        r.select(F.col("location").alias("node"), F.col("event_type").alias("instrument"))
        .distinct()
        .filter(F.col("instrument") != RETIRED_INSTRUMENT)
    )
    return pairs.groupBy("node").agg(F.to_json(F.collect_list(F.struct("node", "instrument"))).alias("value")).select(
        F.concat(F.lit("landing/inventory/"), F.col("node"), F.lit(".json")).alias("file"), "value"
    )


def float_profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(timestamp, float_id, pressure, temperature, salinity); pressure = depth / 10."""
    r = _readings_plus(spark, sf_dir)
    return r.select(
        "timestamp",
        F.col("location").alias("float_id"),
        (F.col("depth") / F.lit(10.0)).alias("pressure"),
        "temperature",
        "salinity",
    )


def float_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line_no, line): the float list, one distinct float id per line."""
    r = _readings_plus(spark, sf_dir)
    ids = r.select("location").distinct()
    return ids.select(
        F.lit("landing/float_list.txt").alias("file"),
        F.lit(0).cast("long").alias("line_no"),
        F.col("location").alias("line"),
    )


def _dataset_id() -> Column:
    return F.concat(F.col("location"), F.lit("_"), F.date_format("timestamp", "yyyy-MM-dd"))


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with native names time / station_id and the dataset id."""
    r = _readings_plus(spark, sf_dir)
    renames = {"timestamp": "time", "location": "station_id"}
    return r.select(
        *[F.col(c).alias(renames.get(c, c)) for c in r.columns if c != "event_id"], _dataset_id().alias("dataset")
    )


def catalogue_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value) XML: one document per (location, week); datasets of even days
    nested inside <group>, odd days at the top level."""
    r = _readings_plus(spark, sf_dir)
    ds = r.select("location", _dataset_id().alias("id"), F.to_date("timestamp").alias("day")).distinct()
    elem = F.concat(F.lit("<dataset>"), F.col("id"), F.lit("</dataset>"))
    even = F.dayofmonth("day") % 2 == 0
    docs = ds.groupBy("location", F.date_trunc("week", "day").alias("week")).agg(
        F.concat_ws("", F.collect_list(F.when(even, elem))).alias("nested"),
        F.concat_ws("", F.collect_list(F.when(~even, elem))).alias("top"),
    )
    value = F.concat(F.lit("<products><group>"), F.col("nested"), F.lit("</group>"), F.col("top"), F.lit("</products>"))
    file = F.concat(
        F.lit("landing/catalogue/"), F.col("location"), F.lit("-"), F.date_format("week", "yyyy-MM-dd"), F.lit(".xml")
    )
    return docs.select(file.alias("file"), value.alias("value"))


def reading_messages(spark: SparkSession, sf_dir: str, drop_fields: bool = False) -> DataFrame:
    """JSON reading messages (``value`` text) carrying event_id as an extra field.

    With ``drop_fields``: depth left out when event_id % 17 = 0 (defaults to 0.0),
    salinity when event_id % 19 = 0 (0.0), temperature when event_id % 97 = 0
    (required: the message is rejected)."""
    r = _readings_plus(spark, sf_dir)
    cols = {c: F.col(c) for c in r.columns}
    cols["timestamp"] = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if drop_fields:
        eid = F.col("event_id")
        cols["depth"] = F.when(eid % 17 != 0, F.col("depth"))
        cols["salinity"] = F.when(eid % 19 != 0, F.col("salinity"))
        cols["temperature"] = F.when(eid % 97 != 0, F.col("temperature"))
    return r.select(F.to_json(F.struct(*[v.alias(k) for k, v in cols.items()])).alias("value"))


def _cut(r: DataFrame) -> Column:
    """The middle of the readings' time span (a scalar subquery)."""
    t = F.unix_micros("timestamp")
    return r.agg(F.timestamp_micros(F.floor((F.min(t) + F.max(t)) / 2)).alias("cut")).scalar()


def held_back(r: DataFrame) -> Column:
    """Readings of the first half of the time span with event_id % 10 = 3: those that arrive late."""
    return (F.col("timestamp") < _cut(r)) & (F.col("event_id") % 10 == 3)


def delivered_messages(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """(delivery, value): the reading messages in two deliveries. The second holds the later half of the time span
    and, late, the rows of the first half with event_id % 10 = 3. With ``broken``, messages with event_id % 89 = 5
    are cut off after 40 characters and those with event_id % 83 = 7 have a word for a time."""
    r = _readings_plus(spark, sf_dir)
    eid = F.col("event_id")
    first = (F.col("timestamp") < _cut(r)) & (eid % 10 != 3)
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    cols = {c: F.col(c) for c in r.columns} | {"timestamp": F.when(eid % 83 == 7, F.lit("later")).otherwise(time) if broken else time}
    value = F.to_json(F.struct(*[v.alias(k) for k, v in cols.items()]))
    if broken:
        value = F.when(eid % 89 == 5, F.substring(value, 1, 40)).otherwise(value)
    return r.select(F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("delivery"), value.alias("value"))
