"""Feed readers on hand-made landed files (the original's two station cases
re-made, plus short rows, 'MM', missing fields, malformed JSON)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from thermocline.sources.combine import source_validity, union_sources
from thermocline.sources.float_profiles import conform_float, float_list
from thermocline.sources.landing import read_landed_lines, read_landed_text, require_rows
from thermocline.sources.messages import readings_from_json_map
from thermocline.sources.observatory_json import (
    conform_observatory,
    observatory_feed,
    parse_inventory,
    parse_observatory_docs,
)
from thermocline.sources.product_tables import catalogue_datasets, conform_product
from thermocline.sources.station_text import conform_station, parse_station_lines, station_list

HEADER = (
    "#YY  MM DD hh mm WDIR WSPD GST  WVHT   DPD   APD MWD   PRES  ATMP  WTMP  DEWP  VIS PTDY  TIDE\n"
    "#yr  mo dy hr mn degT m/s  m/s     m   sec   sec degT   hPa  degC  degC  degC  nmi  hPa    ft\n"
)
ROW = "2024 02 07 09 00 180  1.5  2.0  0.3    5.0  4.0  90  1019.2 20.5 20.5  17.0 10.0  0.0  2.0\n"


def _write(dirpath, name, text):
    p = dirpath / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)
    return p


def test_two_stations_two_rows(spark, tmp_path):
    _write(tmp_path, "stations/41001.txt", HEADER + ROW)
    _write(tmp_path, "stations/41002.txt", HEADER + ROW)
    _write(tmp_path, "station_table.txt", "Header line 1\nHeader line 2\n41001 First Station\n41002 Second Station\n")
    readings, rejects = parse_station_lines(read_landed_lines(spark, str(tmp_path / "stations")))
    rows = conform_station(readings).collect()
    assert len(rows) == 2 and rejects.count() == 0
    assert {r["location"] for r in rows} == {"41001", "41002"}
    for r in rows:
        assert r["temperature"] == 20.5 and r["salinity"] == 17.0
        assert r["current_speed"] == 1.5 and r["current_direction"] == 180.0 and r["depth"] == 0.0
        assert r["timestamp"].isoformat().startswith("2024-02-07T09:00")
    ids = [r[0] for r in station_list(read_landed_lines(spark, str(tmp_path / "station_table.txt"))).collect()]
    assert sorted(ids) == ["41001", "41002"]


def test_no_station_data_fails(spark, tmp_path):
    _write(tmp_path, "stations/41001.txt", "")  # the fetch gave nothing
    readings, _ = parse_station_lines(read_landed_lines(spark, str(tmp_path / "stations")))
    with pytest.raises(ValueError, match="No data could be retrieved"):
        require_rows(readings, "No data could be retrieved from any station")


def test_short_row_drops_file_and_mm_is_zero(spark, tmp_path):
    _write(tmp_path, "s/41001.txt", HEADER + ROW + "2024 02 07 10 00 180 1.5\n")
    _write(tmp_path, "s/41002.txt", HEADER + ROW.replace("20.5  17.0", "MM  17.0"))
    readings, rejects = parse_station_lines(read_landed_lines(spark, str(tmp_path / "s")))
    rows = readings.collect()
    assert [r["location"] for r in rows] == ["41002"] and rows[0]["temperature"] == 0.0
    assert rejects.count() == 2  # the short row and the good row of the same file
    by_row, _ = parse_station_lines(read_landed_lines(spark, str(tmp_path / "s")), on_bad_row="drop_row", missing="null")
    got = {(r["location"], r["temperature"]) for r in by_row.collect()}
    assert got == {("41001", 20.5), ("41002", None)}


def test_header_order_is_respected(spark, tmp_path):
    swapped = HEADER.replace("WTMP  DEWP", "DEWP  WTMP")
    _write(tmp_path, "h/41003.txt", swapped + ROW)
    r = parse_station_lines(read_landed_lines(spark, str(tmp_path / "h")))[0].first()
    assert r["temperature"] == 17.0 and r["salinity"] == 20.5


def test_observatory_documents(spark, tmp_path):
    _write(tmp_path, "obs/n1/ctd/a.json",
           '{"data":[{"time":"2024-01-01T00:00:00","platform_code":"p1","depth":5,"temperature":"12.5","fluorescence":2},'
           '{"platform_code":"p1","depth":6}]}')  # fmt: skip
    _write(tmp_path, "obs/n1/old/b.json", '{"data":[{"time":"2024-01-01T00:00:00","platform_code":"p2"}]}')
    _write(tmp_path, "obs/n2/ctd/c.json", "{broken")
    _write(tmp_path, "inv/i.json", '[{"node":"n1","instrument":"ctd"},{"node":"n2","instrument":"ctd"}]')
    points, rejects = parse_observatory_docs(read_landed_text(spark, str(tmp_path / "obs")))
    inv = parse_inventory(read_landed_text(spark, str(tmp_path / "inv")))
    rows = conform_observatory(observatory_feed(points, inv)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["location"] == "p1" and r["temperature"] == 12.5 and r["chlorophyll"] == 2.0
    assert r["salinity"] == 0.0 and r["current_direction"] == 0.0  # missing -> 0.0
    reasons = sorted(x["reason"] for x in rejects.collect())
    assert reasons == ["malformed document or no data array", "point lacks time or platform_code"]


def test_catalogue_xpath_any_depth(spark, tmp_path):
    _write(tmp_path, "cat.xml", "<products><group><dataset>A</dataset></group><dataset>B</dataset></products>")
    got = sorted(r[0] for r in catalogue_datasets(read_landed_text(spark, str(tmp_path / "cat.xml"))).collect())
    assert got == ["A", "B"]


def test_float_and_product_conform(spark):
    prof = spark.createDataFrame(
        [("2024-01-01 00:00:00", "f1", 1.5, 10.0, 35.0)], "timestamp string, float_id string, pressure double, temperature double, salinity double"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    r = conform_float(prof).first()
    assert r["location"] == "f1" and r["depth"] == 15.0 and r["dissolved_oxygen"] is None
    lines = spark.createDataFrame([("f1",), ("  ",), ("f2 ",)], "value string")
    assert sorted(x[0] for x in float_list(lines).collect()) == ["f1", "f2"]
    prod = prof.select(F.col("timestamp").alias("time"), F.col("float_id").alias("station_id"),
                       F.lit(1.0).alias("depth"), "temperature", "salinity",
                       *[F.lit(None).cast("double").alias(c) for c in ["dissolved_oxygen", "ph", "turbidity",
                                                                        "chlorophyll", "current_speed", "current_direction"]])
    p = conform_product(prod).first()
    assert p["location"] == "f1" and p["timestamp"] is not None
    merged = union_sources({"float": conform_float(prof), "product": conform_product(prod)})
    assert sorted(r["source"] for r in merged.collect()) == ["float", "product"]


def test_validity_rules(spark):
    good = spark.createDataFrame([(1.0, 2.0)], "temperature double, salinity double")
    empty_temp = spark.createDataFrame([(None, 2.0)], "temperature double, salinity double")
    no_cols = spark.createDataFrame([(1.0,)], "temperature double")
    v = {r["source"]: r for r in source_validity({"station": good, "observatory": empty_temp, "float": no_cols}).collect()}
    assert v["station"]["valid"] is True
    assert v["observatory"]["valid"] is False  # lacks depth and has no temperature
    assert v["float"]["valid"] is False  # lacks pressure/salinity


def test_json_map_rules(spark):
    raw = spark.createDataFrame(
        [('{"timestamp":"2024-01-01 00:00:00","location":"a","temperature":"10.5","ph":8}',),
         ('{"timestamp":"2024-01-01 00:00:00","location":"a"}',),
         ('{"timestamp":"2024-01-01 00:00:00","location":"a","temperature":1,"depth":"deep"}',)],
        "value string",
    )
    readings, rejects = readings_from_json_map(raw)
    r = readings.collect()
    assert len(r) == 1 and r[0]["temperature"] == 10.5 and r[0]["depth"] == 0.0 and r[0]["salinity"] == 0.0
    assert r[0]["ph"] == 8.0 and r[0]["chlorophyll"] is None
    assert sorted(x["reason"] for x in rejects.collect()) == ["depth is not a number", "missing temperature"]


def test_whole_text_parser_matches_line_parser(spark, tmp_path):
    from thermocline.sources.station_text import parse_station_text

    _write(tmp_path, "w/41001.txt", HEADER + ROW + "2024 02 07 10 00 180 1.5\n")
    _write(tmp_path, "w/41002.txt", HEADER + ROW.replace("20.5  17.0", "MM  17.0") + "\n" + ROW)
    _write(tmp_path, "w/41003.txt", HEADER.replace("WTMP  DEWP", "DEWP  WTMP") + ROW)
    path = str(tmp_path / "w")
    for mode in ("drop_file", "drop_row"):
        a, ra = parse_station_text(read_landed_text(spark, path), on_bad_row=mode)
        b, rb = parse_station_lines(read_landed_lines(spark, path), on_bad_row=mode)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        assert sorted(map(tuple, ra.collect())) == sorted(map(tuple, rb.collect()))
    rows = parse_station_text(read_landed_text(spark, path))[0].collect()
    assert sorted((r["location"], r["temperature"]) for r in rows) == [("41002", 0.0), ("41002", 20.5), ("41003", 17.0)]


def test_ingest_time_is_separate(spark, tmp_path):
    _write(tmp_path, "i/41001.txt", HEADER + ROW)
    r = parse_station_lines(read_landed_lines(spark, str(tmp_path / "i")), ingest_time=True)[0].first()
    assert r["timestamp"].isoformat().startswith("2024-02-07T09:00") and r["ingest_time"] > r["timestamp"]


def test_landed_profile_and_product_readers(spark, tmp_path):
    from thermocline.sources.float_profiles import profiles_of_listed_floats, read_float_profiles
    from thermocline.sources.product_tables import products_of_catalogue, read_products

    _write(tmp_path, "floats/p.csv", "timestamp,float_id,pressure,temperature,salinity\n"
           "2024-01-01 00:00:00,f1,1.5,10.0,35.0\n2024-01-01 01:00:00,f9,2.0,9.0,35.1\n")  # fmt: skip
    prof = read_float_profiles(spark, str(tmp_path / "floats"), fmt="csv")
    listed = spark.createDataFrame([("f1",)], "float_id string")
    rows = conform_float(profiles_of_listed_floats(prof, listed)).collect()
    assert len(rows) == 1 and rows[0]["depth"] == 15.0 and rows[0]["location"] == "f1"

    src = spark.createDataFrame(
        [("2024-01-01 00:00:00", "s1", 5.0, 10.0, "s1_2024-01-01"), ("2024-01-01 00:00:00", "s2", 5.0, 11.0, "other")],
        "time string, station_id string, depth double, temperature double, dataset string",
    ).withColumn("time", F.col("time").cast("timestamp"))
    src.write.parquet(str(tmp_path / "products"))
    prods = read_products(spark, str(tmp_path / "products"))
    cat = spark.createDataFrame([("s1_2024-01-01",)], "dataset_id string")
    got = conform_product(products_of_catalogue(prods, cat)).collect()
    assert [r["location"] for r in got] == ["s1"] and got[0]["salinity"] is None


def test_feed_entry_points(spark, tmp_path):
    from thermocline.sources.feeds import all_feeds, float_feed, observatory_feed_from, product_feed, station_feed

    _write(tmp_path, "st/41001.txt", HEADER + ROW)
    _write(tmp_path, "st/41009.txt", HEADER + ROW)
    _write(tmp_path, "table.txt", "h1\nh2\n41001 First\n")
    stations, _ = station_feed(spark, str(tmp_path / "st"), str(tmp_path / "table.txt"))
    assert [r["location"] for r in stations.collect()] == ["41001"]
    _write(tmp_path, "empty/41002.txt", HEADER)
    with pytest.raises(ValueError, match="No data could be retrieved"):
        station_feed(spark, str(tmp_path / "empty"))

    _write(tmp_path, "obs/n1/ctd/a.json", '{"data":[{"time":"2024-01-01T00:00:00","platform_code":"p1","depth":5}]}')
    _write(tmp_path, "inv/i.json", '[{"node":"n1","instrument":"ctd"}]')
    obs, _ = observatory_feed_from(spark, str(tmp_path / "obs"), str(tmp_path / "inv"))

    _write(tmp_path, "floats.txt", "f1\n")
    _write(tmp_path, "prof/p.csv", "timestamp,float_id,pressure,temperature,salinity\n2024-01-01 00:00:00,f1,1.5,10.0,35.0\n")
    floats = float_feed(spark, str(tmp_path / "floats.txt"), str(tmp_path / "prof"), fmt="csv")

    _write(tmp_path, "cat.xml", "<products><dataset>d1</dataset></products>")
    _write(tmp_path, "prod/p.csv", "time,station_id,depth,temperature,dataset\n2024-01-01 00:00:00,s1,5.0,10.0,d1\n")
    prods = product_feed(spark, str(tmp_path / "cat.xml"), str(tmp_path / "prod"), fmt="csv")

    merged = all_feeds({"station": stations, "observatory": obs, "float": floats, "product": prods})
    assert sorted(r["source"] for r in merged.collect()) == ["float", "observatory", "product", "station"]


def test_run_metrics_stream_from_landing(spark, tmp_path):
    import json

    from thermocline.streaming.metrics_stream import run_metrics_stream

    _write(tmp_path, "in/m.json", "\n".join(
        json.dumps({"timestamp": f"2024-01-01T0{h}:10:00", "location": "a", "depth": 5.0, "temperature": 10.0,
                    "salinity": 35.0}) for h in range(4)))
    q = run_metrics_stream(spark, str(tmp_path / "out"), str(tmp_path / "chk"), landing_path=str(tmp_path / "in"),
                           trigger={"availableNow": True})
    q.awaitTermination()
    # last event 03:10 -> watermark 02:55: hours 0 and 1 are closed, 2 and 3 still open
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_run_metrics_stream_staged_mode(spark, tmp_path):
    import json

    from thermocline.streaming.metrics_stream import run_metrics_stream
    from thermocline.streaming.staged_stream import read_staged_metrics

    _write(tmp_path, "in/m.json", "\n".join(
        json.dumps({"timestamp": f"2024-01-01T0{h}:10:00", "location": "a", "depth": 5.0, "temperature": 10.0,
                    "salinity": 35.0}) for h in range(4)))
    q = run_metrics_stream(spark, str(tmp_path / "out"), str(tmp_path / "chk"), landing_path=str(tmp_path / "in"),
                           trigger={"availableNow": True}, mode="staged", stage_path=str(tmp_path / "stage"))
    q.awaitTermination()
    assert read_staged_metrics(spark, str(tmp_path / "out")).count() == 2


def test_options_missing_null_and_field_override(spark, tmp_path):
    _write(tmp_path, "obs2/n1/ctd/a.json", '{"data":[{"time":"2024-01-01T00:00:00","platform_code":"p1","depth":"x"}]}')
    points, _ = parse_observatory_docs(read_landed_text(spark, str(tmp_path / "obs2")), missing="null")
    r = points.first()
    assert r["depth"] is None and r["temperature"] is None  # unparsable / absent stay NULL
    _write(tmp_path, "ov/41001.txt", HEADER + ROW)
    readings, _ = parse_station_lines(read_landed_lines(spark, str(tmp_path / "ov")), field_for={"salinity": "PRES"})
    assert readings.first()["salinity"] == 1019.2


def test_last_hours_with_datetime(spark):
    import datetime as dt

    from thermocline.operators.timerange import last_hours

    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 0, 0),), (dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 2, 0, 0, 1),)],
        "timestamp timestamp",
    )
    got = [r[0] for r in last_hours(df, dt.datetime(2024, 1, 2, 0, 0), 24).orderBy("timestamp").collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 0, 0)]  # both ends inclusive


def test_kafka_source_is_wired(spark):
    """The bus source is a format argument; without the Kafka package the error
    names the missing source (with it, the same call subscribes from earliest)."""
    from thermocline.sources.messages import read_message_stream

    with pytest.raises(Exception, match="(?i)kafka"):
        read_message_stream(spark, "kafka", bootstrap_servers="localhost:9092")


def test_station_header_without_a_field_gives_no_value(spark):
    from thermocline.sources.station_text import _position_expr
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(["YY", "MM", "XXXX"],), ([],), (None,)], "names array<string>")
    with_header, *without = [r[0] for r in df.select(_position_expr(F.col("names"), "WTMP")).collect()]
    assert with_header is None and all(x == 15 for x in without)


def test_observatory_garbage_is_rejected(spark):
    from thermocline.sources.observatory_json import parse_observatory_docs

    doc = '{"data": [{"time": "2024-01-01T00:00:00Z", "platform_code": "p", "temperature": "garbage"}, {"time": "2024-01-01T00:00:00Z", "platform_code": "q"}]}'
    points, rejects = parse_observatory_docs(spark.createDataFrame([("f", doc)], "file string, value string"))
    assert [(r.location, r.temperature) for r in points.collect()] == [("q", 0.0)]
    assert [r.reason for r in rejects.collect()] == ["unparsable number"]


def test_lines_of_a_large_file_are_numbered_over_ranges(spark, tmp_path):
    """One file read by many tasks, beside small ones and an empty one."""
    (tmp_path / "big.txt").write_text("\n".join(f"line {k} " + "x" * (k % 37) for k in range(20_000)) + "\n")
    (tmp_path / "crlf.txt").write_bytes(b"a\r\nb\r\n\r\nc")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "s.txt").write_text("one\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = read_landed_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path / "big.txt")).rdd.getNumPartitions() > 10
        got = {(r.file.rsplit("/", 1)[1], r.line_no): r.line for r in lines.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 20_005
    assert all(got["big.txt", k].startswith(f"line {k} ") for k in range(20_000))
    assert [got["crlf.txt", k] for k in range(4)] == ["a", "b", "", "c"] and got["s.txt", 0] == "one"


def _station_rows(spark, tmp_path, header, row, **options):
    (tmp_path / "44001.txt").write_text(f"{header}\n#units\n{row}\n")
    readings, rejects = parse_station_lines(read_landed_lines(spark, str(tmp_path)), **options)
    return readings.collect(), [r["reason"] for r in rejects.collect()]


def test_time_fields_are_found_by_name(spark, tmp_path):
    """A header without minutes: no field beside it is taken for them."""
    header = "#YY MM DD hh WDIR WSPD GST WVHT DPD APD MWD PRES ATMP WTMP DEWP VIS"
    row = "2024 01 15 12 45 5.0 7.0 1 2 3 4 1013 9.0 11.5 8.0 9"
    assert _station_rows(spark, tmp_path, header, row) == ([], ["no valid event time"])
    readings, rejects = _station_rows(spark, tmp_path, header, row, default_minute=0)
    assert rejects == [] and [(r["timestamp"].hour, r["timestamp"].minute, r["current_direction"]) for r in readings] == [(12, 0, 45.0)]


def test_rows_without_a_valid_time_are_rejected(spark, tmp_path):
    header = "#YY MM DD hh mm WDIR WSPD GST WVHT DPD APD MWD PRES ATMP WTMP DEWP"
    for when in ("2024 13 15 12 00", "2024 02 30 12 00", "2024 01 15 MM 00", "2024 01 15 12 230"):
        assert _station_rows(spark, tmp_path, header, f"{when} 230 5.0 7.0 1 2 3 4 1013 9.0 11.5 8.0") == ([], ["no valid event time"])
    shuffled = "#mm hh DD MM YY WDIR WSPD GST WVHT DPD APD MWD PRES ATMP WTMP DEWP"
    readings, _ = _station_rows(spark, tmp_path, shuffled, "30 12 15 01 2024 230 5.0 7.0 1 2 3 4 1013 9.0 11.5 8.0")
    assert [(r["timestamp"].day, r["timestamp"].minute) for r in readings] == [(15, 30)]


def test_observatory_documents_by_line(spark, tmp_path):
    from thermocline.sources.feeds import observatory_feed_from

    point = '{"time": "2024-01-15T12:00:00", "platform_code": "p", "depth": 1.0, "temperature": %d}'
    folder = tmp_path / "docs" / "node=n1" / "instrument=ctd"
    folder.mkdir(parents=True)
    (folder / "d.json").write_text("\n".join('{"data": [%s, %s]}' % (point % k, point % (k + 100)) for k in range(50)) + "\n\n{broken\n")
    (tmp_path / "inv").mkdir()
    (tmp_path / "inv" / "n1.json").write_text('[{"node": "n1", "instrument": "ctd"}]')
    feed, rejects = observatory_feed_from(spark, str(tmp_path / "docs"), str(tmp_path / "inv"), per_line=True)
    assert feed.count() == 100 and rejects.count() == 1


def test_document_lines_are_read_once_and_long_paths_are_matched_at_one_place(spark, tmp_path):
    """Document lines without numbers need no shuffle; the pattern of a path is not tried at each of its characters."""
    import time

    from thermocline.sources.observatory_json import node_instrument_from_path

    _write(tmp_path / "d", "node=a/instrument=b/part.txt", "one\r\ntwo\n\nfour")
    plain = read_landed_lines(spark, str(tmp_path / "d"), numbered=False)
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    numbered = read_landed_lines(spark, str(tmp_path / "d"))
    assert sorted(map(tuple, plain.collect())) == sorted((r.file, r.line) for r in numbered.collect())
    paths = ["/x/node=a/instrument=b/p.json", "a/b/p", "b/p", "p", "", None, "/x//b/p", "/x/a=/c=d=e/p", "x-y=z/q/p", "/x/a/b/", "file:///l/o.n=g/a/b/p"]
    want = [("a", "b"), ("a", "b"), ("", ""), ("", ""), ("", ""), (None, None), ("", ""), ("a=", "d=e"), ("x-y=z", "q"), ("", ""), ("a", "b")]
    rows = node_instrument_from_path(spark.createDataFrame(list(enumerate(paths)), "i int, file string").coalesce(1)).orderBy("i").collect()
    assert [(r.node, r.instrument) for r in rows] == want
    long = spark.createDataFrame([("x" * 200_000 + "/node=a/instrument=b/p",)], "file string")
    begun = time.monotonic()
    assert node_instrument_from_path(long).select("node", "instrument").first() == ("a", "b")
    assert time.monotonic() - begun < 20
