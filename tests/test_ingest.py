"""Landed CSV files: validation, station from path, sinks, round trip."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from skymetrics.operators import prepare
from skymetrics.schema import CSV_COLUMNS
from skymetrics.sources import csv_files, fixture, sinks

from .conftest import SF_SMALL, rows

HEADER = ",".join(CSV_COLUMNS)


def _land(root, station, lat, lon, date, lines, header=HEADER):
    d = os.path.join(root, f"weather_data_hourly_{station}_{lat}_{lon}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"weather_{date}.csv"), "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")
    return d


def test_validation_keeps_good_rows_and_rejects_bad(spark, scratch):
    _land(scratch, "Tenerife", 28.2916, -16.6291, "2024-03-31", [
        "2024-03-31T00:00,10.5,80,0.2,61,5.1,350,1018.2",
        "2024-03-31T01:30,11.0,81,0.0,3.0,5.0,10,1018.0",   # DST-gap label, code written 3.0
        "2024-03-31T02:00,,,,,,,",                          # all measures empty
        "2024-03-31T03:00,NA,NA,NA,NA,NA,NA,NA",            # NA token
        "2024-03-31T04:00,abc,80,0,1,5,10,1000",            # text in a number
        "not-a-time,10,80,0,1,5,10,1000",                   # unparseable time
    ])
    text = csv_files.read_text(spark, scratch)
    good, rejects = csv_files.validate(text)
    assert good.count() == 4
    # same rows whatever columns a later query selects
    assert good.select("Time").count() == 4
    assert sorted(r.BadColumns[0] for r in rejects.collect()) == ["Temperature", "Time"]
    obs = csv_files.load_observations(spark, scratch)
    got = {r.Time: r for r in obs.collect()}
    gap = got[dt.datetime(2024, 3, 31, 1, 30)]
    assert gap.Station == "Tenerife"
    assert gap.WeatherCode == 3
    assert gap.Time.hour == 1  # not shifted by a session time zone
    empty = got[dt.datetime(2024, 3, 31, 2, 0)]
    assert all(getattr(empty, m) is None for m in ("Temperature", "Humidity", "Pressure"))


def test_station_from_directory_name(spark, scratch):
    _land(scratch, "Gran Canaria", 27.9545, -15.592, "2024-01-01", ["2024-01-01T00:00,1,2,0,0,3,4,1000"])
    _land(scratch, "El Hierro", 27.7406, -18.0204, "2024-01-01", ["2024-01-01T00:00,1,2,0,0,3,4,1000"])
    obs = csv_files.load_observations(spark, scratch)
    assert sorted(r.Station for r in obs.collect()) == ["El Hierro", "Gran Canaria"]


def test_lines_of_whole_files(spark, scratch):
    texts = {"long": "\ufeff\n Time,Temperature\r\n" + "".join(f"2024-01-01T{i % 24:02d}:00,{i}\n\n  \n" for i in range(3000)),
             "header": "Time,Humidity", "closed": "Time,Pressure\n", "blank": "Time,Note\n\n  \n", "quoted": 'Time,"a,b"\n1,"x ""y"", z"'}
    for name, text in texts.items():
        with open(os.path.join(scratch, f"{name}.csv"), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    got = csv_files.read_lines(spark, scratch).select(F.regexp_extract("SourceFile", r"([a-z]+)\.csv$", 1).alias("file"), "Names", "Cells", "Line").collect()
    long = [r for r in got if r.file == "long"]
    assert {tuple(r.Names) for r in long} == {("Time", "Temperature")}
    assert sorted(int(r.Cells[1]) for r in long) == list(range(3000))
    # a file that is only a header gives a row without a line, blank lines none
    assert sorted((r.file, tuple(r.Names), r.Cells and tuple(r.Cells), r.Line) for r in got if r.file != "long") == [
        ("header", ("Time", "Humidity"), None, None),
        ("quoted", ("Time", "a,b"), ("1", 'x "y", z'), '1,"x ""y"", z"')]


def test_missing_input_raises(spark, scratch):
    with pytest.raises(FileNotFoundError):
        csv_files.read_text(spark, os.path.join(scratch, "nope"))
    os.makedirs(os.path.join(scratch, "empty"))
    with pytest.raises(FileNotFoundError):
        csv_files.read_text(spark, os.path.join(scratch, "empty"))


def test_inferred_layouts_union_by_name(spark, scratch):
    a = _land(scratch, "A", 1, 2, "2024-01-01", ["2024-01-01T00:00,1.5,2"], header="Time,Temperature,Humidity")
    b = _land(scratch, "B", 1, 2, "2024-01-02", ["2024-01-02T00:00,3.5,1001"], header="Time,Temperature,Pressure")
    df = csv_files.read_by_layout(spark, [a, b])
    assert set(df.columns) == {"SourceFile", "Time", "Temperature", "Humidity", "Pressure"}
    got = {r.Temperature: (r.Humidity, r.Pressure) for r in df.collect()}
    assert got == {1.5: (2, None), 3.5: (None, 1001)}


def test_daily_csv_round_trip(spark, scratch):
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Time").isNotNull())
    out = os.path.join(scratch, "landed")
    sinks.write_daily_csv(obs, out)
    # one file per station-day
    for station_dir in os.listdir(out):
        if not station_dir.startswith("Station="):
            continue
        for day in os.listdir(os.path.join(out, station_dir)):
            files = [f for f in os.listdir(os.path.join(out, station_dir, day)) if f.endswith(".csv")]
            assert len(files) == 1
    back = csv_files.load_observations(spark, out)
    assert rows(back) == rows(obs.select(back.columns))


def test_report_csv_single_file_with_spanish_headers(spark, scratch):
    from skymetrics.functions.calendar import with_calendar
    from skymetrics.operators import aggregates as A

    m = A.monthly_summary(with_calendar(fixture.observations(spark, SF_SMALL)), by=())
    out = os.path.join(scratch, "report")
    sinks.write_report_csv(sinks.with_spanish_headers(m), out)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    with open(os.path.join(out, files[0]), encoding="utf-8") as f:
        header = f.readline().strip()
    assert header.startswith("Año,Mes,Temp Prom,Temp Min,Temp Max,Humedad Prom")


def test_positional_union_of_many_frames(spark):
    obs = fixture.observations(spark, SF_SMALL)
    parts = [obs.filter(F.col("Station") == s) for s in fixture.FIXTURE_STATIONS]
    assert prepare.union_positional(parts).count() == obs.count()


def test_collect_pandas(spark):
    assert list(sinks.collect_pandas(spark.range(10))["id"]) == list(range(10))


def test_collected_in_batches_under_a_small_result_size(scratch):
    # the whole result is larger than the driver takes at once (its own session: the limit is read when it starts)
    code = """
import sys
sys.path.insert(0, %r)
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from skymetrics.sources import sinks
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.maxResultSize", "1m")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
df = spark.range(0, 400000, 1, 200).selectExpr("id", "sha2(cast(id as string), 256) AS text", "array(id, NULL) AS list", "named_struct('a', id) AS s")
try:
    df.collect()
except Exception as e:
    assert "maxResultSize" in str(e)
else:
    raise AssertionError("the limit does not hold")
writer = pq.ParquetWriter(sys.argv[1], sinks.to_arrow_schema(df.schema))
sizes = []
def take(table):
    sizes.append(table.num_rows)
    writer.write_table(table)
assert sinks.collect_into(df, take, rows=7000) == 400000
writer.close()
assert max(sizes) == 7000
back = pq.read_table(sys.argv[1])
assert back.column("id").to_pylist() == list(range(400000)) and back.slice(5, 1).to_pylist()[0]["list"] == [5, None]
assert list(sinks.collect_batches(df.limit(0))) == []
print("done")
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, os.path.join(scratch, "out.parquet")], capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("done"), done.stderr[-2000:]


def test_missing_files_checks_every_day_of_the_landing_layout(spark, scratch):
    from skymetrics.operators import coverage

    line = ["2024-01-01T00:00,1,2,0,0,3,4,1000"]
    for d in ("2024-01-01", "2024-01-02", "2024-01-05"):
        _land(scratch, "Gran Canaria", 27.9545, -15.592, d, line)
    for d in ("2024-01-01", "2024-01-03"):
        _land(scratch, "El Hierro", 27.7406, -18.0204, d, line)
    # a stray file that names no day is listed but never counts as landed
    with open(os.path.join(scratch, "weather_data_hourly_El Hierro_27.7406_-18.0204", "notes.csv"), "w") as f:
        f.write("x\n")
    files = csv_files.landed_files(spark, scratch)
    assert files.count() == 6
    gaps = coverage.missing_files(files)
    assert rows(gaps) == [
        ("El Hierro", dt.date(2024, 1, 2)),
        ("Gran Canaria", dt.date(2024, 1, 3)),
        ("Gran Canaria", dt.date(2024, 1, 4)),
    ]
    # interior gaps are found even when both ends of the range are landed
    fixed = coverage.missing_files(files, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert rows(fixed) == [("El Hierro", dt.date(2024, 1, 2))]


def test_landed_files_of_partitioned_layout(spark, scratch):
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Time").isNotNull())
    out = os.path.join(scratch, "landed")
    sinks.write_daily_csv(obs, out)
    files = csv_files.landed_files(spark, out)
    days = obs.select("Station", F.to_date("Time").alias("Date")).distinct()
    assert rows(files.select("Station", "Date")) == rows(days)


def test_daily_csv_keeps_seconds_copies_and_other_stations(spark, scratch):
    out = os.path.join(scratch, "landed")
    obs = fixture.observations(spark, SF_SMALL)
    first = obs.filter("Station = 'click'")
    copies = first.limit(1).withColumn("copy", F.explode(F.array_repeat(F.lit(1), 300))).select(obs.columns)
    sinks.write_daily_csv(first.unionByName(copies), out)
    at = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:30' AS Time UNION ALL SELECT TIMESTAMP_NTZ '2024-01-01 01:00:00.25' UNION ALL SELECT NULL")
    other = at.select(F.lit("Z").alias("Station"), "Time", *[F.lit(1).cast(obs.schema[c].dataType).alias(c) for c in obs.columns[2:]])
    sinks.write_daily_csv(other, out)  # leaves the station that was landed before
    back = csv_files.load_observations(spark, out)
    assert rows(back) == rows(first.unionByName(copies).unionByName(other).select(back.columns))


def test_files_are_listed_once(spark, scratch):
    for station in ("A", "B", "C"):
        for day in (1, 2):
            _land(scratch, station, 1, 2, f"2024-01-0{day}", [f"2024-01-0{day}T00:00,1,2,0,0,3,4,1000"])
    folders = sorted(os.path.join(scratch, d) for d in os.listdir(scratch))
    sc, key = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.threshold"

    def jobs(group, run):
        sc.setJobGroup(group, group)
        try:
            return run(), len(sc.statusTracker().getJobIdsForGroup(group))
        finally:
            sc._jsc.clearJobGroup()

    def guard():
        return files.agg(F.count(F.lit(1)), F.collect_list(F.when(F.col("length") > 1, F.col("path")))).first()

    before = spark.conf.get(key)
    spark.conf.set(key, "0")  # each listing is a job or more
    try:
        files, listing = jobs("listing", lambda: spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.csv").load(folders))
        _, counting = jobs("counting", guard)
        found, reading = jobs("reading", lambda: csv_files.load_observations(spark, folders))
    finally:
        spark.conf.set(key, before)
    assert listing > 0 and reading == listing + counting
    assert sorted((r.Station, r.Time.day) for r in found.collect()) == [(s, d) for s in "ABC" for d in (1, 2)]


def test_read_by_layout_stacks_files_by_name(spark, scratch):
    for d, t in (("2024-01-01", "1.5"), ("2024-01-02", "2.5")):
        _land(scratch, "A", 1, 2, d, [f"{d}T00:00,{t},80"], header="Time,Temperature,Humidity")
    for d, t in (("2024-01-03", "3.5"), ("2024-01-04", "bad")):
        _land(scratch, "B", 1, 2, d, [f"{d}T00:00,{t},1001", f"{d}T01:00,4.5,1002"], header="Time,Temperature,Pressure")
    headers = csv_files.read_lines(spark, scratch).select("SourceFile", "Names").distinct()
    assert sorted(r.Names for r in headers.collect()) == [["Time", "Temperature", "Humidity"]] * 2 + [["Time", "Temperature", "Pressure"]] * 2
    df = csv_files.read_by_layout(spark, scratch)
    assert set(df.columns) == {"SourceFile", "Time", "Temperature", "Humidity", "Pressure"}
    got = sorted((r.Time.day, r.Time.hour, r.Temperature, r.Humidity, r.Pressure) for r in df.collect())
    assert got == [(1, 0, 1.5, 80.0, None), (2, 0, 2.5, 80.0, None), (3, 0, 3.5, None, 1001.0),
                   (3, 1, 4.5, None, 1002.0), (4, 0, None, None, 1001.0), (4, 1, 4.5, None, 1002.0)]
    plan = csv_files.read_by_layout(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "Exchange" not in plan  # lines are read once, cut next to their header


def test_read_by_layout_quotes_rejects_and_many_layouts(spark, scratch):
    for i in range(40):
        _land(scratch, "A", 1, 2, f"2024-02-{i:02d}", [f"2024-01-01T00:00,{i},x"], header=f"Time,Temperature,Extra{i}")
    _land(scratch, "B", 1, 2, "2024-01-01", ['2024-01-02T00:00,"7.5","a ""b"", c"', "2024-01-02T01:00,8", "2024-01-02T02:00,bad,"],
          header='"Time","Temperature","Note, free"')
    df, rejects = csv_files.read_by_layout_with_rejects(spark, scratch)
    assert df.count() == 42 and len(df.columns) == 3 + 41
    got = df.filter(F.col("SourceFile").contains("_B_")).orderBy("Time").collect()
    assert [(r.Temperature, r["Note, free"]) for r in got] == [(7.5, 'a "b", c'), (None, None)]
    assert sorted(r.BadColumns for r in rejects.collect()) == [["Temperature"], ["cell count"]]
    strict, _ = csv_files.read_by_layout_with_rejects(spark, scratch, on_bad="reject")
    assert strict.count() == 41


def test_header_only_files_are_input_not_missing(spark, scratch):
    _land(scratch, "Tenerife", 28.2916, -16.6291, "2024-01-01", [])
    assert csv_files.read_text(spark, scratch).count() == 0


def test_malformed_rows_and_missing_value_tokens(spark, scratch):
    _land(scratch, "Tenerife", 28.2916, -16.6291, "2024-03-31", [
        "2024-03-31T00:00,10.5,null,N/A,None,nan,NaN,1018.2",  # no values, but no bad ones
        "2024-03-31T01:00,10,80",                              # too few cells
        "2024-03-31T02:00,10,80,0,1,5,10,1000,7,8",            # too many
        "2024-03-31T03:00,Infinity,80,0,1,5,10,1000",
        "2024-03-31T04:00,10,80,0,1e12,5,10,1000",             # no code
        "2024-03-31T05:00,10,80,0,3.7,5,10,1000",
    ])
    good, rejects = csv_files.load_with_rejects(spark, scratch)
    [row] = good.collect()
    assert (row.Temperature, row.Humidity, row.WeatherCode, row.WindSpeed, row.Pressure) == (10.5, None, None, None, 1018.2)
    assert sorted(r.BadColumns for r in rejects.collect()) == [
        ["Temperature"], ["WeatherCode"], ["WeatherCode"], ["cell count"], ["cell count"]]


@pytest.mark.parametrize("limit", [csv_files.WHOLE_FILE_BYTES, 10])  # files taken whole, or split
def test_columns_are_bound_by_each_file_s_header(spark, scratch, monkeypatch, limit):
    monkeypatch.setattr(csv_files, "WHOLE_FILE_BYTES", limit)
    _land(scratch, "Tenerife", 28.2916, -16.6291, "2024-01-01", ["2024-01-01T00:00,10.5,80,0.2,61,5.1,350,1018.2"])
    _land(scratch, "Tenerife", 28.2916, -16.6291, "2024-01-02", ["2024-01-02T00:00,80,10.5,x", "2024-01-02T01:00,81,11.5"],
          header="Time,Humidity,Temperature,Note")
    _land(scratch, "Gran Canaria", 28.0, -15.6, "2024-01-03", ['1001.5,"2024-01-03T00:00"', "", "bad,2024-01-03T01:00"], header='\ufeff"Pressure", Time ')
    _land(scratch, "Gran Canaria", 28.0, -15.6, "2024-01-04", ["2024-01-04T00:00,1"], header="When,Temperature")
    _land(scratch, "Gran Canaria", 28.0, -15.6, "2024-01-05", [])
    rows_, rejects = csv_files.load_with_rejects(spark, scratch)
    got = sorted((r.Time.day, r.Station, r.Temperature, r.Humidity, r.Pressure, r.WeatherCode) for r in rows_.collect())
    assert got == [(1, "Tenerife", 10.5, 80.0, 1018.2, 61), (2, "Tenerife", 10.5, 80.0, None, None), (3, "Gran Canaria", None, None, 1001.5, None)]
    assert sorted(r.BadColumns for r in rejects.collect()) == [["Pressure"], ["cell count"], ["header"]]
    kept = csv_files.load_observations(spark, scratch, on_bad="null")
    assert sorted((r.Time.day, r.Time.hour, r.Pressure) for r in kept.collect()) == [(1, 0, 1018.2), (2, 0, None), (3, 0, 1001.5), (3, 1, None)]
    once, bad = csv_files.load_once(spark, scratch)
    assert rows(once) == rows(rows_) and sorted(r.BadColumns for r in bad.collect()) == [["Pressure"], ["cell count"], ["header"]]
    assert {r.SourceFile for r in bad.collect()} == {r.SourceFile for r in rejects.collect()}
    layout = csv_files.read_by_layout(spark, scratch)
    assert {"Time", "Note", "When", "Pressure"} <= set(layout.columns) and layout.count() == 5


def test_cells_of_a_line(spark):
    lines = {"a,b,c": ["a", "b", "c"], "": [""], ",,": ["", "", ""], ' a ,"b, ""c""", "d" ': ["a", 'b, "c"', "d"], '"": [""]'[:2]: [""],
             '"a,b"': ["a,b"], 'it\'s 5" wide,x': None, '"never closed,x': None, "x" * 100_000 + "," + '"y,z",' * 20_000: None}
    df = spark.createDataFrame([(k,) for k in lines], "Line string").select("Line", csv_files.cells(F.col("Line")).alias("c"))
    got = {r.Line: r.c for r in df.collect()}
    assert all(got[k] == v for k, v in lines.items() if v is not None)
    assert len(got["x" * 100_000 + "," + '"y,z",' * 20_000]) == 20_002
