"""Incremental landing: only new files are processed, rows match the batch reader."""

import os

from skymetrics.schema import CSV_COLUMNS
from skymetrics.sources import csv_files
from skymetrics.streaming import landing

from .conftest import rows

HEADER = ",".join(CSV_COLUMNS)


def _land(root, station, date, lines):
    d = os.path.join(root, f"weather_data_hourly_{station}_28.1_-17.1")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"weather_{date}.csv"), "w") as f:
        f.write(HEADER + "\n" + "\n".join(lines) + "\n")


def test_compaction_is_incremental(spark, scratch):
    src, table, ckpt, rej = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt", "rejects"))
    _land(src, "La Gomera", "2024-01-01", [f"2024-01-01T{h:02d}:00,{h}.5,70,0,1,5,10,1010" for h in range(24)])
    landing.start_ingest(spark, src, table, ckpt, rej).awaitTermination()
    assert spark.read.parquet(table).count() == 24

    _land(src, "La Gomera", "2024-01-02", [f"2024-01-02T{h:02d}:00,{h}.5,70,0,1,5,10,1010" for h in range(24)]
          + ["bad-time,1,1,1,1,1,1,1"])
    landing.start_ingest(spark, src, table, ckpt, rej).awaitTermination()
    out = spark.read.parquet(table)
    assert out.count() == 48  # the first day was not re-ingested
    assert spark.read.parquet(rej).count() == 1
    batch = csv_files.load_observations(spark, src)
    assert rows(out.select(batch.columns)) == rows(batch)


def test_daily_summary_does_not_depend_on_batches(spark, scratch):
    src = os.path.join(scratch, "landing")
    # the oldest day lands last
    for day in ("2024-01-02", "2024-01-05", "2024-01-01"):
        _land(src, "El Hierro", day, [f"{day}T{h:02d}:00,{h}.0,70,{0.1 if h < 3 else 0},1,{h},10,1010" for h in range(24)])
    _land(src, "El Hierro", "2024-01-01-late", ["2024-01-01T23:30,-5.0,70,0.2,1,99,10,1010"])
    got = []
    for name, files in (("one", 1), ("all", 100)):
        table, ckpt = os.path.join(scratch, name), os.path.join(scratch, f"{name}-ckpt")
        landing.start_daily_summary(spark, src, table, ckpt, max_files_per_trigger=files).awaitTermination()
        got.append(rows(landing.daily_summary_so_far(landing.parts_so_far(spark, table))))
    assert got[0] == got[1] and len(got[0]) == 3
    _, date, warmest, mean, coldest, rain, wet, wind = got[0][0]
    assert (date.isoformat(), warmest, coldest, wet, wind) == ("2024-01-01", 23.0, -5.0, 4, 99.0)
    assert abs(rain - 0.5) < 1e-9 and abs(mean - (276 - 5) / 25) < 1e-6


def _folders(path, prefix):
    return sorted(int(x[len(prefix):]) for x in os.listdir(path) if x.startswith(prefix))


def test_parts_of_old_batches_are_merged(spark, scratch):
    src = os.path.join(scratch, "landing")
    days = ["2024-01-02", "2024-01-05", "2024-01-01", "2024-01-03", "2024-01-02-late", "2024-01-04", "2024-01-01-late", "2024-01-07"]
    for n, day in enumerate(days):
        _land(src, "El Hierro", day, [f"{day[:10]}T{h:02d}:{n:02d},{h + n}.5,70,{0.1 if h < 3 else 0},1,{h},10,1010" for h in range(20)] + ["when,1,1,1,1,1,1,1"])
    seen = []
    for every in (3, 100):
        table, ckpt = (os.path.join(scratch, f"{x}{every}") for x in ("table", "ckpt"))
        landing.start_daily_summary(spark, src, table, ckpt, max_files_per_trigger=1, merge_every=every).awaitTermination()
        parts = landing.parts_so_far(spark, table)
        seen.append([rows(f(parts)) for f in (landing.daily_summary_so_far, landing.monthly_precipitation_so_far,
                                              landing.hour_coverage_so_far, landing.rejects_so_far)])
    assert seen[0] == seen[1] and len(seen[0][0]) == 6
    table = os.path.join(scratch, "table3")
    assert _folders(table, "BatchId=") == [3, 4, 5, 6, 7] and _folders(os.path.join(table, landing.MERGED), "upto-") == [2, 5]


def test_merge_survives_failures(spark, scratch):
    table = os.path.join(scratch, "table")
    schema = ("Station string, Date date, MaxTemperature double, SumTemperature decimal(36,12), Temperatures long, MinTemperature double, "
              "SumPrecipitation decimal(36,12), PrecipitationHours long, MaxWindSpeed double, HourMask long, Rows long, Rejects long")
    part = spark.sql("SELECT 'A', DATE'2024-01-01', 1D, CAST(1 AS DECIMAL(36,12)), 1L, 1D, CAST(0.5 AS DECIMAL(36,12)), 1L, 2D, 1L, 1L, 0L").toDF(*[c.split()[0] for c in schema.split(", ")])
    write = landing.parts_writer(table, 2)

    def total():
        return landing.daily_summary_so_far(landing.parts_so_far(spark, table)).first().TotalPrecipitation

    write(part, 0)
    write(part, 0)  # replayed before a merge
    write(part, 1)
    assert total() == 1.0
    write(part, 1)  # replayed after its merge
    assert total() == 1.0
    # a merge that did not end: files, no commit
    landing.merge_parts(landing.parts_so_far(spark, table)).write.parquet(f"{table}/{landing.MERGED}/upto-3")
    os.remove(f"{table}/{landing.MERGED}/upto-3/_SUCCESS")
    write(part, 2)
    assert total() == 1.5
    write(part, 3)
    assert total() == 2.0
    write(part.limit(0), 4)  # a batch without rows
    write(part.limit(0), 5)
    write(part.limit(0), 6)
    write(part.limit(0), 7)
    assert total() == 2.0


def test_replayed_batch_is_not_written_twice(spark, scratch):
    table = os.path.join(scratch, "table")
    write = landing.batch_writer(table)
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "Station string, Temperature double")
    write(df, 0)
    write(df, 0)  # the same micro-batch replayed after a failure before commit
    write(df.filter("Station = 'A'"), 1)
    out = spark.read.parquet(table)
    assert out.count() == 3
    assert sorted((r.Station, r.BatchId) for r in out.collect()) == [("A", 0), ("A", 1), ("B", 0)]


def test_single_stream_ingest_writes_rows_and_rejects(spark, scratch):
    src, table, ckpt, rej = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt", "rejects"))
    _land(src, "El Hierro", "2024-01-01", [f"2024-01-01T{h:02d}:00,{h}.5,70,0,1,5,10,1010" for h in range(24)]
          + ["2024-01-01T99:00,1,1,1,1,1,1,1"])
    landing.start_ingest(spark, src, table, ckpt, rej).awaitTermination()
    assert spark.read.parquet(table).count() == 24
    _land(src, "El Hierro", "2024-01-02", [f"2024-01-02T{h:02d}:00,{h}.5,70,0,1,5,10,1010" for h in range(24)])
    landing.start_ingest(spark, src, table, ckpt, rej).awaitTermination()
    out = spark.read.parquet(table)
    assert out.count() == 48 and {r.Station for r in out.collect()} == {"El Hierro"}
    bad = spark.read.parquet(rej).collect()
    assert len(bad) == 1 and list(bad[0].BadColumns) == ["Time"]


def test_streams_report_rejects_and_read_files_once(spark, scratch):
    src, table, ckpt, rej = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt", "rejects"))
    good = [f"2024-01-01T{h:02d}:00,{h}.5,70,0,1,5,10,1010" for h in range(3)]
    _land(src, "El Hierro", "2024-01-01", [*good, "2024-01-01T05:00,x,1,1,1,1,1,1", "when,1,1,1,1,1,1,1"])
    _land(src, "El Hierro", "2024-01-02", ["2024-01-02T00:00,1,2"])
    with open(os.path.join(src, "weather_data_hourly_El Hierro_28.1_-17.1", "weather_2024-01-03.csv"), "w") as f:
        f.write("Time,Humidity,Temperature\n2024-01-03T00:00,70,9.5\n")
    parts = os.path.join(scratch, "parts")
    landing.start_daily_summary(spark, src, parts, os.path.join(scratch, "c1"), max_files_per_trigger=1).awaitTermination()
    lost = landing.rejects_so_far(landing.parts_so_far(spark, parts))
    assert sorted((r.Station, str(r.Date), r.Rejects) for r in lost.collect()) == [("El Hierro", "2024-01-01", 2), ("El Hierro", "2024-01-02", 1)]
    days = landing.daily_summary_so_far(landing.parts_so_far(spark, parts))
    assert sorted((str(r.Date), r.MaxTemperature) for r in days.collect()) == [("2024-01-01", 2.5), ("2024-01-03", 9.5)]
    landing.start_ingest(spark, src, table, ckpt, rej, on_bad="null").awaitTermination()
    assert sorted(str(r.Time) for r in spark.read.parquet(table).collect()) == [
        *(f"2024-01-01 0{h}:00:00" for h in (0, 1, 2, 5)), "2024-01-03 00:00:00", "None"]
    assert sorted(tuple(r.BadColumns) for r in spark.read.parquet(rej).collect()) == [("Temperature",), ("Time",), ("cell count",)]
