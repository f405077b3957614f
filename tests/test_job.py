"""The processor job: landing folder -> every dashboard table and the per-station report."""

import os

from pyspark.sql import functions as F

from skymetrics.functions.calendar import with_calendar
from skymetrics.operators import aggregates as A
from skymetrics.plans import dashboard as D
from skymetrics.plans import job
from skymetrics.sources import fixture, sinks

from .conftest import SF_SMALL, rows


def test_process_landing_writes_every_table(spark, scratch):
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Time").isNotNull())
    landing = os.path.join(scratch, "landing")
    sinks.write_daily_csv(obs, landing)
    out = os.path.join(scratch, "out")
    paths = job.process_landing(spark, landing, out)
    agg = D.aggregate(with_calendar(obs))
    assert set(paths) == set(D.tables(agg)) | set(D.daily_tables(agg)) | {job.REPORT, job.REJECTS}
    assert spark.read.parquet(paths[job.REJECTS]).count() == 0

    # the landed rows carry minute precision; the job's tables equal the direct operators on them
    landed = with_calendar(obs.withColumn("Time", F.date_trunc("minute", "Time").cast("timestamp_ntz")))
    got = spark.read.parquet(paths["monthly_summary"])
    want = A.monthly_summary(landed, ordered=False)
    assert rows(got.select(want.columns)) == rows(want)
    got = spark.read.parquet(paths["wind_by_direction"])
    want = A.wind_by_direction(landed, ordered=False)
    assert rows(got.select(want.columns)) == rows(want)

    # one report file per station, the saved report's header, months in order
    for station in fixture.FIXTURE_STATIONS:
        d = os.path.join(paths[job.REPORT], f"Station={station}")
        files = [f for f in os.listdir(d) if f.endswith(".csv")]
        assert len(files) == 1
        with open(os.path.join(d, files[0]), encoding="utf-8") as f:
            lines = f.read().splitlines()
        assert lines[0].startswith("Año,Mes,Temp Prom,Temp Min,Temp Max,Humedad Prom")
        months = [tuple(int(x) for x in line.split(",")[:2]) for line in lines[1:]]
        assert months == sorted(months) and len(months) > 1


def test_job_command_line(spark, scratch, capsys):
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Station") == "click")
    landing = os.path.join(scratch, "landing")
    sinks.write_daily_csv(obs, landing)
    out = os.path.join(scratch, "out")
    job.main([landing, out, "--fill-zero"])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert printed[job.REPORT] == os.path.join(out, job.REPORT)
    filled = spark.read.parquet(printed["monthly_summary"])
    # zero-fill policy: a missing pressure counts as 0 hPa in the minimum
    assert filled.agg(F.min("MinPressure")).first()[0] == 0.0


def test_job_writes_rejects(spark, scratch):
    landing = os.path.join(scratch, "landing")
    d = os.path.join(landing, "weather_data_hourly_Tenerife_28.2916_-16.6291")
    os.makedirs(d)
    with open(os.path.join(d, "weather_2024-01-01.csv"), "w") as f:
        f.write("Time,Temperature,Humidity,Precipitation,WeatherCode,WindSpeed,WindDirection,Pressure\n"
                "2024-01-01T00:00,10.5,80,0.2,61,5.1,350,1018.2\n"
                "2024-01-01T01:00,abc,80,0.0,3,5.0,10,1018.0\n")
    paths = job.process_landing(spark, landing, os.path.join(scratch, "out"))
    bad = spark.read.parquet(paths[job.REJECTS]).collect()
    assert [list(r.BadColumns) for r in bad] == [["Temperature"]]
    assert spark.read.parquet(paths["monthly_summary"]).first().AvgTemperature == 10.5
