"""The single-scan dashboard equals the per-table operators, table by table."""

import os

import pytest

from skymetrics.operators import aggregates as A
from skymetrics.operators import daily
from skymetrics.plans import catalog
from skymetrics.plans import dashboard as D

from .conftest import SF_SMALL, rows

DIRECT = {
    "monthly_temperature": A.monthly_temperature,
    "monthly_precipitation": A.monthly_precipitation,
    "monthly_pressure": A.monthly_pressure,
    "wind_by_direction": A.wind_by_direction,
    "hourly_temperature": lambda o: A.hourly_profile(o, "Temperature"),
    "hourly_humidity": lambda o: A.hourly_profile(o, "Humidity"),
    "hourly_pressure": lambda o: A.hourly_profile(o, "Pressure"),
    "monthly_precip_series": A.monthly_precip_series,
    "wind_rose": A.wind_rose,
    "monthly_summary_narrow": A.monthly_summary_narrow,
    "monthly_summary": A.monthly_summary,
    "daily_summary": daily.daily_summary,
}


DAILY = {
    "daily_precipitation": A.daily_precipitation,
    "daily_weather_code": daily.daily_weather_code,
    "daily_wind_direction": daily.daily_wind_direction,
}


@pytest.fixture(scope="module")
def agg(spark):
    return D.materialize(D.aggregate(catalog.obs(spark, SF_SMALL)))


@pytest.mark.parametrize("name", sorted(DIRECT))
def test_table_equals_direct_operator(spark, agg, name):
    obs = catalog.obs(spark, SF_SMALL)
    got = D.tables(agg)[name]
    want = DIRECT[name](obs)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(want.columns)) == rows(want)


def test_one_scan(spark):
    plan = D.aggregate(catalog.obs(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1


def test_materialized_in_checkpoint_folder(spark, agg):
    files = agg.inputFiles()
    ckpt = spark.sparkContext.getCheckpointDir()
    assert files and all(f.startswith(ckpt.rstrip("/")) or ckpt.replace("file:", "") in f for f in files)


def test_run_all_returns_every_table(spark):
    out = D.run_all(spark, SF_SMALL)
    assert set(out) == set(DIRECT)
    assert all(len(v) > 0 for v in out.values())


@pytest.mark.parametrize("name", sorted(DAILY))
def test_daily_table_equals_direct_operator(spark, agg, name):
    obs = catalog.obs(spark, SF_SMALL)
    got = D.daily_tables(agg)[name]
    want = DAILY[name](obs)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(want.columns)) == rows(want)
