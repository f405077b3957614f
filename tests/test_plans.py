"""Physical-plan properties that matter at scale, checked on the real plans."""

import re

import pytest

from skymetrics.plans import catalog
from skymetrics.sources import csv_files

from .conftest import SF_SMALL

GROUPED = [
    "monthly_temperature", "monthly_pressure", "monthly_precipitation", "monthly_summary",
    "monthly_summary_narrow", "hourly_temperature", "daily_summary", "wind_by_direction",
    "wind_rose", "daily_wind_direction", "weather_conditions", "lineitem_monthly",
    "dashboard_monthly_summary", "coverage_gaps", "station_overview",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", GROUPED)
def test_aggregates_combine_map_side(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert "partial_" in p or "HashAggregate(keys=" in p
    # algebraic aggregates only: no sort-based or object (collect) aggregation
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_products(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dimension_is_broadcast(spark):
    p = plan(catalog.queries()["weather_conditions"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_period_filter_reaches_scan(spark):
    df = catalog.queries()["period_kpis"](spark, SF_SMALL)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(Station" in p and "= click" in p
    assert "PushedFilters: [IsNotNull(Time), GreaterThanOrEqual(Time" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(catalog.queries()["monthly_temperature"](spark, SF_SMALL))
    assert "ReadSchema: struct<Time:timestamp_ntz,Temperature:double>" in p


def test_landing_path_helpers(spark):
    import datetime as dt
    from pyspark.sql import functions as F

    assert csv_files.landing_dir("Tenerife", 28.2916, -16.6291) == "weather_data_hourly_Tenerife_28.2916_-16.6291"
    assert csv_files.daily_file_name(dt.date(2024, 3, 1)) == "weather_2024-03-01.csv"
    r = spark.createDataFrame([("La Palma", 28.6829, -17.7649, dt.date(2024, 3, 1))],
                              "Station string, Latitude double, Longitude double, Date date")
    got = r.select(csv_files.landing_path_column().alias("p")).first().p
    assert got == "weather_data_hourly_La Palma_28.6829_-17.7649/weather_2024-03-01.csv"
    assert r.select(csv_files.station_from_path(F.lit("file:/x/" + got.replace(" ", "%20"))).alias("s")).first().s == "La Palma"


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_in_plans(spark, name):
    # built-in expressions only: no Python-RDD scan behind a table, no Python UDF evaluation
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert "ExistingRDD" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("name,scan", [("coverage_gaps", "Scan parquet"), ("landed_gaps", "Scan binaryFile")])
def test_coverage_reads_its_input_once(spark, name, scan):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert p.count(scan) == 1
    assert "LeftAnti" not in p


@pytest.mark.parametrize("name", ["json_pivot", "multi_location", "landed_json"])
def test_json_parsed_once_per_document(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    assert p.count("from_json(") + p.count("parseJson(") == 1


@pytest.mark.parametrize("name", ["landed_csv", "landed_headers", "layout_union"])
def test_lines_do_not_move_to_their_header(spark, name):
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(catalog.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    assert "Exchange" not in p and "Join" not in p and p.count("FileScan text") <= 1


@pytest.mark.parametrize("name", ["landed_csv", "landed_list", "landed_headers"])
def test_a_line_carries_neither_its_files_text_nor_unparsed_cells(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    lines = [x for x in p.splitlines() if "Generate explode(" in x]
    # the generator that makes lines of a text hands on the file's name and header, not its text or all its lines
    assert len(lines) == 1 and not re.search(r"\[[^\]]*(_text|_lines|value)#[^\]]*\], true", lines[0])
    # it is no node of generated code, which would collect a file's lines before handing them on
    assert "*(" not in lines[0]
    # header cells come from below it, and each cell is looked at once, whatever filters follow
    assert "regexp_extract" not in p[:p.index("Generate explode(")].replace("/Station=", "").split("Generate inline")[-1]
    assert p.count(" INSET ") == len(csv_files.CSV_COLUMNS)


def test_multi_location_has_no_window_over_days(spark):
    p = plan(catalog.queries()["multi_location"](spark, SF_SMALL))
    assert "Window" not in p and "SortMergeJoin" not in p


def test_csv_validation_stays_in_generated_code(spark):
    p = plan(catalog.queries()["landed_csv"](spark, SF_SMALL))
    # the accepted-rows filter is a codegen node ("*(n) Filter"), not an interpreted one
    assert re.search(r"\*\(\d+\) Filter", p)
    assert "size(filter(" not in p


def test_compacted_observations_are_time_ordered_per_file(spark):
    # row groups then cover time ranges, so pushed Time filters can skip them
    import pyarrow.parquet as pq
    from skymetrics.sources import fixture

    files = fixture.observations(spark, SF_SMALL).inputFiles()
    assert files
    for f in files:
        times = pq.read_table(f.replace("file://", "").replace("file:", ""), columns=["Time"]).column("Time").to_pylist()
        present = [t for t in times if t is not None]
        assert present == sorted(present)
