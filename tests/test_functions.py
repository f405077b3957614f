"""Column helpers: exact sums, unit and time conversions, display, calendar."""

import datetime as dt

from pyspark.sql import functions as F

from skymetrics.functions import calendar, display, units
from skymetrics.functions.stats import exact_mean, exact_sum, total


def test_exact_sums_do_not_depend_on_order(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1e-2] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(7).agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()[0]
    b = df.coalesce(1).agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()[0]
    assert a == b
    assert a.s == 3.07


def test_sum_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    r = df.agg(exact_sum("x").alias("s"), total("x").alias("t"), exact_mean("x").alias("m")).collect()[0]
    assert r.s is None and r.t == 0.0 and r.m is None


def test_large_and_small_values_are_summed_exactly(spark):
    import random
    from decimal import Decimal

    r = random.Random(11)
    vals = [0.1, -0.1, 2.5e-7, 1e-12, 4.000000000001, 12345678901.25, 9e15, -9e15, 3e20, -3e20, 1e9 + 0.7] * 9
    vals += [round(r.uniform(-1e10, 1e10), r.randrange(8)) for _ in range(500)] + [None]
    exact = sum(Decimal(repr(v)) for v in vals if v is not None)
    for parts in (1, 7):
        r.shuffle(vals)
        row = spark.createDataFrame([(v,) for v in vals], "x double").repartition(parts).agg(
            exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()
        assert row.s == float(exact) and row.m == float(exact) / (len(vals) - 1)


def test_parts_merge_to_the_same_sum(spark):
    from skymetrics.functions.stats import exact_parts, merged, total_of

    df = spark.range(10_000).selectExpr("id % 13 AS k", "CASE WHEN id % 5 = 0 THEN id / 7e3 ELSE id / 100 END AS x")
    parts = df.groupBy("k").agg(exact_parts("x").alias("s"))
    assert parts.schema["s"].dataType.simpleString() == "decimal(36,12)"
    assert parts.agg(total_of(merged("s"))).first()[0] == df.agg(total("x")).first()[0]


def test_sums_stay_in_generated_code(spark):
    plan = spark.range(9).selectExpr("id / 10 AS x").agg(exact_sum("x"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 2 and "SortAggregate" not in plan


def test_opposite_winds_cancel(spark):
    from skymetrics.operators.daily import dominant_direction

    df = spark.createDataFrame([(1, 7.0, 33.0), (1, 7.0, 213.0), (1, 2.0, 90.0), (2, 5.0, 0.0), (2, 5.0, 180.0), (3, 1e-7, 270.0)],
                               "day int, WindSpeed double, WindDirection double")
    got = {r.day: r.d for r in df.groupBy("day").agg(dominant_direction().alias("d")).collect()}
    assert got == {1: 90.0, 2: 0.0, 3: 270.0}


def test_unit_conversions(spark):
    r = spark.range(1).select(
        units.celsius_to_fahrenheit(F.lit(100.0)).alias("f"),
        units.kmh_to_ms(F.lit(36.0)).alias("ms"),
        units.kmh_to_knots(F.lit(1.852)).alias("kn"),
        units.kmh_to_mph(F.lit(1.609344)).alias("mph"),
        units.mm_to_inch(F.lit(25.4)).alias("inch"),
    ).collect()[0]
    assert (r.f, r.ms, r.kn, r.mph, r.inch) == (212.0, 10.0, 1.0, 1.0, 1.0)


def test_epoch_round_trip_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Atlantic/Canary")
        df = spark.createDataFrame([(1711846800, 3600)], "e long, off int")  # 2024-03-31T01:00Z
        r = df.select(units.local_time("e", "off").alias("t")).collect()[0]
        assert r.t == dt.datetime(2024, 3, 31, 2, 0)
        back = df.select(units.epoch_seconds(units.local_time("e", "off"), "off").alias("b")).collect()[0]
        assert back.b == 1711846800
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dst_gap_label_kept(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Atlantic/Canary")
        df = spark.createDataFrame([("2024-03-31T01:30",), ("garbage",)], "t string")
        out = calendar.with_calendar(df.withColumn("T", calendar.parse_time("t")), "T").collect()
        assert out[0].Hour == 1 and out[0].Date == dt.date(2024, 3, 31)
        assert out[1].T is None and out[1].Hour is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_text_helpers(spark):
    r = spark.range(1).select(
        calendar.date_text(F.lit("2024-03-01T05:00")).alias("d"),
        calendar.iso_date(F.lit(dt.date(2024, 3, 1))).alias("i"),
        calendar.days_before(F.lit(dt.date(2025, 5, 3)), 3650).alias("b"),
    ).collect()[0]
    assert (r.d, r.i, r.b) == ("2024-03-01", "2024-03-01", dt.date(2015, 5, 6))


def test_display_one_decimal(spark):
    df = spark.createDataFrame([(21.04, 55.55, 1013.26)], "Temperature double, Humidity double, Pressure double")
    r = display.format_columns(df, {k: display.SUFFIX[k] for k in df.columns}).collect()[0]
    assert (r.Temperature, r.Humidity, r.Pressure) == ("21.0°C", "55.6%", "1013.3 hPa")


def test_fine_values_are_summed_as_they_are(spark):
    from skymetrics.functions.stats import exact_mean, total

    inches = spark.createDataFrame([(0.1 / 25.4,)] * 24, "p double")
    row = inches.agg(total("p").alias("t"), exact_mean("p").alias("m")).first()
    assert abs(row.t - 24 * 0.1 / 25.4) < 1e-10 and abs(row.m - 0.1 / 25.4) < 1e-12
    means = spark.createDataFrame([(1.004,), (1.004,)], "x double").agg(exact_mean("x").alias("m")).first()
    assert means.m == 1.004
