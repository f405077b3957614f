"""Operator semantics on tiny hand-written frames and invariants on the fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skymetrics.functions.calendar import with_calendar
from skymetrics.operators import aggregates as A
from skymetrics.operators import coverage, daily, prepare
from skymetrics.schema import OBSERVATION
from skymetrics.sources import fixture

from .conftest import SF_SMALL


def T(d, h=0):
    return dt.datetime(2024, 1, 1, h) + dt.timedelta(days=d)


@pytest.fixture()
def tiny(spark):
    data = [
        ("S", T(0, 0), 10.0, 80.0, 0.0, 0, 10.0, 90.0, 1010.0),
        ("S", T(0, 1), 12.0, None, 0.5, 61, 20.0, 90.0, None),
        ("S", T(0, 2), None, 70.0, 0.2, 63, None, None, 1012.0),
        ("S", T(1, 0), 14.0, 60.0, 0.0, 1, 10.0, 180.0, 1014.0),
        ("S", T(40, 0), 5.0, 50.0, None, 2, 5.0, 270.0, 1000.0),   # February: no rain values at all
        ("R", T(0, 0), 1.0, 1.0, 1.0, 0, 1.0, 90.0, 1.0),
    ]
    return with_calendar(spark.createDataFrame(data, OBSERVATION))


def _by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_monthly_summary_skips_nulls(tiny):
    m = _by(A.monthly_summary(tiny), "Station", "Month")
    jan = m[("S", 1)]
    assert jan.AvgTemperature == 12.0 and jan.MinTemperature == 10.0 and jan.MaxTemperature == 14.0
    assert jan.AvgHumidity == 70.0
    assert jan.AvgPressure == 1012.0
    assert jan.TotalPrecipitation == pytest.approx(0.7)
    feb = m[("S", 2)]
    assert feb.TotalPrecipitation == 0.0  # sum over no values is 0, not NULL


def test_rainy_days_count_distinct_dates(tiny):
    p = _by(A.monthly_precipitation(tiny), "Station", "Month")
    assert p[("S", 1)].RainyDays == 1  # two rainy hours on the same day
    assert p[("S", 2)].RainyDays == 0
    j = _by(A.monthly_precipitation_join(tiny), "Station", "Month")
    assert {k: (r.TotalPrecipitation, r.RainyDays) for k, r in j.items()} == \
        {k: (r.TotalPrecipitation, r.RainyDays) for k, r in p.items()}


def test_wind_order_and_null_direction(tiny):
    w = A.wind_by_direction(tiny).collect()
    s = [r for r in w if r.Station == "S"]
    assert [r.WindDirection for r in s] == [90.0, 180.0, 270.0]  # count desc, then direction
    assert s[0].Count == 2 and s[0].AvgWindSpeed == 15.0
    assert all(r.WindDirection is not None for r in w)
    assert sum(r.Count for r in A.wind_rose(tiny).collect()) == tiny.filter("WindDirection IS NOT NULL").count()


def test_zero_fill_policy_differs_only_where_null(tiny):
    kept = _by(A.monthly_summary(tiny), "Station", "Month")
    filled = _by(A.monthly_summary(prepare.fill_zero(tiny)), "Station", "Month")
    assert filled[("S", 1)].MinPressure == 0.0 and kept[("S", 1)].MinPressure == 1010.0
    assert filled[("R", 1)] == kept[("R", 1)]  # no NULLs, same result


def test_period_filter_and_kpis(tiny):
    k = A.period_kpis(prepare.for_period(tiny, 2024, 1, "S")).collect()[0]
    assert k.RainyHours == 2
    assert k.MaxTemperature == 14.0
    assert k.AvgWindSpeed == pytest.approx(40 / 3)


def test_daily_dominant_direction(spark):
    data = [("S", T(0, h), 1.0, 1.0, 0.0, 0, 10.0, d, 1.0) for h, d in enumerate([350.0, 10.0])]
    df = with_calendar(spark.createDataFrame(data, OBSERVATION))
    r = daily.daily_wind_direction(df).collect()[0]
    assert r.DominantWindDirection == 0.0  # vector mean of 350 and 10, not 180


def test_coverage_finds_interior_gaps(tiny):
    gaps = coverage.missing_days(tiny.select("Station", "Time"))
    missing = sorted(r.Date for r in gaps.filter("Station = 'S'").collect())
    assert missing[0] == dt.date(2024, 1, 3) and missing[-1] == dt.date(2024, 2, 9)
    assert len(missing) == 38
    full = coverage.is_complete(tiny, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert _by(full, "Station")[("S",)].Complete is True
    assert _by(full, "Station")[("R",)].MissingDays == 1


def test_fixture_invariants(spark):
    obs = with_calendar(fixture.observations(spark, SF_SMALL))
    m = A.monthly_summary(obs).collect()
    for r in m:
        for x in ("Temperature", "Humidity", "Pressure"):
            assert r[f"Min{x}"] <= r[f"Avg{x}"] <= r[f"Max{x}"]
        assert 0 <= r.MinHumidity and r.MaxHumidity <= 100
        assert r.TotalPrecipitation >= 0
    # A3 == A9, A12 is a projection of A13
    a3 = _by(A.monthly_precipitation(obs), "Station", "Year", "Month")
    a9 = _by(A.monthly_precip_series(obs), "Station", "Year", "Month")
    assert {k: r.TotalPrecipitation for k, r in a3.items()} == {k: r.Precipitation for k, r in a9.items()}
    a12 = _by(A.monthly_summary_narrow(obs), "Station", "Year", "Month")
    a13 = _by(A.monthly_summary(obs), "Station", "Year", "Month")
    for k, r in a12.items():
        assert (r.AvgTemperature, r.AvgHumidity, r.AvgPressure) == (a13[k].AvgTemperature, a13[k].AvgHumidity, a13[k].AvgPressure)
    # rainy days never exceed the days in the month; daily totals add up to the month
    import calendar as cal

    for (_, y, mo), r in a3.items():
        assert 0 <= r.RainyDays <= cal.monthrange(y, mo)[1]
    # the wind rose counts every row with a direction, once
    rose = A.wind_rose(obs).groupBy("Station").agg(F.sum("Count").alias("n")).collect()
    directed = obs.filter(F.col("WindDirection").isNotNull()).groupBy("Station").count().collect()
    assert {r.Station: r.n for r in rose} == {r.Station: r["count"] for r in directed}
    d = A.daily_precipitation(obs).groupBy("Station", F.year("Date").alias("Y"), F.month("Date").alias("M")) \
        .agg(F.sum("Precipitation").alias("P")).collect()
    for r in d:
        assert r.P == pytest.approx(a3[(r.Station, r.Y, r.M)].TotalPrecipitation)


def test_coverage_matches_calendar_minus_landed(spark):
    # brute force over a small fixture: every (station, day) of the range that has no row
    import random

    rng = random.Random(7)
    base = dt.date(2024, 1, 1)
    landed = {s: sorted({base + dt.timedelta(days=rng.randrange(60)) for _ in range(25)}) for s in "ABC"}
    landed["D"] = [dt.date(2023, 6, 1), dt.date(2024, 9, 1)]  # every day of the range falls between these two
    data = [(s, dt.datetime(d.year, d.month, d.day, h)) for s, ds in landed.items() for d in ds for h in (0, 5)]
    obs = spark.createDataFrame(data, "Station string, Time timestamp_ntz")
    for start, end in ((None, None), (dt.date(2024, 1, 10), dt.date(2024, 2, 20)), (dt.date(2023, 12, 1), dt.date(2024, 3, 31))):
        got = sorted((r.Station, r.Date) for r in coverage.missing_days(obs, start, end).collect())
        want = []
        for s, ds in landed.items():
            lo, hi = start or ds[0], end or ds[-1]
            want += [(s, lo + dt.timedelta(days=i)) for i in range((hi - lo).days + 1)
                     if lo + dt.timedelta(days=i) not in set(ds)]
        assert got == sorted(want), (start, end)
        if start is not None:
            per = {r.Station: r.MissingDays for r in coverage.is_complete(obs, start, end).collect()}
            assert per == {s: sum(1 for x, _ in want if x == s) for s in landed}


def test_results_come_back_in_key_order(spark):
    # O1-O3: the collected rows are already sorted by the table's keys
    obs = with_calendar(fixture.observations(spark, SF_SMALL))
    checks = [
        (A.monthly_summary(obs), lambda r: (r.Station, r.Year, r.Month)),
        (A.monthly_precipitation_join(obs), lambda r: (r.Station, r.Year, r.Month)),
        (A.hourly_profile(obs, "Humidity"), lambda r: (r.Station, r.Hour)),
        (A.daily_precipitation(obs), lambda r: (r.Station, r.Date)),
        (A.available_periods(obs), lambda r: (r.Station, r.Year, r.Month)),
        (A.wind_rose(obs), lambda r: (r.Station, r.WindDirection)),
        (A.wind_by_direction(obs), lambda r: (r.Station, -r.Count, r.WindDirection)),
    ]
    for df, key in checks:
        got = df.collect()
        assert len(got) > 1
        assert got == sorted(got, key=key)


def test_coverage_lists_stations_that_never_landed(spark):
    obs = spark.sql("SELECT 'A' AS Station, TIMESTAMP_NTZ '2024-01-01 05:00:00' AS Time")
    expected = spark.sql("SELECT explode(array('A', 'B')) AS Station")
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    second = dt.date(2024, 1, 2)
    gaps = coverage.missing_days(obs, start, end, expected)
    assert sorted(tuple(r) for r in gaps.collect()) == [("A", second), ("B", start), ("B", second)]
    per = {r.Station: (r.MissingDays, r.Complete) for r in coverage.is_complete(obs.limit(0), start, end, expected).collect()}
    assert per == {"A": (2, False), "B": (2, False)}
    with pytest.raises(ValueError):
        coverage.missing_days(obs, stations=expected)


def test_missing_hours_equal_brute_force(spark):
    import random

    from skymetrics.operators import coverage

    rng = random.Random(5)
    base = dt.datetime(2024, 2, 20)
    landed = {(s, base + dt.timedelta(hours=rng.randrange(24 * 20), minutes=rng.randrange(60))) for s in "AB" for _ in range(200)}
    full = {("C", dt.datetime(2024, 2, 25, h)) for h in range(24)}
    obs = spark.createDataFrame([*landed, *full, ("A", None)], "Station string, Time timestamp_ntz")
    have = {(s, t.date(), t.hour) for s, t in landed | full}

    def want(first, last, stations):
        out = set()
        for s in stations:
            days = [d for x, d, _ in have if x == s]
            a, b = first or min(days), last or max(days)
            out |= {(s, a + dt.timedelta(days=i), h) for i in range((b - a).days + 1) for h in range(24)} - have
        return sorted(out)

    def got(*args):
        return sorted((r.Station, r.Date, r.Hour) for r in coverage.missing_hours(obs, *args).collect())

    assert got() == want(None, None, "ABC")
    a, b = dt.date(2024, 2, 18), dt.date(2024, 3, 2)
    assert got(a, b) == want(a, b, "ABC")
    assert got(a, b, spark.createDataFrame([("A",), ("D",)], "Station string")) == want(a, b, "AD")
    days = {(r.Station, r.Date): (r.Hours, r.Complete) for r in coverage.hour_coverage(coverage.hour_masks(obs)).collect()}
    assert days[("C", dt.date(2024, 2, 25))] == (24, True)
    assert all(n == len({h for s, d, h in have if (s, d) == k}) for k, (n, _) in days.items())
    # masks of parts unite to that of the whole
    parts = coverage.hour_masks(obs.filter("hour(Time) < 9")).unionByName(coverage.hour_masks(obs.filter("hour(Time) >= 9")))
    whole = parts.groupBy("Station", "Date").agg(F.bit_or("HourMask").alias("HourMask"))
    assert sorted(whole.collect()) == sorted(coverage.hour_masks(obs).collect())


def test_rainy_days_take_one_exchange(spark):
    obs = with_calendar(fixture.observations(spark, SF_SMALL))
    for df in (A.monthly_precipitation(obs, ordered=False), A.monthly_precipitation_join(obs, ordered=False)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "Join" not in plan
