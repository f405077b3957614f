"""Property tests: exact aggregation does not depend on partitioning, and the
dashboard roll-ups equal the direct operators on arbitrary observations."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skymetrics.functions.calendar import with_calendar
from skymetrics.functions.stats import exact_mean, exact_sum
from skymetrics.operators import aggregates as A
from skymetrics.plans import dashboard as D
from skymetrics.schema import OBSERVATION

from .conftest import rows

cents = st.integers(min_value=-5000, max_value=5000).map(lambda c: c / 100)
maybe = st.one_of(st.none(), cents)

obs_row = st.tuples(
    st.sampled_from(["A", "B"]),
    st.datetimes(min_value=dt.datetime(2024, 1, 1), max_value=dt.datetime(2024, 4, 30)),
    maybe, maybe, st.one_of(st.none(), st.sampled_from([0.0, 0.1, 2.5])),
    st.one_of(st.none(), st.sampled_from([0, 3, 61, 95])),
    maybe, st.one_of(st.none(), st.sampled_from([0.0, 90.0, 180.0, 359.0])), maybe,
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(cents, min_size=1, max_size=60), st.integers(min_value=1, max_value=9))
def test_sum_and_mean_independent_of_partitioning(spark, vals, parts):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(parts).agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()
    b = df.coalesce(1).agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).first()
    assert a == b
    assert round(a.s * 100) == sum(round(v * 100) for v in vals)


@SETTINGS
@given(st.lists(obs_row, min_size=1, max_size=40))
def test_dashboard_rollups_equal_direct(spark, data):
    obs = with_calendar(spark.createDataFrame(data, OBSERVATION))
    agg = D.aggregate(obs)
    assert rows(D.monthly_summary(agg)) == rows(A.monthly_summary(obs, ordered=False))
    assert rows(D.monthly_precipitation(agg)) == rows(A.monthly_precipitation(obs, ordered=False))
    assert rows(D.wind_by_direction(agg)) == rows(A.wind_by_direction(obs, ordered=False))
    assert rows(D.hourly_profile(agg, "Pressure")) == rows(A.hourly_profile(obs, "Pressure", ordered=False))


day_offsets = st.lists(st.integers(min_value=0, max_value=90), min_size=1, max_size=20)


@SETTINGS
@given(a=day_offsets, b=day_offsets, lo=st.integers(0, 60), span=st.integers(0, 60), ranged=st.booleans())
def test_missing_days_equal_brute_force(spark, a, b, lo, span, ranged):
    from skymetrics.operators import coverage

    base = dt.date(2024, 1, 1)
    landed = {s: sorted({base + dt.timedelta(days=d) for d in ds}) for s, ds in (("A", a), ("B", b))}
    data = [(s, dt.datetime(d.year, d.month, d.day, 12)) for s, ds in landed.items() for d in ds]
    obs = spark.createDataFrame(data, "Station string, Time timestamp_ntz")
    start = base + dt.timedelta(days=lo) if ranged else None
    end = start + dt.timedelta(days=span) if ranged else None
    got = sorted((r.Station, r.Date) for r in coverage.missing_days(obs, start, end).collect())
    want = []
    for s, ds in landed.items():
        first, last = (start, end) if ranged else (ds[0], ds[-1])
        present = set(ds)
        want += [(s, first + dt.timedelta(days=i)) for i in range((last - first).days + 1)
                 if first + dt.timedelta(days=i) not in present]
    assert got == sorted(want)


LAYOUTS = ["Time,Temperature,Humidity", "Time,Pressure,Temperature", "Time,Temperature"]
landing_files = st.lists(
    st.tuples(st.integers(0, len(LAYOUTS) - 1), st.lists(st.integers(0, 23), min_size=0, max_size=5)),
    min_size=1, max_size=6,
)


@SETTINGS
@given(files=landing_files)
def test_read_by_layout_equals_the_written_files(spark, files):
    import os
    import tempfile

    from skymetrics.sources import csv_files

    root = tempfile.mkdtemp(prefix="skymetrics-layout-")
    want = []
    for i, (layout, hours) in enumerate(files):
        cols = LAYOUTS[layout].split(",")
        lines = [LAYOUTS[layout]]
        for h in sorted(set(hours)):
            vals = {"Time": f"2024-01-{i + 1:02d}T{h:02d}:00", "Temperature": f"{h}.5", "Humidity": f"{50 + h}",
                    "Pressure": f"{1000 + h}"}
            lines.append(",".join(vals[c] for c in cols))
            want.append((i + 1, h, h + 0.5, 50.0 + h if "Humidity" in cols else None,
                         1000.0 + h if "Pressure" in cols else None))
        d = os.path.join(root, "weather_data_hourly_S_1.0_2.0")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"weather_2024-01-{i + 1:02d}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
    df = csv_files.read_by_layout(spark, root)
    cols = set(df.columns)
    got = sorted((r.Time.day, r.Time.hour, r.Temperature,
                  r.Humidity if "Humidity" in cols else None, r.Pressure if "Pressure" in cols else None)
                 for r in df.collect())
    assert got == sorted(want)
