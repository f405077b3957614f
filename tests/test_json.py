"""Service JSON responses."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from skymetrics.plans import catalog
from skymetrics.sources import fixture
from skymetrics.sources import json_responses as J

from .conftest import SF_SMALL, rows

RESPONSE = {
    "latitude": 28.3, "longitude": -16.6, "utc_offset_seconds": 0, "timezone": "Atlantic/Canary",
    "hourly": {
        "time": ["2024-03-31T00:00", "2024-03-31T01:00", "2024-03-31T02:00"],
        "temperature_2m": [13, 12.7, None],
        "relative_humidity_2m": [80, 81, 82],
        "precipitation": [0.0, 0.2, 0.0],
        "weather_code": [3.0, 61, 0],
        "wind_speed_10m": [5.1, 6.0, 7.2],
        "wind_direction_10m": [350, 10, 20],
        "pressure_msl": [1018.2, 1018.0],   # shorter array pads with NULL
    },
}


def test_parallel_arrays_to_rows(spark):
    docs = spark.createDataFrame([("Tenerife", json.dumps(RESPONSE))], "Station string, json string")
    good, rejects = J.split_responses(J.parse_responses(docs))
    assert rejects.count() == 0
    out = J.pivot_hourly(good).orderBy("Time").collect()
    assert [r.Time for r in out] == [dt.datetime(2024, 3, 31, h) for h in range(3)]
    assert [r.Temperature for r in out] == [13.0, 12.7, None]
    assert [r.WeatherCode for r in out] == [3, 61, 0]
    assert [r.Pressure for r in out] == [1018.2, 1018.0, None]
    assert {r.Station for r in out} == {"Tenerife"}


def test_errors_and_missing_hourly_are_rejected(spark):
    docs = spark.createDataFrame(
        [
            ("a", json.dumps({"error": True, "reason": "Cannot initialize WeatherVariable"})),
            ("b", json.dumps({"latitude": 1.0, "longitude": 2.0})),
            ("c", "{not json"),
            ("d", json.dumps(RESPONSE)),
        ],
        "Station string, json string",
    )
    good, rejects = J.split_responses(J.parse_responses(docs))
    reasons = dict((r.Station, r.Reason) for r in rejects.collect())
    assert reasons["a"] == "error: Cannot initialize WeatherVariable"
    assert reasons["b"] == "no hourly block"
    assert reasons["c"] == "malformed document"
    assert [r.Station for r in good.collect()] == ["d"]


def test_multi_location_positions(spark):
    other = dict(RESPONSE, latitude=27.9)
    docs = spark.createDataFrame([(json.dumps([RESPONSE, other]),)], "json string")
    parsed = J.parse_multi(docs)
    out = J.pivot_hourly(parsed.withColumn("Lat", F.col("response.latitude")))
    got = sorted({(r.LocationId, r.Lat) for r in out.collect()})
    assert got == [(0, 28.3), (1, 27.9)]


def test_pack_and_parse_round_trip(spark):
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Time").isNotNull())
    docs = J.to_documents(J.pack_days(obs, fixture.fixture_stations(spark)))
    # one document per station-day
    assert docs.count() == obs.select("Station", F.to_date("Time")).distinct().count()
    good, _ = J.split_responses(J.parse_responses(docs.select("Station", "json")))
    back = J.pivot_hourly(good)
    assert rows(back) == rows(obs)


def test_documents_are_bounded_and_lossless(spark):
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Time").isNotNull())
    packed = J.pack_days(obs, max_rows=3)
    sizes = [r.n for r in packed.select(F.size("response.hourly.time").alias("n")).collect()]
    assert max(sizes) <= 3
    good, _ = J.split_responses(J.parse_responses(J.to_documents(packed).select("Station", "json")))
    assert rows(J.pivot_hourly(good)) == rows(obs)


def test_multi_location_documents_bounded(spark):
    names = fixture.FIXTURE_STATIONS
    obs = fixture.observations(spark, SF_SMALL).filter(F.col("Time").isNotNull())
    idx = F.array_position(F.array(*[F.lit(s) for s in names]), F.col("Station")) - 1
    docs = J.pack_locations(J.pack_days(obs, max_rows=2), idx, len(names), batch=2)
    parsed = J.parse_multi(docs)
    # every document lists exactly the locations of its batch, in order
    counts = parsed.groupBy("Date", "Batch", "Chunk").agg(F.max("LocationId").alias("m"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.n == r.m + 1 <= 2 for r in counts)
    station = F.element_at(F.array(*[F.lit(s) for s in names]), (F.col("Batch") * 2 + F.col("LocationId") + 1).cast("int"))
    back = J.pivot_hourly(parsed.withColumn("Station", station)).select(obs.columns)
    assert rows(back) == rows(obs)


def test_response_files_from_storage(spark, scratch):

    d = os.path.join(scratch, "weather_data_hourly_Tenerife_28.2916_-16.6291")
    os.makedirs(d)
    bodies = {
        "good.json": json.dumps(RESPONSE, indent=2),  # a saved response body spans several lines
        "error.json": json.dumps({"error": True, "reason": "Cannot initialize WeatherVariable"}),
        "broken.json": "{not json",
    }
    for name, body in bodies.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    got, rejects = J.load_responses(spark, scratch, one_per_file=True)
    out = got.orderBy("Time").collect()
    assert [r.Time for r in out] == [dt.datetime(2024, 3, 31, h) for h in range(3)]
    assert {r.Station for r in out} == {"Tenerife"}
    reasons = sorted((os.path.basename(r.SourceFile), r.Reason) for r in rejects.collect())
    assert reasons == [("broken.json", "malformed document"),
                       ("error.json", "error: Cannot initialize WeatherVariable")]


def test_malformed_multi_location_document_is_rejected(spark):
    other = dict(RESPONSE, latitude=27.9)
    docs = spark.createDataFrame([("ok", json.dumps([RESPONSE, other])), ("bad", "[{not json")], "Doc string, json string")
    parsed = J.parse_multi(docs)
    good, rejects = J.split_responses(parsed)
    assert sorted((r.Doc, r.LocationId) for r in good.collect()) == [("ok", 0), ("ok", 1)]
    assert [(r.Doc, r.LocationId, r.Reason) for r in rejects.collect()] == [("bad", None, "malformed document")]


def test_list_element_that_is_no_response_is_rejected_alone(spark):
    docs = spark.createDataFrame([(json.dumps([RESPONSE, 5, None, "x", [], {"hourly": 7}, RESPONSE]),), (None,), ("[]",), ("  7",)], "json string")
    good, rejects = J.split_responses(J.parse_multi(docs))
    assert sorted(r.LocationId for r in good.collect()) == [0, 6]
    assert sorted((r.LocationId, r.Reason) for r in rejects.filter("LocationId > 0").collect()) == [
        (1, "malformed document"), (2, "malformed document"), (3, "malformed document"), (4, "malformed document"), (5, "no hourly block")]
    assert [r.LocationId for r in rejects.filter("LocationId IS NULL").collect()] == [None]
    assert J.pivot_hourly(good).count() == 6


def test_every_hour_is_a_row_or_a_reject(spark):
    hourly = dict(RESPONSE["hourly"])
    without = {k: v for k, v in hourly.items() if k != "pressure_msl"}
    cases = {
        "absent variable": dict(RESPONSE, hourly=without),
        "empty block": dict(RESPONSE, hourly={}),
        "bad cell": dict(RESPONSE, hourly=dict(hourly, temperature_2m=[13, "x", 14])),
        "bad time": dict(RESPONSE, hourly=dict(hourly, time=["2024-03-31T00:00", "soon", None])),
        "long array": dict(RESPONSE, hourly=dict(hourly, pressure_msl=[1.0, 2.0, 3.0, 4.0])),
        "codes": dict(RESPONSE, hourly=dict(hourly, weather_code=[1e12, 3.7, "NaN"])),
    }
    docs = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "Station string, json string")
    good, rejects = J.split_responses(J.parse_responses(docs))
    assert [(r.Station, r.Reason) for r in rejects.collect()] == [("empty block", "no time array")]
    kept, hours = J.hourly_rows(good)
    counts = {k: (kept.filter(F.col("Station") == k).count(), [r.BadColumns for r in hours.filter(F.col("Station") == k).collect()])
              for k in cases}
    assert counts == {
        "absent variable": (3, []),
        "empty block": (0, []),
        "bad cell": (2, [["Temperature"]]),
        "bad time": (1, [["Time"], ["Time"]]),
        "long array": (3, [["Time"]]),
        "codes": (1, [["WeatherCode"], ["WeatherCode"]]),
    }


def test_lists_units_and_epoch_times_from_storage(spark, scratch):
    d = os.path.join(scratch, "weather_data_hourly_Tenerife_28.2916_-16.6291")
    os.makedirs(d)
    other = dict(RESPONSE, utc_offset_seconds=3600)
    other["hourly_units"] = {"time": "unixtime", "temperature_2m": "°F", "precipitation": "inch", "wind_speed_10m": "m/s"}
    other["hourly"] = {"time": [1711850400, "x"], "temperature_2m": [50, 50], "precipitation": [1, 0], "wind_speed_10m": [10, 10]}
    strange = dict(RESPONSE, hourly_units={"temperature_2m": "K"})
    docs = [[RESPONSE, other, 5, {"error": True, "reason": "no"}], strange]
    with open(os.path.join(d, "docs.json"), "w") as f:
        f.write("\n".join(json.dumps(x) for x in docs) + "\n[{broken\n")
    good, rejects = J.load_responses(spark, scratch)
    got = good.collect()
    assert sum(r.LocationId == 0 for r in got) == len(RESPONSE["hourly"]["time"])
    [r] = [r for r in got if r.LocationId == 1]
    assert r.Time == dt.datetime(2024, 3, 31, 3) and r.Temperature == 10.0 and r.Precipitation == 25.4 and abs(r.WindSpeed - 36) < 1e-9
    reasons = sorted((str(r.LocationId), r.Reason) for r in rejects.collect())
    assert reasons == [("0", "unknown unit"), ("1", "bad hour x: Time"), ("2", "malformed document"), ("3", "error: no"),
                       ("None", "malformed document")]


def test_rows_without_time_come_back_as_rejects(spark, monkeypatch):
    obs = fixture.observations(spark, SF_SMALL)
    some = obs.withColumn("Time", F.when(F.col("WindDirection") % 7 != 0, F.col("Time")))
    lost, kept = some.filter("Time IS NULL").count(), some.filter("Time IS NOT NULL")
    assert lost > 10
    fixture._memo(spark, ("observations", "rows without time", True), lambda: some)
    parsed, split, pivot = [], J.split_responses, J.pivot_hourly
    monkeypatch.setattr(J, "split_responses", lambda p: (parsed.append(p), split(p))[1])
    monkeypatch.setattr(J, "pivot_hourly", lambda p: (parsed.append(p), pivot(p))[1])
    for name in ("json_pivot", "landed_json", "multi_location", "response_errors", "response_units"):
        parsed.clear()
        got = catalog.queries()[name](spark, "rows without time")
        hours = J.hourly_rows(split(parsed[-1])[0])[1]
        bad = [(r.Time, r.BadColumns) for r in hours.collect()]
        assert bad == [(J.NO_TIME, ["Time"])] * lost, name
        if name == "response_errors":
            assert got.filter("Date IS NULL").count() == 0
        else:
            assert got.count() == kept.count(), name
