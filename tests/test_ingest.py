"""Payload cases, the duplicate-free sink, CSV round trips, streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.sources import observations as O
from obsframe.streaming import live


def payload(**change):
    body = {
        "main": {"temp": 1.5, "feels_like": 1, "temp_min": 0, "temp_max": 2, "pressure": 1000, "humidity": 50},
        "wind": {"speed": 3.0, "deg": 90},
        "clouds": {"all": 40},
        "weather": [{"main": "Rain", "description": "light rain"}],
        "visibility": 9000,
        "rain": {"1h": 0.2},
        "snow": {"1h": 0.1},
    }
    body.update(change)
    return json.dumps({k: v for k, v in body.items() if v is not None})


CASES = {
    "complete": payload(),
    "no_options": payload(visibility=None, rain=None, snow=None, wind={"speed": 3.0}),
    "no_main": payload(main=None),
    "no_wind": payload(wind=None),
    "no_clouds": payload(clouds=None),
    "empty_weather": payload(weather=[]),
    "broken": "{nonsense",
}


def test_payload_cases(spark):
    raw = spark.createDataFrame([(k, v) for k, v in CASES.items()], "city_name string, body string")
    stations = spark.createDataFrame([(k, 1.0, 2.0) for k in CASES], O.STATIONS)
    parsed = O.collect(raw, stations)
    good = {r.city_name: r for r in parsed.accepted.collect()}
    assert set(good) == {"complete", "no_options"}
    assert good["complete"].rain_1h == 0.2 and good["complete"].latitude == 1.0
    assert (good["no_options"].wind_direction, good["no_options"].visibility, good["no_options"].rain_1h) == (0, 0, 0.0)
    bad = {r.city_name: r.reason for r in parsed.rejected.collect()}
    assert bad["no_wind"] == "wind_speed" and bad["empty_weather"] == "weather_main" and bad["broken"] == "temperature"


def observations(spark, stamps):
    rows = [(dt.datetime(2024, 1, 1, h), c, 1.0, 2.0, float(h)) for h, c in stamps]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, city_name string, latitude double, longitude double, temperature double")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in O.OBSERVATIONS.fields if f.name not in df.columns]
    return df.select("*", *rest).select(*O.OBSERVATIONS.names)


def test_append_rejects_only_repeats(spark, tmp_path):
    path = str(tmp_path / "table")
    first = observations(spark, [(1, "a"), (2, "a"), (1, "b"), (1, "a")])
    assert O.append_new(spark, first, path) == 3
    assert O.append_new(spark, observations(spark, [(2, "a"), (3, "a"), (3, "b")]), path) == 2
    assert O.append_new(spark, first, path) == 0
    held = O.read_table(spark, path)
    assert held.count() == 5 and held.columns[:2] == ["timestamp", "city_name"]
    assert spark.read.parquet(path).where("created_at is null").count() == 0


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_append_reads_only_what_it_can_meet(spark, tmp_path):
    path = str(tmp_path / "table")
    assert O.append_new(spark, observations(spark, [(1, "a"), (2, "a"), (1, "z")]), path) == 3
    for part in (tmp_path / "table" / "city_name=z").glob("*.parquet"):
        part.write_bytes(b"not parquet")  # reading it would fail
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    batch = observations(spark, [(2, "a"), (3, "a")])
    plan = executed(O.near_batch(O.read_table(spark, path), batch, ("timestamp", "city_name"), ("city_name",)))
    assert "PartitionFilters: [isnotnull(city_name" in plan and "GreaterThanOrEqual(timestamp,2024-01-01T02:00" in plan
    assert O.append_new(spark, batch, path) == 1
    assert O.append_new(spark, batch, path) == 0


@pytest.mark.parametrize("named", [1000, 0])
def test_near_batch_loses_no_key(spark, monkeypatch, named):
    monkeypatch.setattr(O, "PARTITIONS_NAMED", named)
    schema = "t timestamp, k string, n long"
    day = lambda d: dt.datetime(2024, 3, d, 12, 30, 0, 123456)
    held = spark.createDataFrame([(day(1), "a", 1), (day(5), "a", 2), (None, "a", 3), (day(3), None, 4), (day(3), "b", 5)], schema)
    near = lambda rows: {r.n for r in O.near_batch(held, spark.createDataFrame(rows, schema), ("t", "k"), ("k",)).collect()}
    assert {1} <= near([(day(1), "a", 0)]) and 2 not in near([(day(1), "a", 0)])
    assert {1, 2, 3} <= near([(day(1), "a", 0), (day(5), "a", 0), (None, "a", 0)])
    assert {4} <= near([(day(3), None, 0)]) and {3} <= near([(None, "a", 0)])
    assert near([]) == set()
    if named:
        assert near([(day(3), "b", 0)]) == {5}


def test_latest_values_of_changed_keys(spark, tmp_path):
    schema = "t timestamp_ntz, k string, v double"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    b = Binding(("k",), "t", ("v",))
    first = [(at(1), "a", 1.0), (at(2), "b", 2.0), (at(1), None, 3.0)]
    second = [(at(3), "a", None), (at(2), "a", 5.0), (at(0), None, 9.0)]

    def run():
        stream = live.latest_values(live.read_stream(spark, folder, spark.createDataFrame([], schema).schema, "*.parquet"), b)
        live.keep_latest(stream, out, str(tmp_path / "progress"))
        return live.read_latest(spark, stream.schema, b.key, out)

    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        got = run()
    assert set(map(tuple, got.collect())) == {("a", at(3), 5.0), ("b", at(2), 2.0), (None, at(1), 3.0)}
    held = spark.read.parquet(out)
    assert held.where("batch = 1 and k = 'b'").count() == 0
    # a batch that is put again takes the place of its first run
    again = held.where("batch = 1").drop("batch").toPandas()
    spark.createDataFrame(again, held.drop("batch").schema).write.mode("overwrite").parquet(f"{out}/batch=1")
    assert live.read_latest(spark, got.schema, b.key, out).count() == 3


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = observations(spark, [(1, "a"), (2, "b")])
    O.append_csv(df, path)
    O.append_csv(observations(spark, [(3, "a")]), path)
    back = O.read_csv(spark, path)
    assert back.count() == 3 and back.schema["pressure"].dataType.simpleString() == "int"
    assert sorted(r.temperature for r in back.collect()) == [1.0, 2.0, 3.0]
    O.export_csv(df, path)
    assert O.read_csv(spark, path).count() == 2


def test_stream_resumes_without_repeats(spark, tmp_path):
    schema = "t timestamp_ntz, k string, v double"
    folder = str(tmp_path / "in")
    rows = [(dt.datetime(2024, 1, 1, h), "a", float(h)) for h in range(4)]
    spark.createDataFrame(rows + rows[:2], schema).write.parquet(folder)
    b = Binding(("k",), "t", ("v",))
    stream = live.read_stream(spark, folder, spark.createDataFrame([], schema).schema, "*.parquet")
    assert live.run_available(live.unique_keys(stream, b, "2 days")).count() == 4


@pytest.mark.parametrize("slide", [None, "1 hour"])
def test_closed_windows_equal_batch(spark, tmp_path, slide):
    schema = "t timestamp_ntz, k string, v double"
    folder = str(tmp_path / "in")
    rows = [(dt.datetime(2024, 1, 1 + h // 24, h % 24), "ab"[h % 2], float(h)) for h in range(48)]
    spark.createDataFrame(rows, schema).write.parquet(folder)
    b = Binding(("k",), "t", ("v",))
    stream = live.read_stream(spark, folder, spark.createDataFrame([], schema).schema, "*.parquet")
    got = set(live.run_available(live.window_stats(stream, b, slide=slide, delay="1 hour")).collect())
    want = live.window_stats(spark.read.parquet(folder), b, slide=slide)
    closed = set(want.where("window_end <= timestamp_ntz'2024-01-02 22:00:00'").collect())
    assert got == closed and got
