"""Readers on files laid out as the feeds deliver them, and the landing stream."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from ridepulse.sources import files as S
from ridepulse.sources import store
from ridepulse.streaming.landing import ingest_new_files

PING = {"LastRentalStart": "2021-04-02 12:51:50", "BikeID": 7, "Battery": 41, "LastGPSTime": "2021-04-02 13:01:00",
        "Latitude": 53.3012345, "Longitude": None, "BikeTypeName": "DUB-General"}


def test_history_csv(spark, tmp_path):
    head = ("HarvestTime,BikeID,Battery,BikeIdentifier,BikeTypeName,EBikeProfileID,EBikeStateID,IsEBike,IsMotor,IsSmartLock,"
            "LastGPSTime,LastRentalStart,Latitude,Longitude,SpikeID\n")  # fmt: skip
    row = "2021-04-02 13:05:00,{b},,x,Workshop,1,2,True,True,False,2021-04-02 13:01:00,2021-04-02 12:51:50,53.3,-6.2,1\n"
    for b in (1, 2):
        (tmp_path / f"part-{b}.csv").write_text(head + row.format(b=b))
    rows = S.read_history(spark, f"{tmp_path}/part-*.csv").orderBy("BikeID").collect()
    assert [r.BikeID for r in rows] == [1, 2]
    assert rows[0].LastRentalStart == dt.datetime(2021, 4, 2, 12, 51, 50) and rows[0].Battery is None
    assert rows[0].Latitude == Decimal("53.3000000") and rows[0].IsSmartLock is False


def test_pretty_printed_arrays(spark, tmp_path):
    (tmp_path / "day.json").write_text(json.dumps([PING, {**PING, "BikeID": 8, "Battery": None}], indent=4))
    rows = S.read_pings_json(spark, str(tmp_path)).orderBy("BikeID").collect()
    assert [(r.BikeID, r.Battery) for r in rows] == [(7, 41), (8, None)]
    assert rows[0].LastGPSTime == dt.datetime(2021, 4, 2, 13, 1) and len(rows[0]) == 6


def test_weather_json(spark, tmp_path):
    reading = {"temperature": " 7 ", "windSpeed": "7.5", "humidity": "-", "rainfall": " 0.3 ", "date": "31-07-2022", "reportTime": "23:00"}
    (tmp_path / "w.json").write_text(json.dumps([reading], indent=2))
    row = S.read_weather_json(spark, str(tmp_path)).first()
    assert tuple(row) == (dt.date(2022, 7, 31), 23, "Night", 7, 0, 0, 0.3, "drizzle")


def test_fallback_and_station_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Time,R,T,W,G,D,Rain,P\n07:00,Fog,11,9,-,SW,0.1,1012\n")
    assert tuple(S.read_weather_csv(spark, str(tmp_path / "w.csv")).first()) == (7, 11.0, 9.0, 0.1)
    head = "date,ind,rain,ind,temp,ind,wetb,dewpt,vappr,rhum,msl,ind,wdsp,ind,wddir,ww,w,sun,vis,clht,clamt\n"
    (tmp_path / "s.csv").write_text(head + "01-jan-2021 05:00,0,0.2,0,4.1,0,3,2,7,88,1010,2,9,2,240,50,4,0,200,2,7\n")
    row = S.read_station_hourly(spark, str(tmp_path / "s.csv")).first()
    assert tuple(row) == (dt.datetime(2021, 1, 1, 5), 0.2, 4.1, 88, 9)


def test_holidays(spark, tmp_path):
    day = {"date": {"iso": "2021-03-17T00:00:00+00:00"}, "country": {"name": "Ireland"}, "name": "P", "type": ["National holiday", "X"]}
    other = {**day, "type": ["Season", "National holiday"]}
    (tmp_path / "feed.json").write_text(json.dumps({"meta": 1, "response": {"holidays": [day, other]}}, indent=1))
    assert [r.date for r in S.read_holiday_feed(spark, str(tmp_path / "feed.json")).collect()] == [dt.date(2021, 3, 17)]
    flat = [{"date": "2021-03-17", "country": "Ireland", "name": "P", "type": t} for t in ("National holiday", "Season")]
    (tmp_path / "flat.json").write_text(json.dumps(flat))
    assert [r.date for r in S.read_holidays(spark, str(tmp_path / "flat.json")).collect()] == [dt.date(2021, 3, 17)]


FORECAST = """<weatherdata><product class="pointData">
<time datatype="forecast" from="2022-05-01T10:00:00Z" to="2022-05-01T10:00:00Z"><location altitude="9">
 <temperature id="TTT" unit="celsius" value="11.5"/><windSpeed id="ff" mps="5.0" beaufort="3"/><humidity value="70.0" unit="percent"/></location></time>
<time from="2022-05-01T07:00:00Z" to="2022-05-01T10:00:00Z"><location><precipitation unit="mm" value="9.0"/></location></time>
<time from="2022-05-01T09:00:00Z" to="2022-05-01T10:00:00Z"><location><precipitation unit="mm" value="0.4" minvalue="0.0"/></location></time>
<time from="2022-05-01T10:00:00Z" to="2022-05-01T11:00:00Z"><location><precipitation unit="mm" value="1.0"/></location></time>
</product></weatherdata>"""


def test_forecast(spark, tmp_path):
    (tmp_path / "f.xml").write_text(FORECAST)
    entries = S.read_forecast_xml(spark, str(tmp_path / "f.xml"))
    assert entries.count() == 4
    rows = S.combine_forecast(entries).collect()
    assert [tuple(r) for r in rows] == [(dt.datetime(2022, 5, 1, 10), 11.5, 70.0, 5.0, 0.4)], "rain without a state is dropped"


def test_landing_reads_each_file_once(spark, tmp_path):
    folder, table, errors = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "errors")
    folder.mkdir()
    run = lambda: ingest_new_files(spark, str(folder), table, errors, str(tmp_path / "state"))
    (folder / "a.json").write_text(json.dumps([PING, PING], indent=1))
    run()
    (folder / "b.json").write_text(json.dumps([{**PING, "BikeID": 9}]))
    (folder / "c.json").write_text("[{ broken")
    run()
    run()
    stored = spark.read.parquet(table).select("BikeID", "file").collect()
    assert sorted((r.BikeID, r.file) for r in stored) == [(7, "a.json"), (7, "a.json"), (9, "b.json")]
    assert {r.file for r in spark.read.json(errors).collect()} == {"c.json"}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    store.land_if_absent(df, path)
    store.land_if_absent(df.limit(1), path)
    assert spark.read.parquet(path).count() == 2
    store.save_csv(df, str(tmp_path / "csv"), ["b", "a"])
    lines = {r.value for r in spark.read.text(str(tmp_path / "csv")).collect()}
    assert lines == {"b,a", "NULL,1", "b,2"}
    counts = spark.createDataFrame([(5, 0)], "processed int, errors int")
    store.log_run(spark, str(tmp_path / "log"), "2021-01-01 06:00:00", counts)
    store.log_run(spark, str(tmp_path / "log"), "2021-01-02 06:00:00", counts)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
