"""Hand-made raw records, one per rule."""

from __future__ import annotations

from tiered import specs

GOOD = {
    "ID": "A-1", "Source": " Source1 ", "Severity": 3,
    "Start_Time": "2020-01-01 08:00:00", "End_Time": "2020-01-01 10:00:00",
    "Start_Lat": 40.125, "Start_Lng": -75.5, "City": " Reading ", "County": " Berks ",
    "State": " pa ", "Zipcode": " 19601", "Timezone": "US/Eastern ",
    "Temperature(F)": 55.0, "Humidity(%)": 40.0, "Pressure(in)": 29.5,
    "Visibility(mi)": 8.0, "Wind_Direction": " N ", "Wind_Speed(mph)": 5.0,
    "Precipitation(in)": 0.25, "Weather_Condition": " Light Rain ",
    **{f: False for f in specs.FLAGS},
}


def record(**changes):
    names = {"temperature": "Temperature(F)", "humidity": "Humidity(%)",
             "wind": "Wind_Speed(mph)"}
    row = dict(GOOD)
    for k, v in changes.items():
        row[names.get(k, k)] = v
    return tuple(row[c] for c in specs.RAW_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), specs.RAW_SCHEMA)
