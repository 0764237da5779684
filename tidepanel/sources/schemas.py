"""Explicit schemas and rename maps of the files and payloads read."""

from __future__ import annotations

from pyspark.sql import types as T

# CSV header to column name.
CSV_NAMES = {
    "City": "city", "Date": "date", "Datetime": "datetime", "PM2.5": "pm2_5", "PM10": "pm10",
    "NO": "no", "NO2": "no2", "NOx": "nox", "NH3": "nh3", "CO": "co", "SO2": "so2", "O3": "o3",
    "Benzene": "benzene", "Toluene": "toluene", "Xylene": "xylene", "AQI": "aqi",
    "AQI_Bucket": "aqi_bucket",
}
STATION_NAMES = {"StationId": "station_id", "StationName": "station_name", "City": "city",
                 "State": "state", "Status": "status"}
# Column type per name; every other column is a double.
_TYPES = {"city": T.StringType(), "date": T.DateType(), "datetime": T.TimestampNTZType(),
          "aqi_bucket": T.StringType(), "is_synthetic": T.BooleanType(),
          "data_source": T.StringType(), "ingested_at": T.TimestampType()}


def column_type(name: str) -> T.DataType:
    return _TYPES.get(name, T.DoubleType())


def csv_schema(headers) -> T.StructType:
    """Schema of a raw CSV by its header names."""
    return T.StructType([T.StructField(h, column_type(CSV_NAMES.get(h, h))) for h in headers])


DAILY_HEADERS = tuple(h for h in CSV_NAMES if h != "Datetime")
HOURLY_HEADERS = tuple(h for h in CSV_NAMES if h != "Date")
STATION_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in STATION_NAMES])

_MEASURES = tuple(CSV_NAMES[h] for h in DAILY_HEADERS[2:])
_STAMPS = ("is_synthetic", "data_source", "ingested_at")


def _table(time: str) -> T.StructType:
    required = {"city", time, "is_synthetic", "data_source", "ingested_at"}
    return T.StructType([T.StructField(c, column_type(c), c not in required)
                         for c in ("city", time, *_MEASURES, *_STAMPS)])


DAILY_TABLE = _table("date")
HOURLY_TABLE = _table("datetime")

ROW_PAYLOAD = ("results array<struct<date: struct<local: string>, value: double, "
               "location: string>>")


def array_payload(section: str, fields) -> str:
    """DDL of a payload of parallel arrays below one section."""
    inner = ", ".join(f"{f}: array<double>" for f in fields)
    return f"{section} struct<time: array<string>, {inner}>"
