"""Declared schemas of the Bronze and Silver layers and the names that changed between generations."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def _struct(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in kinds.items()])


# Fixed values below: field names and types of the stored layers.
AIR_QUALITY_VARIABLES = ["pm2_5", "pm10", "nitrogen_dioxide", "ozone", "sulphur_dioxide", "carbon_monoxide"]
AIR_QUALITY_ALIASES = {"nitrogen_dioxide": "no2", "ozone": "o3", "sulphur_dioxide": "so2", "carbon_monoxide": "co"}
WEATHER_VARIABLES = {
    "temperature_2m": "temp_c",
    "relative_humidity_2m": "humidity_pct",
    "surface_pressure": "pressure_hpa",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_ms",
    "wind_direction_10m": "wind_dir_deg",
    "shortwave_radiation": "shortwave_radiation_wm2",
    "cloud_cover": "cloud_cover_pct",
    "wind_u_component_10m": "u10_ms",
    "wind_v_component_10m": "v10_ms",
}
SHORT_TO_LONG = {
    "no2_ugm3": "nitrogen_dioxide_ugm3",
    "o3_ugm3": "ozone_ugm3",
    "so2_ugm3": "sulphur_dioxide_ugm3",
    "co_ugm3": "carbon_monoxide_ugm3",
}
LONG_POLLUTANTS = [
    "pm2_5_ugm3",
    "pm10_ugm3",
    "nitrogen_dioxide_ugm3",
    "ozone_ugm3",
    "sulphur_dioxide_ugm3",
    "carbon_monoxide_ugm3",
]
PROVENANCE = ["data_source", "ingestion_timestamp_utc", "load_id", "pipeline_version", "record_hash"]

WEATHER_SILVER = _struct(
    stationID="string",
    lat="double",
    lon="double",
    timestamp_utc="timestamp",
    timestamp_unix_ms="bigint",
    temp_c="float",
    humidity_pct="float",
    pressure_hpa="float",
    precipitation_mm="float",
    wind_ms="float",
    wind_dir_deg="float",
    shortwave_radiation_wm2="float",
    cloud_cover_pct="float",
    u10_ms="float",
    v10_ms="float",
    data_source="string",
    ingestion_timestamp_utc="timestamp",
    load_id="string",
    pipeline_version="string",
    record_hash="string",
)

AIR_QUALITY_SILVER_V1 = _struct(
    stationID="string",
    lat="double",
    lon="double",
    timestamp_utc="timestamp",
    timestamp_unix_ms="bigint",
    pm2_5_ugm3="float",
    pm10_ugm3="float",
    no2_ugm3="float",
    o3_ugm3="float",
    so2_ugm3="float",
    co_ugm3="float",
    data_source="string",
    ingestion_timestamp_utc="timestamp",
    load_id="string",
    pipeline_version="string",
    record_hash="string",
)

AIR_QUALITY_SILVER = _struct(
    stationID="string",
    lat="double",
    lon="double",
    timestamp_utc="timestamp",
    timestamp_unix_ms="bigint",
    pm2_5_ugm3="double",
    pm10_ugm3="double",
    nitrogen_dioxide_ugm3="double",
    ozone_ugm3="double",
    sulphur_dioxide_ugm3="double",
    carbon_monoxide_ugm3="double",
    data_source="string",
    ingestion_timestamp_utc="timestamp",
    load_id="string",
    pipeline_version="string",
    record_hash="string",
)

STATIONS = _struct(stationID="string", lat="double", lon="double")

CORRUPT = "_corrupt"


def _bronze(variables: list[str]) -> T.StructType:
    hourly = T.StructType(
        [
            T.StructField("time", T.ArrayType(T.StringType())),
            *[T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables],
        ]
    )
    head = _struct(stationID="string", latitude="double", longitude="double", elevation="double")
    return head.add("hourly", hourly).add(CORRUPT, T.StringType())


AIR_QUALITY_BRONZE = _bronze([*AIR_QUALITY_VARIABLES, *AIR_QUALITY_ALIASES.values()])
WEATHER_BRONZE = _bronze(list(WEATHER_VARIABLES))
