"""Fire hotspots around stations and the transboundary transport index."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelines.functions.geo import EARTH_RADIUS_KM, bearing_deg
from tidelines.session import staged

RADIUS_KM = 800.0
DECAY_KM = 200.0
# Region of interest and the country codes of the daily counts.
BOUNDING_BOX = {"lat": (13.0, 21.0), "lon": (97.0, 106.0)}
COUNTRIES = ["th", "mm", "la"]
#: A grid cell is this part of the radius high and wide, so that little of what its stations meet is out of reach.
CELL = 0.25
#: Places of one cell and day in one task; a busier cell is dealt over several.
PLACES_PER_TASK = 2_000
#: Square of the chord (of the unit sphere; some 60 m) below which a bearing is computed from the differences of latitude
#: and longitude, which products of coordinates would drown in rounding.
SAME_PLACE = 1e-10


def hotspot_locations(hotspots: DataFrame) -> DataFrame:
    """Hotspots inside the region, combined per date, place and country before anything is joined."""
    box = F.lit(True)
    for c, (lo, hi) in BOUNDING_BOX.items():
        box = box & F.col(c).between(lo, hi)
    return (
        hotspots.filter(box)
        .groupBy("date", "lat", "lon")
        .agg(
            F.sum("frp").alias("frp"),
            *[F.count_if(F.col("country") == c).alias(f"n_{c}") for c in COUNTRIES],
        )
    )


def _position(lat: str, lon: str, prefix: str) -> list[str]:
    """Unit vector of a position and the sine and cosine of its longitude, once per place instead of once per pair."""
    a, o = f"radians(`{lat}`)", f"radians(`{lon}`)"
    return [
        f"cos({a}) * cos({o}) AS {prefix}_x",
        f"cos({a}) * sin({o}) AS {prefix}_y",
        f"sin({a}) AS {prefix}_z",
        f"cos({a}) AS {prefix}_ca",
        f"sin({o}) AS {prefix}_so",
        f"cos({o}) AS {prefix}_co",
        f"`{lat}` AS {prefix}_lat",
        f"`{lon}` AS {prefix}_lon",
    ]


def _cells_in_reach(cells: DataFrame, stations: DataFrame, radius_km: float, size: float) -> DataFrame:
    """Station days with every cell of their date that their radius may touch.

    ``cells``: date, cell_y, cell_x, tasks. A cell is left out if the haversine of the radius is below a bound that
    holds for all its points: that of the smallest latitude difference, plus that of the smallest longitude difference
    at the cell's narrower edge.
    """
    south, west = F.col("cell_y") * size, F.col("cell_x") * size
    off_lat = F.greatest(south - F.col("lat"), F.col("lat") - south - size, F.lit(0.0))
    off_lon = F.greatest(west - F.col("lon"), F.col("lon") - west - size, F.lit(0.0))
    # The other way round the globe may be shorter.
    off_lon = F.least(off_lon, F.greatest(F.lit(360.0 - size) - F.abs(F.col("lon") - west), F.lit(0.0)))
    narrow = F.cos(F.radians(F.least(F.greatest(F.abs(south), F.abs(south + size)), F.lit(90.0))))
    least = F.pow(F.sin(F.radians(off_lat) / 2), 2) + narrow * F.cos(F.radians("lat")) * F.pow(
        F.sin(F.radians(F.least(off_lon, F.lit(180.0))) / 2), 2
    )
    most = math.sin(min(radius_km / (2 * EARTH_RADIUS_KM), math.pi / 2)) ** 2
    return stations.join(cells, "date").filter(least <= F.lit(most * (1 + 1e-9)))


def transboundary_index(
    hotspots: DataFrame,
    stations: DataFrame,
    radius_km: float = RADIUS_KM,
    decay_km: float = DECAY_KM,
) -> DataFrame:
    """Per (station, date): hotspot counts per country, FRP sum and the transport index within the radius.

    ``hotspots``: date, lat, lon, frp, country. ``stations``: date, stationID, lat, lon, wind_direction_mean
    (one row per station and day). The index is the FRP sum weighted with max(0, cos(bearing from fire to
    station - direction the wind blows to)) and exp(-distance / decay). Stations without a position, and fires
    outside the region, reach nothing.

    Fires are first combined per place and counted per cell of a grid finer than the radius. Each station day is
    listed in the cells that hold fires of its date and lie in its reach, once for every task a busy cell is dealt
    over, and matched with the places by an equi-join on (date, cell, task). The exact distance filter follows, and
    the sums are combined map-side.
    """
    size = CELL * math.degrees(radius_km / EARTH_RADIUS_KM)
    located = hotspot_locations(hotspots).select(
        "*",
        F.floor(F.col("lat") / size).cast("int").alias("cell_y"),
        F.floor(F.col("lon") / size).cast("int").alias("cell_x"),
    )
    located = staged(located, "hotspots")
    cells = located.groupBy("date", "cell_y", "cell_x").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(PLACES_PER_TASK)).cast("int").alias("tasks")
    )
    # The number of tasks of a cell is read by its places too; a date has few hundred cells at most.
    places = located.join(cells, ["date", "cell_y", "cell_x"]).selectExpr(
        "date",
        "cell_y",
        "cell_x",
        "pmod(hash(lat, lon), tasks) AS task",
        "frp",
        *[f"n_{c}" for c in COUNTRIES],
        *_position("lat", "lon", "f"),
    )
    spread = _cells_in_reach(cells, stations, radius_km, size).selectExpr(
        "stationID",
        "date",
        "cell_y",
        "cell_x",
        "explode(sequence(0, tasks - 1)) AS task",
        *_position("lat", "lon", "s"),
        "sin(radians(wind_direction_mean + 180)) AS w_sin",
        "cos(radians(wind_direction_mean + 180)) AS w_cos",
    )
    # Great-circle geometry by products alone: the chord, and the components of the bearing.
    pairs = spread.join(places, ["date", "cell_y", "cell_x", "task"]).selectExpr(
        "stationID",
        "date",
        "frp",
        *[f"n_{c}" for c in COUNTRIES],
        "w_sin",
        "w_cos",
        "s_lat",
        "s_lon",
        "f_lat",
        "f_lon",
        "s_y * f_co - s_x * f_so AS east",
        "f_ca * s_z - f_z * (s_x * f_co + s_y * f_so) AS north",
        "(s_x - f_x) * (s_x - f_x) + (s_y - f_y) * (s_y - f_y) + (s_z - f_z) * (s_z - f_z) AS chord2",
    )
    # The chord decides, so that the arc is computed once and for fires in reach only.
    chord = 2 * math.sin(min(radius_km / (2 * EARTH_RADIUS_KM), math.pi / 2))
    near = pairs.filter(F.col("chord2") <= chord * chord).selectExpr(
        "*", f"{2 * EARTH_RADIUS_KM!r}D * asin(least(sqrt(chord2) / 2, 1D)) AS km", "sqrt(east * east + north * north) AS length"
    )
    # Of a fire at the station itself, or a last digit beside it, the bearing is that of the differences (0 if there are none).
    toward = bearing_deg(*[F.col(c) for c in ("f_lat", "f_lon", "s_lat", "s_lon")])
    near = near.withColumn("at_place", F.when(F.col("chord2") < SAME_PLACE, F.radians(toward)))
    aligned = (
        "greatest(0D, CASE WHEN at_place IS NOT NULL THEN cos(at_place) * w_cos + sin(at_place) * w_sin "
        "ELSE coalesce(try_divide(north * w_cos + east * w_sin, length), w_cos) END)"
    )
    return near.groupBy("stationID", "date").agg(
        *[F.sum(f"n_{c}").alias(f"hotspot_count_{c}") for c in COUNTRIES],
        F.sum("frp").alias("hotspot_frp_sum"),
        F.sum(F.expr(f"frp * {aligned} * exp(-km / {decay_km!r}D)")).alias("transboundary_index"),
    )
