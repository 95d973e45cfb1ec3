"""Great-circle distance between a leg's departure and arrival airports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_MILES, great_circle_distance
from .ranges import left_join


def airport_pair_distances(legs: DataFrame, airports: DataFrame, *, dep: str, arr: str,
                           code: str = "airport_code", lat: str = "latitude_rad",
                           lon: str = "longitude_rad", out: str = "great_circle_distance",
                           radius: float = EARTH_RADIUS_MILES) -> DataFrame:
    """Distance for every distinct (dep, arr) pair of ``legs`` whose both
    airports have coordinates. An airport listed with several distinct
    coordinates yields one row per combination (exact duplicates collapse).

    The pair set is bounded by the number of routes, not by the number of
    legs; the airport table is a dimension, so Spark's size-checked
    auto-broadcast normally applies to both look-ups.
    """
    pairs = (legs.select(F.col(dep).alias(dep), F.col(arr).alias(arr))
             .where(F.col(dep).isNotNull() & F.col(arr).isNotNull()).distinct())
    coords = airports.select(F.col(code).alias("_code"), F.col(lat).alias("_lat"),
                             F.col(lon).alias("_lon")).distinct()
    d = coords.select(F.col("_code").alias("_dcode"), F.col("_lat").alias("_dlat"),
                      F.col("_lon").alias("_dlon"))
    a = coords.select(F.col("_code").alias("_acode"), F.col("_lat").alias("_alat"),
                      F.col("_lon").alias("_alon"))
    return (pairs.join(d, pairs[dep] == d["_dcode"]).join(a, pairs[arr] == a["_acode"])
            .select(dep, arr, great_circle_distance("_dlat", "_dlon", "_alat", "_alon", radius)
                    .alias(out)))


def attach_distance(legs: DataFrame, airports: DataFrame, *, dep: str, arr: str,
                    code: str = "airport_code", lat: str = "latitude_rad",
                    lon: str = "longitude_rad", out: str = "great_circle_distance",
                    radius: float = EARTH_RADIUS_MILES) -> DataFrame:
    """Adds ``out`` to every leg (left join on the airport pair; NULL when
    either airport is unknown)."""
    dist = airport_pair_distances(legs, airports, dep=dep, arr=arr, code=code, lat=lat,
                                  lon=lon, out=out, radius=radius)
    dist = dist.withColumnsRenamed({dep: "_g_dep", arr: "_g_arr"})
    out_df = left_join(legs, dist, [(dep, "_g_dep"), (arr, "_g_arr")])
    return out_df.drop("_g_dep", "_g_arr")
