"""Great-circle distance as a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecols import col_of

# Fixed value: mean Earth radius in statute miles used by the distance column.
EARTH_RADIUS_MILES = 3959.0


def great_circle_distance(lat1: Column | str, lon1: Column | str, lat2: Column | str,
                          lon2: Column | str, radius: float = EARTH_RADIUS_MILES) -> Column:
    """Distance between two points given in radians (atan2 / Vincenty form,
    well conditioned for both tiny and antipodal separations)."""
    p1, p2 = col_of(lat1), col_of(lat2)
    dlon = F.abs(col_of(lon1) - col_of(lon2))
    y = F.sqrt(
        F.pow(F.cos(p2) * F.sin(dlon), 2)
        + F.pow(F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dlon), 2)
    )
    x = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(dlon)
    return F.lit(radius) * F.atan2(y, x)
