"""Nearest packed observation (weather reading) per airport and time.

Input observations come packed: one row per (airport, month) with an array
of ``"<id><sep><timestamp>"`` strings. A leg at time ``t`` may use every
reading of the months ``yyyyMM(t - pad)`` .. ``yyyyMM(t + pad)`` at its
airport, and takes the one nearest in whole seconds; a tie goes to the
earlier reading, then to the smallest id.

Exploding the month arrays against every leg costs legs x readings-per-month,
and ranges of time between readings cost as many rows as there are hours without
one. Instead the unpacked readings and the legs' points are put into one frame
and sorted by time inside (airport, month, day): each point sees the last reading
not after it and the next one after it, which alone can be nearest. Where its day
has none on a side, it is that of the nearest other day that has, from a small
table of one row per (airport, month, day). Every row is shipped once, whatever
the time between readings, and a busy airport-month is spread over its days.
Distinct (airport, time) points are resolved once and joined back to the legs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import common_time_type, epoch_seconds, month_key
from .ranges import left_join

# Default bucket for the nearest reading on each side (1 day).
DAY_SECONDS = 24 * 3600


def observation_gaps(packed: DataFrame, *, airport: str = "airport_str",
                     month: str = "metar_year_month", readings: str = "metar_arr",
                     sep: str = "@", ts_type: str = "timestamp_ntz") -> DataFrame:
    """Unpack the readings, the ends of the gaps between them: one row per
    reading.

    Columns: ``_ap, _ym, _s`` (whole epoch seconds) and ``_id``. Unparseable
    reading times are skipped, and so are rows whose month is not a ``yyyyMM``:
    no leg's month equals such a key.
    """
    parts = F.split(F.col("_r"), sep)
    return (packed.select(F.col(airport).alias("_ap"), F.col(month).cast("string").alias("_ym"),
                          F.explode(readings).alias("_r"))
            .select("_ap", "_ym", F.get(parts, 0).alias("_id"),
                    F.unix_timestamp(F.expr(f"try_cast(get(split(_r, '{sep}'), 1) AS {ts_type})"))
                    .alias("_s"))
            .where(F.col("_s").isNotNull() & F.col("_ap").isNotNull()
                   & F.col("_ym").rlike("^[0-9]{4}(0[1-9]|1[0-2])$")))


def _nearest(points: DataFrame, gaps: DataFrame, out: str, pad_hours: int, bucket_seconds: int,
             max_gap: int | None) -> DataFrame:
    """Distinct points (_ap, _at) with ``out`` = id of the nearest reading."""
    pad = f"INTERVAL {pad_hours} HOURS"
    pts = (points.where(F.col("_ap").isNotNull() & F.col("_at").isNotNull()).distinct()
           .withColumn("_s", epoch_seconds("_at"))
           .withColumn("_ym", F.explode(F.array_distinct(F.array(
               month_key(F.col("_at") - F.expr(pad)), month_key(F.col("_at") + F.expr(pad)))))))
    rows = (gaps.select("_ap", "_ym", "_s", "_id", F.lit(0).alias("_point"),
                        F.lit(None).cast(pts.schema["_at"].dataType).alias("_at"))
            .unionByName(pts.select("_ap", "_ym", "_s", F.lit(None).cast("string").alias("_id"),
                                    F.lit(1).alias("_point"), "_at"))
            .withColumn("_b", F.floor(F.col("_s") / F.lit(bucket_seconds)).cast("long")))
    reading = F.col("_point") == 0
    key = ["_ap", "_ym", "_b"]
    # of the readings of one second the smallest id comes last both ways; a point
    # comes after those of its own second, which are the earlier side's
    seen = F.last(F.when(reading, F.struct("_s", "_id")), ignorenulls=True)
    to, back = (Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
                for order in ([F.col("_s").asc(), F.col("_point").asc(), F.col("_id").desc()],
                              [F.col("_s").desc(), F.col("_point").desc(), F.col("_id").desc()]))
    own = rows.withColumns({"_p": seen.over(to), "_n": seen.over(back)}).where(~reading)
    # the nearest reading of the earlier and of the later buckets
    ends = rows.groupBy(*key).agg(
        F.min(F.when(reading, F.struct((-F.col("_s")).alias("_s"), "_id"))).alias("_last"),
        F.min(F.when(reading, F.struct("_s", "_id"))).alias("_first"))
    earlier, later = (Window.partitionBy("_ap", "_ym").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
                      for order in (F.col("_b").asc(), F.col("_b").desc()))
    last = F.when(F.col("_last").isNotNull(),
                  F.struct((-F.col("_last._s")).alias("_s"), F.col("_last._id").alias("_id")))
    ends = ends.select(*key, F.last(last, ignorenulls=True).over(earlier).alias("_cp"),
                       F.last("_first", ignorenulls=True).over(later).alias("_cn"))
    cands = own.join(ends, key).select("_ap", "_at", "_s", F.explode(F.array(
        F.coalesce("_p", "_cp"), F.coalesce("_n", "_cn"))).alias("_c")).where(F.col("_c").isNotNull())
    cands = cands.select("_ap", "_at", F.col("_c._id").alias("_id"), (F.col("_c._s") - F.col("_s")).alias("_d"))
    if max_gap is not None:
        cands = cands.where(F.abs("_d") <= max_gap)
    return cands.groupBy("_ap", "_at").agg(
        F.min(F.struct(F.abs("_d"), F.signum("_d"), F.col("_id").alias("id"))).alias("_best")).select(
        "_ap", "_at", F.col("_best.id").alias(out))


def nearest_observation_table(legs: DataFrame, gaps: DataFrame, *, airport: str, at: str,
                              out: str, pad_hours: int = 5,
                              bucket_seconds: int = DAY_SECONDS,
                              max_gap: int | None = None) -> DataFrame:
    """Distinct ``(airport, at)`` points of ``legs`` with ``out`` = id of the
    nearest reading (points without a reachable reading, or whose nearest one is
    more than ``max_gap`` seconds away, are absent)."""
    points = legs.select(F.col(airport).alias("_ap"), F.col(at).alias("_at"))
    return _nearest(points, gaps, out, pad_hours, bucket_seconds, max_gap).withColumnsRenamed(
        {"_ap": airport, "_at": at})


def nearest_observations(legs: DataFrame, gaps: DataFrame, ends: Mapping[str, tuple[str, str]],
                         pad_hours: int = 5, bucket_seconds: int = DAY_SECONDS,
                         max_gap: int | None = None) -> DataFrame:
    """Adds for each ``out: (airport column, time column)`` of ``ends`` the id of
    the nearest reading (NULL when the airport/time is NULL or no reading is
    reachable). ``gaps`` comes from :func:`observation_gaps`. A reading more
    than ``max_gap`` seconds away gives NULL; without ``max_gap`` any reachable
    reading will do. The points of all ends are looked up together."""
    kind = common_time_type(*[legs.schema[at].dataType for _, at in ends.values()])
    points = [legs.select(F.col(a).alias("_ap"), F.col(at).cast(kind).alias("_at")) for a, at in ends.values()]
    both = points[0]
    for p in points[1:]:
        both = both.unionByName(p)
    best = _nearest(both, gaps, "_id", pad_hours, bucket_seconds, max_gap)
    for out, (a, at) in ends.items():
        found = best.withColumnsRenamed({"_ap": "_w_ap", "_at": "_w_at", "_id": out})
        legs = left_join(legs, found, [(a, "_w_ap"), (at, "_w_at")]).drop("_w_ap", "_w_at")
    return legs


def nearest_observation(legs: DataFrame, gaps: DataFrame, *, airport: str, at: str, out: str,
                        **how) -> DataFrame:
    """``nearest_observations`` of one end."""
    return nearest_observations(legs, gaps, {out: (airport, at)}, **how)
