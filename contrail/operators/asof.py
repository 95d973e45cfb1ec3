"""As-of look-up: the validity period that is open at a point, without a range
join.

Periods of one key that do not overlap need no comparison of pairs. Both sides
are put into one frame and sorted by time inside (key, time bucket); each point
then sees the last period that has begun. In a bucket before whose first period
a point lies, it is the last one of an earlier bucket, from a small table of one
row per (key, bucket). Every row is shipped once, and a busy key is spread over
its buckets. Keys whose periods do overlap are found first; they alone go
through the range join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_seconds, in_one_type
from ..session import cut_lineage
from .ranges import binned_range_join
from .siblings import previous_values

# Default time bucket (30 days).
BUCKET_SECONDS = 30 * 24 * 3600
_B = "_cr_bucket"


def _with_previous(periods: DataFrame, keys: Sequence[str], begin: str, end: str,
                   bucket_seconds: int) -> DataFrame:
    """(keys, period, before, clash): the period, the one that ends at the very
    instant at which it begins, and whether it overlaps the one before it by
    more. Sorted by begin, some neighbours overlap if any two periods do."""
    rows = periods.where(F.col(begin) <= F.col(end)).dropna(subset=list(keys))
    rows = rows.select(*keys, F.struct(*[c for c in rows.columns if c not in keys]).alias("period"),
                       F.col(begin).alias("_cr_begin"), F.col(end).alias("_cr_end"))
    rows = previous_values(rows, partition=keys, order=["_cr_begin", "_cr_end"], time_col="_cr_begin",
                           values={"before": "period"}, bucket_seconds=bucket_seconds)
    last = F.col(f"before.{end}")
    clash = (last > F.col("_cr_begin")) | (F.col(f"before.{begin}") == F.col("_cr_begin"))
    return rows.select(*keys, "period", F.when(last == F.col("_cr_begin"), F.col("before")).alias("before"),
                       F.coalesce(clash, F.lit(False)).alias("clash"))


def _open(points: DataFrame, chains: DataFrame, keys: Sequence[str], at: str, begin: str, end: str,
          bucket_seconds: int) -> DataFrame:
    """The points with a ``period`` each, for periods that touch at most."""
    more = [c for c in points.columns if c not in (*keys, at)]
    types = {f.name: f.dataType for f in points.schema}
    found = F.struct("period", "before")
    kind = chains.select(found.alias("p")).schema["p"].dataType.simpleString()
    rows = chains.select(*keys, F.col(f"period.{begin}").alias("t"), F.lit(0).alias("point"),
                         found.alias("p"), *[F.lit(None).cast(types[c]).alias(c) for c in more]).unionByName(
        points.select(*keys, F.col(at).alias("t"), F.lit(1).alias("point"), F.lit(None).cast(kind).alias("p"),
                      *more))
    rows = rows.withColumn(_B, F.floor(epoch_seconds("t") / F.lit(bucket_seconds)).cast("long"))
    begun = F.last("p", ignorenulls=True)
    upto = Window.partitionBy(*keys, _B).orderBy("t", "point").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.groupBy(*keys, _B).agg(F.max_by("p", F.when(F.col("point") == 0, F.col("t"))).alias("p"))
               .withColumn("carried", begun.over(earlier)).drop("p"))
    seen = rows.withColumn("own", begun.over(upto)).where("point = 1").join(carried, [*keys, _B])
    p = F.coalesce("own", "carried")
    held = F.filter(F.array(p["period"], p["before"]), lambda x: x[end] >= F.col("t"))
    return seen.select(*keys, F.col("t").alias(at), *more, F.explode(held).alias("period"))


def asof_lookup(points: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, begin: str, end: str,
                bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Inner join of ``points`` with ``periods`` on equal keys and
    ``begin <= at <= end``: the columns of both, in which these times have their
    common type. Apart from the keys the two must not share column names.

    The result is that of the range join for any periods: rows with a NULL key
    or time match nothing, a point at the instant at which one period ends and
    the next begins has both, and overlapping periods fan out. Equal points are
    answered each."""
    points, periods = in_one_type((points, [at]), (periods, [begin, end]))
    points = points.dropna(subset=[*keys, at])
    chains = cut_lineage(_with_previous(periods, keys, begin, end, bucket_seconds), "periods")
    mixed = chains.where("clash").select(*keys).distinct()
    split = not mixed.isEmpty()
    alone = chains.join(mixed, list(keys), "left_anti") if split else chains
    out = _open(points, alone, keys, at, begin, end, bucket_seconds).select(*points.columns, "period.*")
    if split:
        rest = chains.join(mixed, list(keys), "left_semi").select(*keys, "period.*")
        out = out.unionByName(binned_range_join(points.join(mixed, list(keys), "left_semi"), rest, keys, at,
                                                begin, end).select(*out.columns))
    return out
