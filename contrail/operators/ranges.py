"""Point-in-interval joins as equi-joins on time ranges that fit the data.

Every range join in the stitching job has the shape ``keys equal AND
lo <= point <= hi``. Planned as written, Spark hashes on the keys only and
tests the range per candidate pair, so one hot key (an aircraft, an engine,
an airport) turns into an all-pairs loop inside one task. Here time is cut into
ranges of one width, and the range becomes one more equi-key: an interval goes
to each range that it overlaps, a point to its own.

* one aggregate over both sides (``measure``) learns how long the intervals are
  and which time the points span: nine in ten of the intervals are no longer
  than the width, and times far off count as the edge of what the points span;
* a point is in exactly one range, so it is shipped once, and every matching
  pair is produced exactly once -- no dedupe step;
* the intervals longer than 64 ranges, where there are any, are a side list
  that meets the points of its own keys in ranges of a 64th of the whole span;
* work per (key, range) is bounded by the data density, not by the size of the
  key, and a hot key is spread over many shuffle partitions;
* with ``how="left"`` the point side is preserved exactly as a plain left
  join would preserve it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import col_of, epoch_seconds, in_one_type

BIN = "_cr_bin"

STEP = 64      # ranges of an interval at most, and one or two more where it begins and ends
SHARE = 0.9    # of the intervals that are no longer than a range

_NS_L, _NS_R = "_cr_nsl", "_cr_nsr"


def null_salt(df: DataFrame, key_cols: Sequence[Column | str]) -> Column:
    """0 for rows whose key columns are all non-NULL, else a hash of the whole
    row: rows that can never match spread over all partitions instead of
    meeting in the one of the NULL key (retries rebuild the same value)."""
    any_null = None
    for c in key_cols:
        e = col_of(c).isNull()
        any_null = e if any_null is None else (any_null | e)
    # xxhash64(*) expands to every column on the JVM side (one expression)
    return F.when(any_null, F.expr("xxhash64(*)")).otherwise(F.lit(0).cast("long"))


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]],
              extra: Sequence[Column] = ()) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``left[a] == right[b]`` for each
    ``(a, b)`` in ``keys`` plus the ``extra`` conditions.

    Left rows with a NULL key can never match, but plain hash partitioning
    sends all of them to the one partition of the NULL key. They are salted
    here (the salt is one more equi-key) so they spread over many
    partitions; matching is unchanged. The right side's salt is 0, or -1 for
    its own NULL-key rows (which match nothing either) -- a non-constant
    expression, so the optimizer keeps it as a shuffle key.
    """
    lk = [a for a, _ in keys]
    rk_null = None
    for _, b in keys:
        e = F.col(b).isNull()
        rk_null = e if rk_null is None else (rk_null | e)
    l = left.withColumn(_NS_L, null_salt(left, lk))
    r = right.withColumn(_NS_R, F.when(rk_null, F.lit(-1).cast("long"))
                         .otherwise(F.lit(0).cast("long")))
    cond = [F.col(a) == F.col(b) for a, b in keys] + list(extra)
    cond.append(F.col(_NS_L) == F.col(_NS_R))
    return l.join(r, on=cond, how="left").drop(_NS_L, _NS_R)


@dataclass(frozen=True)
class Ranges:
    """Widths in seconds, and the first and last second of the points."""

    width: int
    wide: int        # of the side list's ranges
    has_long: bool   # whether there are intervals of more than ``STEP`` ranges
    first: int       # nearly all points lie from here
    last: int        # to here; times beyond count as these


def measure(points: DataFrame, intervals: DataFrame, point_ts: str, lo: str, hi: str,
            bin_seconds: int | None = None) -> Ranges:
    """The ranges for a join of these frames, from one aggregate over both: the
    intervals counted by the power of two of their length, and the seconds
    between which all but two in a thousand points lie. ``bin_seconds`` sets the width. A superset of the rows that
    are joined will do."""
    none = F.lit(None).cast("long")
    of_points = points.select(epoch_seconds(point_ts).alias("t"), none.alias("p"))
    seconds = epoch_seconds(hi) - epoch_seconds(lo) + 1
    of_intervals = intervals.where(seconds > 0).select(
        none.alias("t"), F.length(F.bin(seconds)).cast("long").alias("p"))
    found = of_points.unionByName(of_intervals).groupBy("p").agg(
        F.count("*").alias("n"), F.percentile_approx("t", [0.001, 0.999]).alias("span")).collect()
    counts = {r["p"]: r["n"] for r in found if r["p"] is not None}
    spans = [r["span"] for r in found if r["p"] is None and r["span"]]
    first, last = spans[0] if spans else (0, 0)
    wide = max(1, -(-(last - first + 1) // STEP))
    width = bin_seconds
    if width is None:
        usual = sorted((p, n) for p, n in counts.items() if 1 << p <= wide)
        held, every, width = 0, sum(n for _, n in usual), wide
        for p, n in usual:
            held += n
            if held >= SHARE * every:
                width = 1 << p
                break
    # a length is less than 2 ** p, and no more than the points' span counts
    longest = min(max(counts, default=0), (last - first + 1).bit_length())
    return Ranges(width, max(width, wide), 1 << longest > STEP * width * 2, first, last)


def _range(ts: Column | str, r: Ranges, width: int) -> Column:
    """Number of the range. It never falls as ``ts`` grows, so that
    ``lo <= p <= hi`` implies the same of the ranges; whole seconds suffice."""
    seconds = F.least(F.greatest(epoch_seconds(ts), F.lit(r.first)), F.lit(r.last))
    return F.floor(seconds / F.lit(width)).cast("long")


def is_long(lo: Column | str, hi: Column | str, r: Ranges) -> Column:
    """Whether the interval overlaps more than ``STEP`` + 1 ranges."""
    return _range(hi, r, r.width) - _range(lo, r, r.width) > STEP


def interval_bins(lo: Column | str, hi: Column | str, r: Ranges, width: int) -> Column:
    """The ranges of ``width`` that ``[lo, hi]`` overlaps; NULL (no rows) when
    either end is NULL or the interval is empty."""
    return F.when(col_of(lo) <= col_of(hi), F.sequence(_range(lo, r, width), _range(hi, r, width)))


def _pairs(keys: Sequence[str | tuple[str, str]]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys]


def _meet(points: DataFrame, intervals: DataFrame, pairs: Sequence[tuple[str, str]], point_ts: str,
          lo: str, hi: str, r: Ranges, width: int, hi_inclusive: bool) -> DataFrame:
    p = points.withColumn(BIN, _range(point_ts, r, width))
    i = intervals.withColumn("_cr_ibin", F.explode(interval_bins(lo, hi, r, width)))
    t = F.col(point_ts)
    cond = [F.col(a) == F.col(b) for a, b in pairs] + [F.col(BIN) == F.col("_cr_ibin")]
    cond += [t >= F.col(lo), t <= F.col(hi) if hi_inclusive else t < F.col(hi)]
    return p.join(i, on=cond).drop(BIN, "_cr_ibin")


def binned_range_join(points: DataFrame, intervals: DataFrame,
                      keys: Sequence[str | tuple[str, str]], point_ts: str,
                      lo: str, hi: str, bin_seconds: int | None = None, how: str = "inner",
                      hi_inclusive: bool = True, ranges: Ranges | None = None) -> DataFrame:
    """``points`` joined to ``intervals`` on equal keys and
    ``lo <= point_ts <= hi`` (``< hi`` when ``hi_inclusive`` is False).

    ``keys`` holds column names present on both sides, or
    ``(points_col, intervals_col)`` pairs. Apart from the keys the two sides
    must not share column names. Key columns of ``intervals`` that have a
    different name than on ``points`` are kept; same-named ones appear once.
    The time columns come out in their common type (``how="left"``: the
    point's as it was). ``ranges`` are what ``measure`` found; without them the
    frames are measured here (one aggregate).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    pairs = _pairs(keys)
    if ranges is None:
        ranges = measure(*in_one_type((points, [point_ts]), (intervals, [lo, hi])), point_ts, lo, hi,
                         bin_seconds)
    if how == "left":
        # a match depends on the keys and the time alone: resolve these once,
        # as a narrow frame, and join back
        pk, pt = [f"_cr_pk{n}" for n in range(len(pairs))], "_cr_pt"
        narrow = points.select(*[F.col(a).alias(k) for (a, _), k in zip(pairs, pk)],
                               F.col(point_ts).alias(pt), F.col(point_ts).alias("_cr_p0"))
        narrow = narrow.dropna().distinct()
        kept = {b for a, b in pairs if a == b}
        found = binned_range_join(narrow, intervals, [(k, b) for k, (_, b) in zip(pk, pairs)], pt,
                                  lo, hi, hi_inclusive=hi_inclusive, ranges=ranges)
        found = found.drop(pt, *kept)
        joined = left_join(points, found, [*[(a, k) for (a, _), k in zip(pairs, pk)],
                                           (point_ts, "_cr_p0")])
        return joined.drop(*pk, "_cr_p0")
    points, intervals = in_one_type((points, [point_ts]), (intervals, [lo, hi]))
    same = {b for a, b in pairs if a == b}
    ik = {b: (f"_cr_ik{n}" if b in same else b) for n, (_, b) in enumerate(pairs)}
    intervals = intervals.withColumnsRenamed({b: k for b, k in ik.items() if b != k})
    on = [(a, ik[b]) for a, b in pairs]
    gone = [k for b, k in ik.items() if b != k]
    if not ranges.has_long:
        return _meet(points, intervals, on, point_ts, lo, hi, ranges, ranges.width, hi_inclusive).drop(*gone)
    long = F.coalesce(is_long(lo, hi, ranges), F.lit(False))
    usual = _meet(points, intervals.where(~long), on, point_ts, lo, hi, ranges, ranges.width, hi_inclusive)
    side = intervals.where(long)
    named = [f"_cr_sk{n}" for n in range(len(on))]
    held = side.select(*[F.col(b).alias(k) for (_, b), k in zip(on, named)]).distinct()
    concerned = points.join(held, [F.col(a) == F.col(k) for (a, _), k in zip(on, named)], "left_semi")
    rest = _meet(concerned, side, on, point_ts, lo, hi, ranges, ranges.wide, hi_inclusive)
    return usual.unionByName(rest).drop(*gone)


__all__ = ["BIN", "Ranges", "binned_range_join", "interval_bins", "is_long", "left_join", "measure",
           "null_salt"]
