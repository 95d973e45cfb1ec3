"""Nearest packed observation and great-circle distance."""

from __future__ import annotations

import datetime as dt
import math
import random

from conftest import frame, ts

from contrail import operators as op
from contrail.functions import great_circle_distance

EPOCH = dt.datetime(1970, 1, 1)


def _secs(t: dt.datetime) -> int:
    return int((t - EPOCH).total_seconds())


PACKED = "airport_str string, metar_year_month string, metar_arr array<string>"
LEGS = "leg_id long, ap string, at timestamp_ntz"


def _nearest(spark, legs, packed):
    gaps = op.observation_gaps(spark.createDataFrame(packed, PACKED))
    out = op.nearest_observation(spark.createDataFrame(legs, LEGS), gaps, airport="ap",
                                 at="at", out="wx")
    return {r.leg_id: r.wx for r in out.collect()}


def test_ties_gaps_and_bad_readings(spark):
    packed = [
        ("KAAA", "202401", ["a@2024-01-10 09:00:00", "b@2024-01-10 11:00:00",
                            "c@junk", "d", "e@2024-01-10 11:00:00.5"]),
        ("KBBB", "202401", []),
        ("KCCC", "202312", ["x@2023-12-31 22:00:00"]),
        ("KCCC", "202401", ["y@2024-01-01 03:00:00"]),
    ]
    legs = [
        (1, "KAAA", ts("2024-01-10 10:00:00")),   # equal distance: earlier reading wins
        (2, "KAAA", ts("2024-01-10 11:00:00")),   # same second: smallest id (b < e)
        (3, "KBBB", ts("2024-01-10 10:00:00")),   # empty array
        (4, None, ts("2024-01-10 10:00:00")),     # NULL airport
        (5, "KCCC", ts("2024-01-01 00:30:00")),   # New Year: both months reachable
        (6, "KCCC", ts("2024-01-01 05:30:00")),   # only January reachable
        (7, "KAAA", ts("2024-03-10 10:00:00")),   # no month row in reach
    ]
    assert _nearest(spark, legs, packed) == {1: "a", 2: "b", 3: None, 4: None, 5: "x",
                                             6: "y", 7: None}


def test_gap_index_equals_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    packed, readings = [], {}
    for ap in ("K1", "K2"):
        for ym, start in (("202312", dt.datetime(2023, 12, 1)), ("202401", base)):
            arr = []
            for i in range(rnd.randint(0, 25)):
                t = start + dt.timedelta(seconds=rnd.randint(0, 31 * 86400))
                rid = f"{ap}{ym}{i:03d}"
                arr.append(f"{rid}@{t.isoformat(sep=' ')}")
                readings.setdefault((ap, ym), []).append((rid, t))
            packed.append((ap, ym, arr))
    legs = [(i, rnd.choice(["K1", "K2"]),
             dt.datetime(2023, 12, 1) + dt.timedelta(seconds=rnd.randint(0, 62 * 86400)))
            for i in range(200)]

    def ym(t):
        return t.strftime("%Y%m")

    want = {}
    for lid, ap, at in legs:
        cands = []
        for m in {ym(at - dt.timedelta(hours=5)), ym(at + dt.timedelta(hours=5))}:
            for rid, t in readings.get((ap, m), []):
                d = _secs(t) - _secs(at)
                cands.append((abs(d), (d > 0) - (d < 0), rid))
        want[lid] = min(cands)[2] if cands else None
    assert _nearest(spark, legs, packed) == want


def test_rare_readings_cost_a_row_each(spark):
    """The time between readings makes no rows; the nearest may be days away on either side."""
    packed = [("K1", "202401", ["a@2024-01-01 12:00:00", "c@2024-01-31 12:00:00", "b@2024-01-31 12:00:00.9"]),
              ("K1", "202401", ["d@2024-01-15 00:00:00"]), ("K1", "202402", ["e@2024-02-28 00:00:00"])]
    gaps = op.observation_gaps(spark.createDataFrame(packed, PACKED))
    assert gaps.count() == 5
    legs = [(1, "K1", ts("2024-01-01 00:00:00")), (2, "K1", ts("2024-01-08 06:00:00")),
            (3, "K1", ts("2024-01-08 05:59:59")), (4, "K1", ts("2024-01-31 23:00:00")),
            (5, "K1", ts("2024-02-05 00:00:00")), (6, "K1", ts("2024-01-24 00:00:00")), (7, "K2", ts("2024-01-24 00:00:00"))]
    assert _nearest(spark, legs, packed) == {1: "a", 2: "a", 3: "a", 4: "b", 5: "e", 6: "b", 7: None}


def test_a_greatest_gap_needs_no_rows_between_readings(spark):
    packed = spark.createDataFrame([("K1", "202401", ["a@2024-01-01 12:00:00", "b@2024-01-31 12:00:00"])], PACKED)
    legs = spark.createDataFrame([(1, "K1", ts("2024-01-01 12:30:00")), (2, "K1", ts("2024-01-01 12:30:01")),
                                  (3, "K1", ts("2024-01-31 11:30:00")), (4, "K1", ts("2024-01-16 00:00:00"))], LEGS)
    out = op.nearest_observation(legs, op.observation_gaps(packed), airport="ap", at="at", out="wx", max_gap=1800)
    assert {r.leg_id: r.wx for r in out.collect()} == {1: "a", 2: None, 3: "b", 4: None}
    assert "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_great_circle(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, math.pi),
                                (0.5, 0.1, -0.3, 2.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(great_circle_distance("a", "b", "c", "d")).collect()]
    assert abs(got[0]) < 1e-9
    assert abs(got[1] - math.pi * 3959.0) < 1e-6
    # haversine cross-check
    a, b, c, d = 0.5, 0.1, -0.3, 2.0
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    assert abs(got[2] - 2 * 3959.0 * math.asin(math.sqrt(h))) < 1e-6


def test_pair_distances_fan_out_and_missing(spark):
    legs = frame(spark, "leg_id long, dep string, arr string",
                 [(1, "A", "B"), (2, "A", "Z"), (3, None, "B"), (4, "A", "A")])
    airports = frame(spark, "airport_code string, latitude_rad double, longitude_rad double",
                     [("A", 0.0, 0.0), ("A", 0.0, 0.0), ("B", 0.0, 1.0), ("B", 0.1, 1.0)])
    out = op.attach_distance(legs, airports, dep="dep", arr="arr")
    got = sorted((r.leg_id, None if r.great_circle_distance is None
                  else round(r.great_circle_distance, 3)) for r in out.collect())
    # duplicate equal coordinates collapse; different coordinates fan out
    assert [g[0] for g in got] == [1, 1, 2, 3, 4]
    assert got[2][1] is None and got[3][1] is None and got[4][1] == 0.0
