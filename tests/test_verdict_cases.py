"""Rows that only odd inputs have: repeated and NULL flight ids, far-future
ends, mixed time types, bad month keys, large months."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import frame, ts
from pyspark.sql import functions as F

from contrail import operators as op
from contrail.operators.ranges import binned_range_join, interval_bins, is_long, left_join, measure
from contrail.sources import sink

LEGS = "leg_id long, key long, start_ts timestamp_ntz, end_ts timestamp_ntz"


def test_a_flight_listed_twice_is_one_row(spark):
    legs = frame(spark, LEGS, [
        (1, 7, ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00")),
        (1, 7, ts("2024-01-01 10:01:00"), ts("2024-01-01 12:00:00")),
        (None, 7, ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00")),
        (None, 7, ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00"))])
    recs = frame(spark, "rec_id long, key long, rec_ts timestamp_ntz",
                 [(7, 7, ts("2024-01-01 10:30:00"))])
    out = op.interval_match(legs, recs, leg_id="leg_id", keys=["key"], start="start_ts",
                            end="end_ts", rec_ts="rec_ts", rec_id="rec_id")
    got = sorted(((r.leg_id, r.rec_ids) for r in out.collect()), key=repr)
    assert got == sorted([(1, [7]), (None, []), (None, [])], key=repr)


def nearest(spark, left, obs):
    return op.nearest_match(
        frame(spark, "id long, rec long, key long, lo timestamp_ntz, hi timestamp_ntz, at timestamp_ntz", left),
        frame(spark, "key long, o_ts timestamp_ntz, o long", obs), row_key=["rec", "key"], id_col="id",
        keys=["key"], lo="lo", hi="hi", at="at", obs_ts="o_ts", tiebreak="o", obs_cols=["o"])


def test_unkeyed_rows_of_one_key_keep_their_own_candidates(spark):
    day = lambda h: ts(f"2024-01-01 {h:02d}:00:00")
    left = [(None, 5, 7, day(1), day(3), day(2)), (None, 5, 7, day(11), day(13), day(12))]
    obs = [(7, day(2), 100), (7, day(12), 200)]
    got = sorted((r.lo.hour, r.o) for r in nearest(spark, left, obs).collect())
    assert got == [(1, 100), (11, 200)]


def test_keyed_rows_fanned_out_become_one_with_the_best_candidate(spark):
    day = lambda h, m=0: ts(f"2024-01-01 {h:02d}:{m:02d}:00")
    left = [(1, 5, 7, day(1), day(3), day(2)), (1, 6, 7, day(1), day(3), day(2, 30)),
            (2, 9, 7, day(20), day(21), day(20)), (2, 8, 7, day(20), day(21), day(20)),
            (3, None, 7, None, day(3), day(2))]
    obs = [(7, day(2, 28), 100), (7, day(1, 30), 200)]
    got = sorted(((r.id, r.rec, r.o) for r in nearest(spark, left, obs).collect()), key=repr)
    assert got == sorted([(1, 6, 100), (2, 8, None), (3, None, None)], key=repr)


def test_far_future_ends_take_a_few_dozen_ranges(spark):
    far = frame(spark, "lo timestamp_ntz, hi timestamp_ntz", [
        (ts("2024-01-01 00:00:00"), ts("9999-12-31 23:59:59")),
        (ts("0001-01-01 00:00:00"), ts("9999-12-31 23:59:59")),
        *[(ts("2024-01-01 00:00:00"), ts("2024-01-01 02:00:00"))] * 20,
        (ts("2024-01-02 00:00:00"), ts("2024-01-01 02:00:00")), (None, ts("2024-01-01 02:00:00"))])
    minutes = [ts("2024-01-01 00:00:00") + dt.timedelta(minutes=7 * i) for i in range(60_000)]
    points = frame(spark, "t timestamp_ntz", [(t,) for t in [*minutes, ts("9999-01-01 00:00:00")]])
    r = measure(points, far, "t", "lo", "hi")
    # nine in ten intervals are no longer than a range; one far point changes nothing
    assert r.width == 8192 and r.has_long and r.last < 1_800_000_000
    rows = far.select(F.size(interval_bins("lo", "hi", r, r.width)).alias("n"), is_long("lo", "hi", r).alias("long"),
                      F.size(interval_bins("lo", "hi", r, r.wide)).alias("w")).collect()
    assert [x.long for x in rows[:3]] == [True, True, False]
    assert max(x.w for x in rows[:2]) <= 66 and {x.n for x in rows[2:22]} <= {1, 2}
    assert rows[22].n in (None, -1) and rows[23].n in (None, -1)
    assert not measure(points, far.where("false"), "t", "lo", "hi").has_long
    assert measure(points.where("false"), far, "t", "lo", "hi").last == 0


def test_points_are_shipped_once(spark):
    """No row of the point side is multiplied before the join."""
    pts = frame(spark, "k long, t timestamp_ntz", [(1, ts("2024-01-01 00:00:00") + dt.timedelta(hours=h))
                                                   for h in range(500)])
    ivs = frame(spark, "k long, lo timestamp_ntz, hi timestamp_ntz", [
        (1, ts("2024-01-01 00:00:00") + dt.timedelta(hours=h), ts("2024-01-01 03:00:00") + dt.timedelta(hours=h))
        for h in range(0, 500, 4)])
    plan = binned_range_join(pts, ivs, ["k"], "t", "lo", "hi")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert "Generate explode" not in plan[plan.index("_cr_bin#"):plan.index("Generate explode")]


def test_range_join_equals_the_plain_join_with_long_intervals_and_a_hot_key(spark):
    rnd = random.Random(5)
    base = ts("2020-01-01 00:00:00")
    pts = [(i, rnd.choice([1, 1, 1, 2, None]), base + dt.timedelta(minutes=rnd.randint(0, 4_000_000)))
           for i in range(600)] + [(900, 1, None), (901, 2, ts("9999-01-01 00:00:00"))]
    ivs = []
    for i in range(120):
        lo = base + dt.timedelta(minutes=rnd.randint(0, 4_000_000))
        hi = rnd.choice([lo + dt.timedelta(minutes=rnd.choice([0, 10, 5000, 900_000])), None,
                         ts("9999-12-31 23:59:59"), lo - dt.timedelta(days=1)])
        ivs.append((i, rnd.choice([1, 1, 2, None]), lo, hi))
    p = frame(spark, "p long, k long, at timestamp_ntz", pts)
    i = frame(spark, "i long, k2 long, lo timestamp_ntz, hi timestamp_ntz", ivs)
    want = sorted((a, b) for a, k, t in pts for b, k2, lo, hi in ivs
                  if None not in (k, t, k2, hi) and k == k2 and lo <= t <= hi)
    for width in (3600, 30 * 86400):
        got = binned_range_join(p, i, [("k", "k2")], "at", "lo", "hi", width)
        assert sorted((r.p, r.i) for r in got.collect()) == want
        kept = binned_range_join(p, i, [("k", "k2")], "at", "lo", "hi", width, how="left").collect()
        assert sorted((r.p, r.i) for r in kept if r.i is not None) == want
        assert {r.p for r in kept} == {x[0] for x in pts}


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
@pytest.mark.parametrize("point", ["date", "timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("bound", ["date", "timestamp_ntz", "timestamp"])
def test_time_types_compare_as_the_plain_join(spark, zone, point, bound):
    rnd = random.Random(2)
    base = ts("2024-03-01 00:00:00")
    pts = [(i, base + dt.timedelta(minutes=rnd.randint(0, 60_000))) for i in range(80)]
    ivs = [(i, a, a + dt.timedelta(minutes=rnd.randint(0, 9000)))
           for i in range(40) for a in [base + dt.timedelta(minutes=rnd.randint(0, 60_000))]]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        p = frame(spark, "p long, at timestamp_ntz", pts).select(
            "p", F.lit(1).alias("k"), F.col("at").cast(point).alias("at"))
        i = frame(spark, "i long, lo timestamp_ntz, hi timestamp_ntz", ivs).select(
            "i", F.lit(1).alias("k2"), F.col("lo").cast(bound).alias("lo"), F.col("hi").cast(bound).alias("hi"))
        plain = p.join(i, (F.col("at") >= F.col("lo")) & (F.col("at") <= F.col("hi")))
        want = sorted((r.p, r.i) for r in plain.select("p", "i").collect())
        got = binned_range_join(p, i, [("k", "k2")], "at", "lo", "hi", 6 * 3600)
        assert sorted((r.p, r.i) for r in got.select("p", "i").collect()) == want
        events = i.select(F.col("k2").alias("ek"), F.col("lo").alias("ev"), F.col("i").alias("v"))
        out = op.prior_events_max(p, events, key="k", at="at", event_key="ek", event_ts="ev",
                                  cols={"m": "v"})
        best = p.join(events, F.col("ev") < F.col("at"), "left").groupBy("p").agg(F.max("v").alias("m"))
        assert sorted(map(tuple, out.select("p", "m").collect())) == sorted(map(tuple, best.collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_other_types_are_refused(spark):
    p = frame(spark, "p long, at string", [(1, "2024-01-01")])
    i = frame(spark, "i long, lo timestamp_ntz, hi timestamp_ntz", [])
    with pytest.raises(TypeError):
        binned_range_join(p, i, [("p", "i")], "at", "lo", "hi", 3600)


def test_a_date_event_counts_before_a_leg_of_its_day(spark):
    legs = frame(spark, "id long, k long, at timestamp_ntz", [(1, 1, ts("2024-01-05 10:00:00"))])
    events = frame(spark, "ek long, d date, v int", [(1, dt.date(2024, 1, 5), 4)])
    out = op.prior_events_max(legs, events, key="k", at="at", event_key="ek", event_ts="d",
                              cols={"m": "v", "d": "d"}).first()
    assert out.m == 4


def test_a_bad_month_key_is_skipped(spark):
    packed = frame(spark, "airport_str string, metar_year_month string, metar_arr array<string>", [
        ("K001", "202401", ["a@2024-01-10 00:00:00"]), ("K001", "2024-1", ["b@2024-01-09 23:00:00"]),
        ("K001", "202413", ["c@2024-01-09 23:00:00"]), ("K001", None, ["d@2024-01-09 23:00:00"])])
    legs = frame(spark, "id long, ap string, at timestamp_ntz", [(1, "K001", ts("2024-01-09 23:00:00"))])
    out = op.nearest_observation(legs, op.observation_gaps(packed), airport="ap", at="at", out="m")
    assert [r.m for r in out.collect()] == ["a"]


def test_rows_without_tail_or_time_are_parents(spark):
    rows = [(1, None, ts("2024-01-01 00:00:00")), (2, None, ts("2024-01-01 00:00:00")), (3, "T", None),
            (4, "T", ts("2024-01-01 00:00:00")), (5, "T", ts("2024-01-01 00:00:00"))]
    d = frame(spark, "id long, tail string, at timestamp_ntz", rows).withColumn("end", F.col("at"))
    out = op.mark_parents(d, tail="tail", at="at", start="at", end="end", order=["at", "id"])
    assert {r.id: r.is_parent for r in out.collect()} == {1: True, 2: True, 3: True, 4: True, 5: False}


def test_null_keys_spread_and_match_nothing(spark):
    left = spark.range(1000).select(F.col("id"), F.lit(None).cast("long").alias("k"))
    right = frame(spark, "rk long, v int", [(None, 1), (0, 2)])
    out = left_join(left, right, [("k", "rk")])
    assert out.where("v is not null").count() == 0 and out.count() == 1000


def test_a_month_is_written_by_as_many_tasks_as_its_size_asks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        df = spark.range(0, 40_000, 1, 40).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"),
                                        F.lit(202401).alias("m"))
        sink.write_full(df, str(tmp_path / "t"), "m")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in (tmp_path / "t" / "m=202401").iterdir() if f.name.startswith("part-")]
    assert len(files) > 16
    assert sink.months_at(spark, str(tmp_path / "t"), "m") == {202401}
