"""Interval match, unmatched-record retention and nearest match (edge rows)."""

from __future__ import annotations

import datetime as dt
import random

from conftest import frame, ts
from pyspark.sql import functions as F

from contrail import operators as op

LEGS = "leg_id long, key long, start_ts timestamp_ntz, end_ts timestamp_ntz"
RECS = "rec_id long, key long, rec_ts timestamp_ntz"


def test_interval_match_boundaries(spark):
    legs = frame(spark, LEGS, [
        (1, 7, ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00")),
        (2, 7, ts("2024-01-02 10:00:00"), None),            # NULL end: no match
        (3, 8, ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00")),  # none
    ])
    recs = frame(spark, RECS, [
        (10, 7, ts("2024-01-01 09:40:00")),                  # start - 20 min: in
        (11, 7, ts("2024-01-01 09:39:59.999999")),           # 1 us earlier: out
        (12, 7, ts("2024-01-01 12:00:00")),                  # end: in
        (13, 7, ts("2024-01-02 10:30:00")),
    ])
    out = op.interval_match(legs, recs, leg_id="leg_id", keys=["key"], start="start_ts",
                            end="end_ts", rec_ts="rec_ts", rec_id="rec_id")
    got = {r.leg_id: (r.rec_id, r.rec_ids, r.rec_count) for r in out.collect()}
    assert got == {1: (12, [10, 12], 2), 2: (None, [], 0), 3: (None, [], 0)}


def test_unmatched_records_appended(spark):
    legs = frame(spark, LEGS, [(1, 7, ts("2024-01-01 10:00:00"), ts("2024-01-01 12:00:00"))])
    recs = frame(spark, RECS, [
        (10, 7, ts("2024-01-01 10:30:00")),
        (20, 7, ts("2024-01-05 10:30:00")),
        (20, 7, ts("2024-01-05 10:30:00")),   # listed twice: one row
        (None, 7, ts("2024-01-05 10:30:00")),  # NULL id stays (NULLs compare equal)
    ])
    m = op.interval_match(legs, recs, leg_id="leg_id", keys=["key"], start="start_ts",
                          end="end_ts", rec_ts="rec_ts", rec_id="rec_id")
    un = op.unmatched_records(recs, m, rec_keys=["rec_id", "key"], ids_col="rec_ids",
                              matched_keys=["key"])
    rows = op.append_unmatched(m, un, rec_id="rec_id", chosen="rec_id", ids_col="rec_ids",
                               rename={"key": "key"}, count_col="rec_count")
    got = sorted(((r.leg_id, r.rec_id, tuple(r.rec_ids)) for r in rows.collect()),
                 key=repr)
    assert got == sorted([(1, 10, (10,)), (None, 20, (20,)), (None, None, (None,))], key=repr)


def test_binned_interval_match_equals_brute_force(spark):
    rnd = random.Random(7)
    base = ts("2024-01-01 00:00:00")
    legs, recs = [], []
    for i in range(300):
        s = base + dt.timedelta(minutes=rnd.randint(0, 20000))
        e = s + dt.timedelta(minutes=rnd.randint(0, 3000))
        legs.append((i, rnd.randint(0, 3), s, e))   # few keys: hot keys
    for j in range(600):
        recs.append((1000 + j, rnd.randint(0, 3),
                     base + dt.timedelta(minutes=rnd.randint(-100, 25000))))
    L, R = frame(spark, LEGS, legs), frame(spark, RECS, recs)
    for bins in (600, 3600, 86400 * 30):
        out = op.interval_match(L, R, leg_id="leg_id", keys=["key"], start="start_ts",
                                end="end_ts", rec_ts="rec_ts", rec_id="rec_id",
                                bin_seconds=bins)
        got = {r.leg_id: tuple(r.rec_ids) for r in out.collect()}
        want = {}
        for (lid, k, s, e) in legs:
            want[lid] = tuple(sorted(rid for rid, rk, t in recs
                                     if rk == k and s - dt.timedelta(minutes=20) <= t <= e))
        assert got == want


OBS = "obs_id long, key long, obs_ts timestamp_ntz"


def test_nearest_match_ties_and_unkeyed(spark):
    left = frame(spark, "leg_id long, rec_id long, key long, lo timestamp_ntz, "
                        "hi timestamp_ntz, at timestamp_ntz", [
        (1, None, 7, ts("2024-01-01 09:00:00"), ts("2024-01-01 11:00:00"),
         ts("2024-01-01 10:00:00")),
        (None, 55, 7, ts("2024-01-01 09:00:00"), ts("2024-01-01 11:00:00"),
         ts("2024-01-01 10:00:00")),
        (2, None, 9, ts("2024-01-01 09:00:00"), ts("2024-01-01 11:00:00"),
         ts("2024-01-01 10:00:00")),
    ])
    obs = frame(spark, OBS, [
        (30, 7, ts("2024-01-01 09:50:00")),   # 10 min before
        (31, 7, ts("2024-01-01 10:10:00")),   # 10 min after: later wins the tie
        (29, 7, ts("2024-01-01 10:10:00")),   # same instant, smaller id wins
    ])
    out = op.nearest_match(left, obs, row_key=["leg_id", "rec_id"], id_col="leg_id",
                           keys=["key"], lo="lo", hi="hi", at="at", obs_ts="obs_ts",
                           tiebreak="obs_id", obs_cols=["obs_id"])
    got = sorted(((r.leg_id, r.rec_id, r.obs_id) for r in out.collect()), key=repr)
    assert got == sorted([(1, None, 29), (None, 55, 29), (None, 55, 30), (None, 55, 31),
                          (2, None, None)], key=repr)


def test_nearest_match_deals_its_rows_by_id_once(spark):
    """Repeated ids become one row, equal rows without an id too if asked; the rows are dealt
    once, by their id, and no row key is a key of a join."""
    t = ts("2024-01-01 10:00:00")
    at = [t + dt.timedelta(minutes=m) for m in (0, 5, 0, 0, 0, 0, 9)]
    ids = [(1, None), (1, 4), (2, 5), (2, 5), (None, 6), (None, 6), (3, None)]
    left = frame(spark, "leg_id long, rec_id long, key long, lo timestamp_ntz, hi timestamp_ntz, "
                        "at timestamp_ntz, pad string",
                 [(i, r, 9 if i == 3 else 7, t - dt.timedelta(hours=1), t + dt.timedelta(hours=1), a, f"p{r}")
                  for (i, r), a in zip(ids, at)])
    obs = frame(spark, OBS, [(30, 7, t + dt.timedelta(minutes=6)), (31, 7, t + dt.timedelta(hours=5))])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        how = dict(row_key=["leg_id", "rec_id"], id_col="leg_id", keys=["key"], lo="lo", hi="hi", at="at",
                   obs_ts="obs_ts", tiebreak="obs_id", obs_cols=["obs_id"])
        out = op.nearest_match(left, obs, **how, unkeyed_once=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r.leg_id, r.rec_id, r.pad, r.obs_id) for r in out.collect()), key=repr)
        every = op.nearest_match(left, obs, **how).where("leg_id IS NULL").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got == sorted([(1, 4, "p4", 30), (2, 5, "p5", 30), (3, None, "pNone", None), (None, 6, "p6", 30)],
                         key=repr)
    assert every == 2
    dealt = [line.partition("hashpartitioning(")[2] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert not any("struct(" in keys for keys in dealt)
    # once for the best of each id, once for the rows, each by the id alone
    assert len([keys for keys in dealt if keys.startswith("leg_id#") and keys.count("#") == 1]) == 2
    assert not any("_cr_one#" in keys for keys in dealt)
