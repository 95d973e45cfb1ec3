"""Dated look-up with fallback, point-in-time timeline, prior-event maxima."""

from __future__ import annotations

import datetime as dt
import random

from conftest import frame, ts

from contrail import operators as op

ENV = ("icao_code string, nrl_date_year date, env_6x_id string, env_5x_id string, "
       "env_4x_id string, env_airport_id long")
ENV_U = "icao_code string, env_6x_id string, env_5x_id string, env_4x_id string, env_airport_id long"


def test_dated_lookup_with_fallback(spark):
    d = dt.date(2024, 1, 5)
    legs = frame(spark, "leg_id long, code string, day date", [
        (1, "KAAA", d),        # dated hit, one version id NULL: stays NULL
        (2, "KBBB", d),        # dated row with NULL airport id: fallback fills the gaps
        (3, "ABC", d),         # length 3: dated skipped, fallback used
        (4, "KZZZ", d),        # no hit at all
        (5, "KAAA", dt.date(2024, 1, 6)),  # other day: fallback
    ])
    dated = frame(spark, ENV, [("KAAA", d, "d6", None, "d4", 100),
                               ("KBBB", d, "b6", None, None, None),
                               ("ABC", d, "x6", "x5", "x4", 300)])
    undated = frame(spark, ENV_U, [("KAAA", "u6", "u5", "u4", 900),
                                   ("KBBB", "v6", "v5", "v4", 901),
                                   ("ABC", "w6", "w5", "w4", 902)])
    out = op.dated_lookup(legs, dated, undated, code="code", day="day", hit="env_airport_id",
                          ids={"env_id": "env_airport_id", "v6": "env_6x_id",
                               "v5": "env_5x_id", "v4": "env_4x_id"})
    got = {r.leg_id: (r.env_id, r.v6, r.v5, r.v4) for r in out.collect()}
    assert got == {1: (100, "d6", None, "d4"), 2: (901, "b6", "v5", "v4"),
                   3: (902, "w6", "w5", "w4"), 4: (None, None, None, None),
                   5: (900, "u6", "u5", "u4")}


def test_timeline_lookup_closed_bounds_and_coalesce(spark):
    legs = frame(spark, "leg_id long, k long, at timestamp_ntz, model string", [
        (1, 1, ts("2024-01-10 00:00:00"), None),   # exactly on a boundary: two periods
        (2, 1, ts("2024-01-05 00:00:00"), "keep"),  # leg value wins
        (3, 1, None, None),                          # NULL time: no match
        (4, 2, ts("2024-01-05 00:00:00"), None),   # open period (NULL end): no match
    ])
    tl = frame(spark, "tk long, b timestamp_ntz, e timestamp_ntz, m string", [
        (1, ts("2024-01-01 00:00:00"), ts("2024-01-10 00:00:00"), "m1"),
        (1, ts("2024-01-10 00:00:00"), ts("2024-02-01 00:00:00"), "m2"),
        (2, ts("2024-01-01 00:00:00"), None, "m3"),
    ])
    out = op.timeline_lookup(legs, tl, keys=[("k", "tk")], at="at", begin="b", end="e",
                             cols={"_m": "m"}, coalesce_into={"model": "_m"},
                             bucket_seconds=86400)
    got = sorted((r.leg_id, r.model) for r in out.collect())
    assert got == [(1, "m1"), (1, "m2"), (2, "keep"), (3, None), (4, None)]


HIST = "ek string, ets timestamp_ntz, r int, v int"


def test_prior_events_edges(spark):
    legs = frame(spark, "id string, esn string, at timestamp_ntz", [
        ("a", "E1", ts("2024-01-10 00:00:00")),
        ("b", None, ts("2024-01-10 00:00:00")),
        ("c", "E1", None),
        (None, "E1", ts("2024-01-10 00:00:00")),
    ])
    ev = frame(spark, HIST, [
        ("E1", ts("2024-01-10 00:00:00"), 99, 99),   # same instant: excluded
        ("E1", ts("2024-01-01 00:00:00"), 5, 1),
        ("E1", ts("2023-06-01 00:00:00"), 2, 7),     # maxima come from different rows
        ("E1", None, 50, 50),                         # NULL date: ignored
    ])
    out = op.prior_events_max(legs, ev, key="esn", at="at", event_key="ek", event_ts="ets",
                              require="id", cols={"d": "ets", "r": "r", "v": "v"})
    got = sorted(((r.id, r.d, r.r, r.v) for r in out.collect()), key=repr)
    assert got == sorted([("a", ts("2024-01-01 00:00:00"), 5, 7), ("b", None, None, None),
                          ("c", None, None, None), (None, None, None, None)], key=repr)


def test_prior_events_equals_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    legs = [(str(i), f"E{rnd.randint(0, 2)}",
             base + dt.timedelta(hours=rnd.randint(0, 24 * 200))) for i in range(300)]
    ev = [(f"E{rnd.randint(0, 2)}", base + dt.timedelta(hours=rnd.randint(-500, 24 * 200)),
           rnd.randint(0, 100), rnd.randint(0, 100)) for _ in range(500)]
    L = frame(spark, "id string, esn string, at timestamp_ntz", legs)
    E = frame(spark, HIST, ev)
    for bucket in (3600, 86400 * 7, 86400 * 365):
        out = op.prior_events_max(L, E, key="esn", at="at", event_key="ek", event_ts="ets",
                                  cols={"d": "ets", "r": "r"}, bucket_seconds=bucket)
        got = {r.id: (r.d, r.r) for r in out.collect()}
        for lid, esn, at in legs:
            prior = [(t, r) for k, t, r, _ in ev if k == esn and t < at]
            want = (max(t for t, _ in prior), max(r for _, r in prior)) if prior else (None, None)
            assert got[lid] == want
