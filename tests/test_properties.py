"""Randomised comparisons with brute force: nearest match and the dated
look-up (against the original split / union form)."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import frame

from contrail import operators as op

EPOCH = dt.datetime(1970, 1, 1)


def _secs(t: dt.datetime) -> int:
    return int((t - EPOCH).total_seconds())


def test_nearest_match_equals_brute_force(spark):
    rnd = random.Random(17)
    base = dt.datetime(2024, 1, 1)
    left = []
    for i in range(250):
        at = base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        lo = at - dt.timedelta(minutes=rnd.randint(0, 600))
        hi = at + dt.timedelta(minutes=rnd.randint(0, 600))
        lid = None if i % 10 == 0 else i          # some rows without id keep all
        left.append((lid, 1000 + i, rnd.randint(0, 2), lo, hi, at))
    obs = [(j, rnd.randint(0, 2), base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)))
           for j in range(700)]
    # duplicate instants to exercise the tie rules
    obs += [(700 + j, k, t) for j, (_, k, t) in enumerate(obs[:50])]
    L = frame(spark, "leg_id long, rec_id long, key long, lo timestamp_ntz, hi timestamp_ntz, "
                     "at timestamp_ntz", left)
    O = frame(spark, "obs_id long, key long, obs_ts timestamp_ntz", obs)
    out = op.nearest_match(L, O, row_key=["leg_id", "rec_id"], id_col="leg_id", keys=["key"],
                           lo="lo", hi="hi", at="at", obs_ts="obs_ts", tiebreak="obs_id",
                           obs_cols=["obs_id"], bin_seconds=3600)
    got = sorted(((r.leg_id, r.rec_id, r.obs_id) for r in out.collect()), key=repr)
    want = []
    for lid, rid, k, lo, hi, at in left:
        cands = [(abs(_secs(at) - _secs(t)), (_secs(at) - _secs(t) > 0) - (_secs(at) - _secs(t) < 0),
                  oid) for oid, ok, t in obs if ok == k and lo <= t <= hi]
        if not cands:
            want.append((lid, rid, None))
        elif lid is None:
            want += [(lid, rid, c[2]) for c in cands]
        else:
            want.append((lid, rid, min(cands)[2]))
    assert got == sorted(want, key=repr)


def test_dated_lookup_equals_split_union_form(spark):
    rnd = random.Random(23)
    codes = ["KAAA", "KBBB", "ABC", "KCCC", None]
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    legs = [(i, rnd.choice(codes), rnd.choice(days + [None])) for i in range(300)]
    dated, undated = [], []
    for c in codes[:4]:
        for d in days:
            if rnd.random() < 0.7:
                for _ in range(rnd.choice([1, 1, 2])):          # duplicate keys fan out
                    aid = None if rnd.random() < 0.15 else rnd.randint(1, 99)
                    dated.append((c, d, *(None if rnd.random() < 0.2 else f"d{rnd.randint(0, 9)}"
                                          for _ in range(3)), aid))
        for _ in range(rnd.choice([0, 1, 2])):
            undated.append((c, *(f"u{rnd.randint(0, 9)}" for _ in range(3)), rnd.randint(100, 199)))
    L = frame(spark, "leg_id long, code string, day date", legs)
    D = frame(spark, "icao_code string, nrl_date_year date, env_6x_id string, env_5x_id string, "
                     "env_4x_id string, env_airport_id long", dated)
    U = frame(spark, "icao_code string, env_6x_id string, env_5x_id string, env_4x_id string, "
                     "env_airport_id long", undated)
    out = op.dated_lookup(L, D, U, code="code", day="day", hit="env_airport_id",
                          ids={"a": "env_airport_id", "v6": "env_6x_id", "v5": "env_5x_id",
                               "v4": "env_4x_id"})
    got = sorted(((r.leg_id, r.a, r.v6, r.v5, r.v4) for r in out.collect()), key=repr)
    # the original form: dated left join; rows with a dated airport id stay;
    # the others take a second left join on the undated table and coalesce
    want = []
    for lid, c, d in legs:
        hits = [x for x in dated if c is not None and d is not None and x[0] == c
                and x[1] == d and len(c) == 4] or [None]
        for h in hits:
            d6, d5, d4, da = (h[2], h[3], h[4], h[5]) if h else (None,) * 4
            if da is not None:
                want.append((lid, da, d6, d5, d4))
                continue
            fb = [u for u in undated if c is not None and u[0] == c] or [None]
            for u in fb:
                u6, u5, u4, ua = (u[1], u[2], u[3], u[4]) if u else (None,) * 4
                want.append((lid, da if da is not None else ua, d6 or u6, d5 or u5, d4 or u4))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("kind", ["chained", "overlapping", "mixed"])
def test_asof_lookup_equals_the_plain_join(spark, kind):
    """Periods that touch, leave gaps, overlap, are empty, repeated or open; a
    hot key; points at the very ends, NULL and far away."""
    rnd = random.Random(kind)
    base = dt.datetime(2024, 1, 1)
    hour = lambda n: base + dt.timedelta(hours=n)
    periods, n = [], 0
    for k in (1, 2, 3, None):
        at = 0
        for _ in range(150 if k == 1 else 12):
            size, gap = rnd.choice([1, 5, 400]), rnd.choice([0, 0, 7])
            if kind == "overlapping" or (kind == "mixed" and k == 2):
                at -= rnd.choice([0, 3])
            periods.append((k, hour(at), hour(at + size), n))
            at, n = at + size + gap, n + 1
        periods += [(k, hour(at + 1), hour(at), -1), (k, None, hour(1), -2), (k, hour(1), None, -3),
                    (k, hour(at + 9), dt.datetime(9999, 1, 1), -4)]
    if kind != "chained":
        periods += [periods[3], (3, hour(0), hour(0), -5), (3, hour(0), hour(90), -6)]
    ends = [t for p in periods for t in p[1:3] if t]
    points = [(i, rnd.choice([1, 1, 1, 2, 3, 4, None]),
               rnd.choice([rnd.choice(ends), hour(rnd.randint(-50, 9000)), None])) for i in range(700)]
    p = frame(spark, "i int, k int, at timestamp_ntz", points)
    v = frame(spark, "k int, lo timestamp_ntz, hi timestamp_ntz, n int", periods)
    got = sorted((r.i, r.n) for r in op.asof_lookup(p, v, ["k"], "at", "lo", "hi",
                                                    bucket_seconds=100 * 3600).collect())
    want = sorted((i, n) for i, k, at in points for k2, lo, hi, n in periods
                  if None not in (k, at, lo, hi) and k == k2 and lo <= at <= hi)
    assert got == want and want
