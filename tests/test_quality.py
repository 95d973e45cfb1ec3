"""Flag profiles, mergeable sketches and the comparison of two builds."""

from __future__ import annotations

import random

from conftest import frame
from pyspark.sql import functions as F

from contrail import operators as op


def test_flag_profile_tells_null_groups_from_totals(spark):
    df = frame(spark, "family string, m int, a string, b string", [
        ("x", 1, "t", "f"), ("x", 2, "t", "t"), (None, 1, "f", None), ("y", None, "f", "t")])
    got = {(r["flag"], r["family"], r["m"], r["level"]): (r["n_rows"], r["n_set"])
           for r in op.flag_profile(df, ["a", "b"], ["family", "m"]).collect()}
    assert got["a", None, None, 3] == (4, 2) and got["b", None, None, 3] == (4, 2)
    assert got["a", "x", None, 1] == (2, 2) and got["a", None, None, 1] == (1, 0)
    assert got["b", None, 1, 2] == (2, 0) and got["b", None, None, 2] == (1, 1)
    assert got["a", "x", 1, 0] == (1, 1) and got["b", "y", None, 0] == (1, 1)
    assert len(got) == 2 * (4 + 3 + 3 + 1)
    assert op.flag_profile(df.where("false"), ["a"], ["family"]).where("level = 0").collect() == []


def test_month_sketches_merge_to_the_whole(spark):
    rnd = random.Random(2)
    rows = [(202401 + i % 12, f"T{rnd.randint(0, 3000)}", float(rnd.gauss(0, 1))) for i in range(20_000)]
    df = frame(spark, "m int, tail string, d double", [*rows, (202401, None, None)])
    sketches = op.month_sketches(df, "m", ["tail"], ["d"])
    assert sketches.count() == 12 and sum(r["n_rows"] for r in sketches.collect()) == 20_001
    for since in (None, 202407):
        got = op.merged_sketches(sketches, "m", since).first()
        mine = [r for r in rows if since is None or r[0] >= since]
        exact = len({r[1] for r in mine})
        assert abs(got["distinct_tail"] - exact) <= 0.03 * exact  # standard error 0.8 % at lg_k 14
        ordered = sorted(r[2] for r in mine)
        for rank, q in zip((0.5, 0.9), got["quantiles_d"]):
            below = sum(x <= q for x in ordered) / len(ordered)
            assert abs(below - rank) < 0.03  # rank error 1.3 % at k 200
    # the months merged and one sketch over all agree within the same error
    one = op.merged_sketches(op.month_sketches(df.withColumn("m", F.lit(1)), "m", ["tail"], []), "m").first()
    both = op.merged_sketches(sketches, "m").first()["distinct_tail"]
    assert abs(one["distinct_tail"] - both) <= 0.03 * both


def test_reconcile_finds_planted_differences(spark):
    schema = "k int, k2 string, v int, w string"
    left = [(i, "a", i % 7, f"w{i}") for i in range(200)] + [(None, None, 1, "n"), (None, None, None, "n")]
    right = [r for r in left if r[0] is None or r[0] % 10]
    right = [(a, b, v + 1 if a and a % 10 == 3 else v, None if a and a % 10 in (3, 4) else w)
             for a, b, v, w in right] + [(900, "a", 1, "x"), (1, "a", 1, "w1"), (None, None, 1, "n")]
    got = {r["column"]: r.asDict() for r in op.reconcile(
        frame(spark, schema, left), frame(spark, schema, right), ["k", "k2"]).collect()}
    assert (got["(rows)"]["n_equal"], got["(rows)"]["n_left"], got["(rows)"]["n_right"]) == (182, 20, 3)
    assert (got["v"]["n_equal"], got["v"]["n_differ"]) == (162, 20)
    assert (got["w"]["n_equal"], got["w"]["n_differ"]) == (142, 40)
    same = op.reconcile(frame(spark, schema, left), frame(spark, schema, left[::-1]), ["k", "k2"]).collect()
    assert all(not (r["n_differ"] or r["n_left"] or r["n_right"]) for r in same)
    empty = op.reconcile(frame(spark, schema, []), frame(spark, schema, []), ["k", "k2"]).collect()
    assert {r["n_equal"] for r in empty} == {0}
