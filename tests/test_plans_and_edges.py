"""Plan shape of every pipeline step, hot-key partitioning, remaining edge rows."""

from __future__ import annotations

import datetime as dt
import os
import re

from conftest import frame, ts
from pyspark.sql import functions as F

from contrail import operators as op
from contrail.plans import common_flight as cf
from contrail.session import cut_lineage
from contrail.sources import adapter, roles
from contrail.sources.tables import Tables

SF = "/root/testdata/sf0.001"
BAD = ("SinglePartition", "BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchange_keys(plan: str) -> list[str]:
    return re.findall(r"hashpartitioning\(([^)]*)\)", plan)


def test_every_pipeline_step_plan(spark):
    inp = adapter.common_flight_inputs(Tables(spark, SF))
    steps = {}
    rows = cf._with_recordings(cf._flights(inp, "GENX"), inp, "GENX")
    steps["recordings"] = rows
    m = cf._with_tracking(cut_lineage(rows), inp, "GENX")
    steps["tracking"] = m
    m = cut_lineage(m.withColumn(cf.ROW, F.monotonically_increasing_id()))
    steps["airport"] = cf._airport_side(m, inp)
    steps["timeline"] = cf._timeline_side(m, inp, "GENX")
    steps["history"] = cf._history_side(m, inp)
    steps["reports"] = cf._report_side(m, inp)
    steps["end"] = cf.build_common_flight(inp, "GENX", dt.datetime(2024, 2, 1))
    for name, df in steps.items():
        plan = _plan(df)
        for bad in BAD:
            assert bad not in plan, (name, bad)


def test_flight_scans_are_pruned_and_filtered(spark):
    df = cf._flights(adapter.common_flight_inputs(Tables(spark, SF)), "GENX")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in plan
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all("props" not in r for r in read)     # unused columns never read


def test_hot_keys_are_split_by_time(spark):
    t = Tables(spark, SF)
    legs = roles.legs(t)
    # range joins: the bin is part of the shuffle key
    m = op.interval_match(legs, roles.recs(t), leg_id="leg_id", keys=["key"], start="start_ts",
                          end="end_ts", rec_ts="rec_ts", rec_id="rec_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = _exchange_keys(_plan(m))
        assert any("_cr_bin" in k and "_cr_k0" in k for k in keys), keys
        # the whole legs are dealt once, for the choice of one row and the join back;
        # beside it the few columns of them that the range join reads
        dealt = [k for k in keys if "leg_id" in k]
        assert len(dealt) == 2 and all("_cr_one" in k for k in dealt), keys
        # per-aircraft lag: windows partition by (tail, bucket), not tail alone
        marked = op.mark_parents(legs, tail="tail", at="start_ts", start="start_ts",
                                 end="end_ts", order=["start_ts", "pos", "leg_id"])
        keys = _exchange_keys(_plan(marked))
        assert any("_cr_bk" in k and "tail" in k for k in keys), keys
        # prior events: running window per (engine, bucket)
        h = op.prior_events_max(legs, roles.hist(t), key="key", at="start_ts",
                                event_key="hist_key", event_ts="ev_ts", cols={"m": "removals"})
        keys = _exchange_keys(_plan(h))
        assert any(re.search(r"_k#\d+L?, _b#", k) for k in keys), keys
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_result_equals_plain_join(spark):
    """One key holds every leg and record: binned result is still exact."""
    base = dt.datetime(2024, 1, 1)
    legs = frame(spark, "leg_id long, key long, start_ts timestamp_ntz, end_ts timestamp_ntz",
                 [(i, 1, base + dt.timedelta(minutes=37 * i),
                   base + dt.timedelta(minutes=37 * i + 90)) for i in range(400)])
    recs = frame(spark, "rec_id long, key long, rec_ts timestamp_ntz",
                 [(j, 1, base + dt.timedelta(minutes=23 * j)) for j in range(600)])
    out = op.interval_match(legs, recs, leg_id="leg_id", keys=["key"], start="start_ts",
                            end="end_ts", rec_ts="rec_ts", rec_id="rec_id", bin_seconds=3600)
    got = {r.leg_id: r.rec_count for r in out.collect()}
    want = {}
    for i in range(400):
        lo, hi = 37 * i - 20, 37 * i + 90
        want[i] = sum(1 for j in range(600) if lo <= 23 * j <= hi)
    assert got == want


def test_best_of_sources_and_ambiguity(spark):
    df = frame(spark, "id int, a string, b string, c string, n int", [
        (1, "A", "B", "C", 1), (2, None, "B", "C", 1), (3, None, None, "C", 1),
        (4, None, None, None, 1), (5, "A", None, None, 2)])
    out = op.best_of(df, "best", [("PHM", "a"), ("FFD", "b"), ("Flightaware", "c")],
                     src_out="src", ambiguous=F.col("n") > 1)
    got = {r.id: (r.best, r.src) for r in out.collect()}
    assert got == {1: ("A", "PHM"), 2: ("B", "FFD"), 3: ("C", "Flightaware"),
                   4: (None, None), 5: ("A", None)}


def test_child_in_two_parents_fans_out(spark):
    rows = [
        (1, "T", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"), ts("2024-01-01 20:00:00"), 1),
        (2, "T", ts("2024-01-01 10:30:00"), ts("2024-01-01 10:30:00"), ts("2024-01-01 10:40:00"), 1),
        (3, "T", ts("2024-01-01 11:00:00"), ts("2024-01-01 11:00:00"), ts("2024-01-01 12:00:00"), 1),
        (4, "T", ts("2024-01-01 11:30:00"), ts("2024-01-01 11:30:00"), ts("2024-01-01 11:45:00"), 1),
    ]
    df = frame(spark, "id long, tail string, at timestamp_ntz, st timestamp_ntz, "
                      "en timestamp_ntz, pos int", rows)
    order = ["at", "pos", "id"]
    marked = op.mark_parents(df, tail="tail", at="at", start="st", end="en", order=order)
    assert {r.id: r.is_parent for r in marked.collect()} == {1: True, 2: False, 3: True, 4: False}
    g = op.group_siblings(marked, tail="tail", at="at", start="st", end="en", id_col="id",
                          order=order, parent_key="pk", ids_out="ids")
    got = sorted((r.id, r.pk, tuple(r.ids)) for r in g.collect())
    p1, p3 = ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00")
    assert got == [(1, p1, (1, 2, 4)), (2, p1, (1, 2, 4)), (3, p3, (3, 4)),
                   (4, p1, (1, 2, 4)), (4, p3, (3, 4))]


def test_null_keys_are_salted_in_left_joins(spark):
    from contrail.operators.ranges import left_join, null_salt
    left = frame(spark, "id long, k string", [(i, None if i % 2 else "a") for i in range(200)])
    right = frame(spark, "rk string, v int", [("a", 1)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = left_join(left, right, [("k", "rk")])
        keys = _exchange_keys(_plan(out))
        assert any("_cr_nsl" in k for k in keys), keys
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 200
    assert sorted((r.id, r.v) for r in rows) == [(i, None if i % 2 else 1) for i in range(200)]
    # NULL-key rows are spread over many salt values, not one
    salts = left.where("k IS NULL").select(null_salt(left, ["k"]).alias("s"))
    assert salts.distinct().count() > 20


def test_publish_full_then_trailing(spark):
    from contrail.plans.common_flight import (MONTH, build_common_flight, build_trailing,
                                              publish_full, publish_trailing)
    from contrail.session import scratch_path
    inp = adapter.common_flight_inputs(Tables(spark, SF))
    created = dt.datetime(2024, 2, 1)
    full = build_common_flight(inp, "GENX", created)
    path = scratch_path(spark, "test-publish")
    publish_full(full, path, table="contrail_test_cf")
    n_full = spark.table("contrail_test_cf").count()
    assert n_full == full.count() > 0
    months = sorted(r[0] for r in full.select(MONTH).distinct().collect())
    assert len(months) > 10
    # window starting after the data: older months are left untouched
    later = build_trailing(inp, "GENX", created, as_of=dt.date(2027, 6, 1))
    assert publish_trailing(later, path, as_of=dt.date(2027, 6, 1)) == []
    assert spark.read.parquet(path).count() == n_full
    # a window over the last months: the same rows as the whole build has there
    recent = build_trailing(inp, "GENX", created, as_of=dt.date(2025, 6, 20))
    whole = full.where(F.col(MONTH) >= 202406)
    assert 0 < recent.count() < n_full
    assert recent.exceptAll(whole).count() == whole.exceptAll(recent).count() == 0
    assert publish_trailing(recent, path, as_of=dt.date(2025, 6, 20),
                            table="contrail_test_cf") == []
    back = spark.table("contrail_test_cf")
    assert back.count() == n_full
    assert set(back.columns) == set(full.columns)
    assert sorted(r[0] for r in back.select(MONTH).distinct().collect()) == months
    # no new rows for a month inside the window: the month is deleted
    assert publish_trailing(recent.where("false"), path, as_of=dt.date(2024, 12, 1)) == months
    local = path[len("file:"):] if path.startswith("file:") else path
    assert not [d for d in os.listdir(local) if d.startswith(MONTH + "=")]


def test_a_trailing_build_reads_what_its_rows_depend_on(spark):
    inp = adapter.common_flight_inputs(Tables(spark, SF))
    pruned, since = cf.since_month(inp, "GENX", 202410)
    assert since is not None
    for name in ("phm", "ffd", "fa", "metar", "env", "denorm"):
        assert 0 < pruned[name].count() < inp[name].count(), name
    assert all(pruned[name] is inp[name] for name in ("airports", "fdm", "phm_rmd", "aircraft_type"))
    created = dt.datetime(2024, 2, 1)
    for month in (202410, 202502):
        whole = cf.build_common_flight(inp, "GENX", created).where(F.col(cf.MONTH) >= month)
        recent = cf.build_common_flight(inp, "GENX", created, from_month=month)
        assert recent.exceptAll(whole).count() == whole.exceptAll(recent).count() == 0


def test_ids_on_both_sides_of_the_bound_switch_pruning_off(spark):
    """The earliest listing of a flight counts, however old it is."""
    inp = adapter.common_flight_inputs(Tables(spark, SF))
    late = inp["phm"].where((F.col("engine_family") == "GENX") & (F.col("best_datetime") >= "2024-12-01"))
    twice = late.limit(5).withColumns({c: F.col(c) - F.expr("INTERVAL 300 DAYS") for c in (
        "best_datetime", "flight_start_time", "flight_end_time")})
    inp["phm"] = inp["phm"].unionByName(cut_lineage(twice))
    assert cf.since_month(inp, "GENX", 202412) == (inp, None)
    created = dt.datetime(2024, 2, 1)
    whole = cf.build_common_flight(inp, "GENX", created).where(F.col(cf.MONTH) >= 202412)
    recent = cf.build_common_flight(inp, "GENX", created, from_month=202412)
    assert recent.exceptAll(whole).count() == whole.exceptAll(recent).count() == 0


def test_wide_rows_pass_one_join_after_the_look_ups(spark):
    """The narrow look-ups meet each other first, and the wide rows then all of them at once."""
    from contrail.plans.common_flight import build_common_flight

    out = build_common_flight(adapter.common_flight_inputs(Tables(spark, SF)), adapter.FAMILY, dt.datetime(2024, 2, 1))
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    leaf = next(i for i, line in enumerate(lines) if "Relation [" in line)
    assert sum("Join " in line for line in lines[:leaf]) == 1
