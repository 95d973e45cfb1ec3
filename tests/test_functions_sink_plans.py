"""Scalar functions, month-partitioned sink, report roster and plan shape."""

from __future__ import annotations

import datetime as dt
import os

from conftest import frame, ts
from pyspark.sql import functions as F

from contrail import operators as op
from contrail.functions import (composite_id, engine_fit_string, month_key_int, normalize_id,
                                position_label, report_nkey)
from contrail.plans.queries import QUERIES
from contrail.session import scratch_path
from contrail.sources import sink


def test_normalize_and_ids(spark):
    df = frame(spark, "s string, id long, esn string, inst timestamp_ntz", [
        (None, None, None, None),
        ("  n-123 a ", 0, "E1", ts("2024-12-30 10:00:00")),
        ("--..", 12, None, None),
    ])
    out = df.select(normalize_id("s").alias("n"), composite_id("id", "esn").alias("c"),
                    engine_fit_string("esn", "inst").alias("f")).collect()
    assert [tuple(r) for r in out] == [(None, "0-xxx", ""), ("N123A", "0-E1", "E1_20241230"),
                                       ("", "12-xxx", "")]


def test_position_labels(spark):
    df = frame(spark, "p string, n int", [("1", 2), ("2", 3), ("4", 4), ("3", 2), ("1", 1),
                                          ("1", 5), ("1", None), ("x", 4)])
    got = [r[0] for r in df.select(position_label("p", "n")).collect()]
    assert got == ["LI", "C", "RO", None, None, None, None, None]


def test_month_key_new_year_and_nkey(spark):
    df = frame(spark, "t timestamp_ntz, icao string, esn string, pos int", [
        (ts("2024-12-30 23:00:00"), None, None, None),
        (ts("2025-01-01 00:00:00"), "KX", "E1", 2)])
    out = df.select(month_key_int("t").alias("m"),
                    report_nkey("icao", "esn", "pos", "t").alias("k")).collect()
    assert out[0].m == 202412 and out[1].m == 202501
    assert out[0].k == "zxy1735599600" and out[1].k == "KXE121735689600"


def test_cutoff_month():
    assert sink.cutoff_month(dt.date(2001, 8, 1)) == 200008
    assert sink.cutoff_month(dt.date(2024, 1, 15), 1) == 202312
    assert sink.cutoff_month(dt.date(2024, 1, 15), 13) == 202212


def _files(path):
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(root, n)
                with open(p, "rb") as fh:
                    out[os.path.relpath(p, path)] = fh.read()
    return out


def test_full_write_refresh_and_register(spark):
    path = scratch_path(spark, "test-sink")
    if path.startswith("file:"):
        path = path[len("file:"):]
    rows = [(1, 10.0, 202311), (2, 20.0, 202312), (3, 30.0, 202401), (4, 40.0, 202402)]
    df = frame(spark, "k long, v double, m int", rows)
    sink.write_full(df, path, "m")
    before = _files(path)
    fresh = frame(spark, "k long, v double, m int", [(3, 33.0, 202401), (5, 50.0, 202403)])
    emptied = sink.refresh_trailing(spark, fresh, path, "m", 202401)
    assert emptied == [202402]
    after = _files(path)
    old = {k: v for k, v in before.items() if "m=202311" in k or "m=202312" in k}
    assert old and all(after.get(k) == v for k, v in old.items())   # untouched bytes
    assert not any("m=202402" in k for k in after)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "m").collect())
    assert got == [(1, 10.0, 202311), (2, 20.0, 202312), (3, 33.0, 202401), (5, 50.0, 202403)]
    sink.register_table(spark, "contrail_test_sink", path, fresh, "m")
    assert spark.table("contrail_test_sink").count() == 4


def test_trailing_months_drops_old_and_null(spark):
    df = frame(spark, "t timestamp_ntz", [(ts("2000-07-31 23:59:59"),),
                                          (ts("2000-08-01 00:00:00"),), (None,)])
    assert sink.trailing_months(df, "t", dt.date(2001, 8, 1)).count() == 1


def test_roster_union_and_first_message_id(spark):
    fl = frame(spark, "st_message_seq_id long, tk_message_seq_id long, cl_message_seq_id long, "
                      "cr1_message_seq_id long, pf_message_seq_id long, rmd_flight_def_id long, "
                      "serlzd_eng_ser_num string, engine_position long, airport_depart string, "
                      "airport_dest string", [
        (None, None, None, None, None, 1, "E", 1, "A", "B"),   # no message id
        (None, 7, 8, None, None, 2, "E", 1, "A", "B"),
        (None, 7, 8, None, None, 2, "E", 1, "A", "B"),          # duplicate row
    ])
    pa = frame(spark, "message_seq_id long, src_icao_cd string, serlzd_eng_ser_num string, "
                      "engine_position long, install_datetime timestamp_ntz, "
                      "message_date_time timestamp_ntz, report_type string", [
        (7, None, None, None, None, ts("2024-01-01 00:00:00"), "Climb"),
        (7, "C", "E", 2, ts("1970-01-01 00:01:00"), ts("2024-01-01 00:00:00"), "Cruise"),
        (7, "C", "E", 2, None, ts("2024-01-01 00:00:00"), "Maintenance"),   # not listed
    ])
    out = op.message_roster([("a", fl, pa), ("b", fl, pa)])
    got = sorted((r.engine_family, r.message_seq_id_rmd, r.nkey) for r in out.collect())
    assert got == [("a", 7, "CE260"), ("a", 7, "zxy-2"), ("b", 7, "CE260"), ("b", 7, "zxy-2")]


def test_end_to_end_plan_shape(spark):
    df = QUERIES["q28"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "EvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_range_joins_are_equi_joins(spark):
    df = QUERIES["q03"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "_cr_bin" in plan
    assert F is not None


def test_roster_publish_unpartitioned(spark):
    from contrail.plans.report_staging import build_roster, publish_roster
    from contrail.sources import roles
    from contrail.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    roster = build_roster([("genx", roles.rmd_flights(t), roles.rmd_params(t))])
    path = scratch_path(spark, "test-roster")
    publish_roster(roster, path, table="contrail_test_roster")
    assert spark.table("contrail_test_roster").count() == roster.count()
    assert spark.table("contrail_test_roster").columns == roster.columns


def test_month_spread_keeps_rows(spark):
    df = frame(spark, "k long, m int", [(i, 202401 + i % 3) for i in range(50)])
    out = sink.spread_by_month(df, "m")
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in df.collect())


def test_unknown_engine_family_is_rejected(spark):
    import pytest
    from contrail.plans.common_flight import build_common_flight
    from contrail.sources import adapter
    from contrail.sources.tables import Tables
    inp = adapter.common_flight_inputs(Tables(spark, "/root/testdata/sf0.001"))
    with pytest.raises(ValueError, match="not a valid engine family"):
        build_common_flight(inp, "XYZ", dt.datetime(2024, 2, 1))


def test_temporary_stages_go_and_results_stay(spark):
    from contrail.session import cut_lineage, temporary
    kept = scratch_path(spark, "test-kept")
    with temporary(spark):
        inner = scratch_path(spark, "test-inner")
        with temporary(spark):
            deep = cut_lineage(spark.range(9), "test-deep")
            spark.range(3).write.parquet(inner)
        out = cut_lineage(deep.sparkSession.read.parquet(inner), path=kept)
    home = os.path.dirname(kept).removeprefix("file:")
    left = {x.rsplit("-", 1)[0] for x in os.listdir(home)}
    assert "test-kept" in left and not left & {"test-inner", "test-deep"}
    assert out.count() == 3


def test_a_warehouse_on_the_drivers_disk_is_refused_on_a_cluster():
    import pytest
    from contrail import session

    class Conf(dict):
        def get(self, key, default="file:/some/warehouse"):
            return dict.get(self, key, default)

    class Scheme:
        def getScheme(self):
            return "file"

    class Fs:
        def getUri(self):
            return Scheme()

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    real = session._hadoop_path
    session._hadoop_path = lambda spark, path: (None, Fs())
    try:
        Session.conf = Conf({"spark.checkpoint.dir": None})
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(Session())
        Context.master = "local[4]"
        assert session.shared_dir(Session()) == "file:/some/warehouse"
        Context.master, Session.conf = "yarn", Conf({"spark.checkpoint.dir": "hdfs://a/b/"})
        assert session.shared_dir(Session()) == "hdfs://a/b"
    finally:
        session._hadoop_path = real
