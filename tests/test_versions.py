"""Publishing at one stroke: every failure leaves the old or the new table whole."""

from __future__ import annotations

import os

import pytest
from conftest import frame

from contrail.session import scratch_path
from contrail.sources import versions

SCHEMA = "k long, v double, m int"
OLD = [(1, 10.0, 202311), (2, 20.0, 202312), (3, 30.0, 202401), (4, 40.0, 202402), (5, 50.0, None)]
NEW = [(3, 33.0, 202401), (6, 60.0, 202403), (9, 90.0, 202312)]
AFTER = [(1, 10.0, 202311), (2, 20.0, 202312), (3, 33.0, 202401), (5, 50.0, None), (6, 60.0, 202403)]


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("k", "v", "m").collect()), key=str)


def files(path):
    path = path.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def published(spark, name):
    path = scratch_path(spark, name)
    versions.publish(frame(spark, SCHEMA, OLD), name, path, "m")
    assert rows(spark, name) == sorted(OLD, key=str)
    return path


def test_refresh_replaces_months_and_moves_no_other(spark):
    path = published(spark, "contrail_test_v1")
    before = files(path)
    assert versions.refresh(frame(spark, SCHEMA, NEW), "contrail_test_v1", path, "m", 202401) == [202402]
    assert rows(spark, "contrail_test_v1") == sorted(AFTER, key=str)
    after = files(path)
    kept = {f: t for f, t in before.items() if "m=202311" in f or "m=202312" in f or "DEFAULT" in f}
    assert kept and kept.items() <= after.items()
    # nothing that is not shown stays, and each new row was written once
    assert not [f for f in after if "m=202402" in f or (f in before and "m=202401" in f)]
    assert len(after) == len(kept) + 2
    # month filters still prune partitions through the view
    plan = spark.table("contrail_test_v1").where("m = 202311")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    versions.publish(frame(spark, SCHEMA, NEW[:1]), "contrail_test_v1", path, "m")
    assert rows(spark, "contrail_test_v1") == NEW[:1] and len(files(path)) == 1


@pytest.mark.parametrize("step", ["write", "define", "switch", "sweep"])
@pytest.mark.parametrize("done", [False, True])
def test_a_failure_leaves_the_old_or_the_new_table_whole(spark, monkeypatch, step, done):
    name = f"contrail_test_{step}_{int(done)}"
    path = published(spark, name)
    real = getattr(versions, step)

    def fails(*args):
        if done:
            real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, step, fails)
    with pytest.raises(RuntimeError):
        versions.refresh(frame(spark, SCHEMA, NEW), name, path, "m", 202401)
    new = step == "sweep" or (step == "switch" and done)
    spark.catalog.clearCache()
    assert rows(spark, name) == sorted(AFTER if new else OLD, key=str)
    monkeypatch.undo()
    # the next refresh works and sweeps what was left
    versions.refresh(frame(spark, SCHEMA, NEW), name, path, "m", 202401)
    assert rows(spark, name) == sorted(AFTER, key=str)
    assert len(versions._definitions(spark, name)) == 1
    assert len(files(path)) == len(AFTER)


def test_first_refresh_and_empty_tables(spark):
    path = scratch_path(spark, "contrail_test_v2")
    assert versions.refresh(frame(spark, SCHEMA, NEW), "contrail_test_v2", path, "m", 202401) == []
    assert rows(spark, "contrail_test_v2") == sorted(NEW[:2], key=str)
    assert versions.refresh(frame(spark, SCHEMA, []), "contrail_test_v2", path, "m", 202402) == [202403]
    assert rows(spark, "contrail_test_v2") == NEW[:1]
    versions.publish(frame(spark, SCHEMA, []), "contrail_test_v2", path, "m")
    assert rows(spark, "contrail_test_v2") == []
