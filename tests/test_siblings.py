"""Parent/child marking, sibling groups, slot assignment."""

from __future__ import annotations

import datetime as dt
import itertools
import random

from conftest import frame, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail import operators as op

LEGS = "id long, tail string, at timestamp_ntz, st timestamp_ntz, en timestamp_ntz, pos int"
ORDER = ["at", "pos", "id"]


def test_previous_values_equals_lag(spark):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        t = None if rnd.random() < 0.05 else base + dt.timedelta(minutes=rnd.randint(0, 20000))
        rows.append((i, rnd.choice(["T1", "T2", None]), t, t, t, rnd.randint(1, 4)))
    df = frame(spark, LEGS, rows)
    w = Window.partitionBy("tail").orderBy(*ORDER)
    want = {r.id: r.p for r in df.select("id", F.lag("id").over(w).alias("p")).collect()}
    for bucket in (600, 3600, 86400 * 30):
        got = op.previous_values(df, partition=["tail"], order=ORDER, time_col="at",
                                 values={"p": "id"}, bucket_seconds=bucket)
        assert {r.id: r.p for r in got.collect()} == want


def test_parents_children_chain(spark):
    df = frame(spark, LEGS, [
        (1, "T", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"),
         ts("2024-01-01 12:00:00"), 1),                       # parent A
        (2, "T", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"),
         ts("2024-01-01 12:00:00"), 2),                       # same instant: child of A
        (3, "T", ts("2024-01-01 11:30:00"), ts("2024-01-01 11:30:00"),
         ts("2024-01-01 14:00:00"), 1),                       # child B (inside previous)
        (4, "T", ts("2024-01-01 13:00:00"), ts("2024-01-01 13:00:00"),
         ts("2024-01-01 15:00:00"), 1),                       # chained child C: outside A
        (5, "T", ts("2024-01-02 10:00:00"), ts("2024-01-02 10:00:00"), None, 1),  # parent
        (6, "U", None, None, None, 1),                        # NULL time: parent
    ])
    marked = op.mark_parents(df, tail="tail", at="at", start="st", end="en", order=ORDER)
    assert {r.id: r.is_parent for r in marked.collect()} == {
        1: True, 2: False, 3: False, 4: False, 5: True, 6: True}
    g = op.group_siblings(marked, tail="tail", at="at", start="st", end="en", id_col="id",
                          order=ORDER, parent_key="pk", ids_out="ids")
    got = {r.id: (r.pk, r.ids) for r in g.collect()}
    a = ts("2024-01-01 10:00:00")
    assert got[1] == (a, [1, 2, 3]) and got[2] == (a, [1, 2, 3]) and got[3] == (a, [1, 2, 3])
    assert got[4] == (None, None)                      # chain left every parent
    assert got[5] == (ts("2024-01-02 10:00:00"), [5])
    assert got[6] == (None, None)
    literal = op.group_siblings(marked, tail="tail", at="at", start="st", end="en",
                                id_col="id", order=ORDER, include_parents=False)
    assert sorted(r.id for r in literal.collect()) == [2, 3, 4]


def _rank_rule(e, ids, literal):
    """Slot k: 'no_def_id' for a NULL ESN, else the id whose 1-based position
    is the number of non-NULL ESNs in slots 1..k; with ``literal`` slot 4
    after three NULL slots is NULL."""
    out = []
    for k in range(4):
        if e[k] is None:
            out.append("no_def_id")
            continue
        if literal and k == 3 and e[:3] == [None, None, None]:
            out.append(None)
            continue
        n = sum(x is not None for x in e[:k + 1])
        out.append(ids[n - 1] if n <= len(ids) else None)
    return out


def test_slot_rule_all_null_patterns(spark):
    rows = [(*pat, ["10", "20", "30", "40"])
            for pat in itertools.product([None, "e"], repeat=4)]
    df = spark.createDataFrame(rows, "e1 string, e2 string, e3 string, e4 string, ids array<string>")
    for literal in (True, False):
        out = op.assign_slots(df, esns=["e1", "e2", "e3", "e4"], ids="ids", prefix="s",
                              joined="all", literal=literal).collect()
        assert len(out) == 16
        for r in out:
            e = [r.e1, r.e2, r.e3, r.e4]
            got = [r.s1, r.s2, r.s3, r.s4]
            assert got == _rank_rule(e, ["10", "20", "30", "40"], literal), e
            assert r.all == ",".join(x for x in got if x is not None)
    # hand-checked rows
    by = {tuple(x is not None for x in (r.e1, r.e2, r.e3, r.e4)): (r.s1, r.s2, r.s3, r.s4)
          for r in op.assign_slots(df, esns=["e1", "e2", "e3", "e4"], ids="ids",
                                   prefix="s", joined=None).collect()}
    assert by[(True, True, True, True)] == ("10", "20", "30", "40")
    assert by[(False, True, False, True)] == ("no_def_id", "10", "no_def_id", "20")
    assert by[(False, False, False, True)] == ("no_def_id",) * 3 + ("10",)


def test_slot_ids_past_end_are_null(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", ["1"])],
                               "e1 string, e2 string, e3 string, e4 string, ids array<string>")
    r = op.assign_slots(df, esns=["e1", "e2", "e3", "e4"], ids="ids", prefix="s",
                        joined=None).collect()[0]
    assert (r.s1, r.s2, r.s3, r.s4) == ("1", None, None, None)
