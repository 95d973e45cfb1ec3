"""Registered queries: one per operator of the stitching job, each over the
role frames of ``contrail.sources.roles`` (whole tables, no row caps).

Every query returns a DataFrame whose column names and values match the SQL
of the same key in ``contrail.plans.oracle``: arrays are rendered as sorted
comma-joined strings, floats are rounded to 3 decimals, integers are BIGINT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import (composite_id, engine_fit_string, month_key_int, normalize_id,
                         position_label, present_flag, quality_flags, report_nkey, shift)
from ..functions.timecols import ts_type_of
from ..operators.ranges import left_join
from ..session import cut_lineage, scratch_path
from ..sources import adapter, roles, sink, versions
from ..sources.tables import Tables
from . import report_staging
from .common_flight import (OUTPUT_COLUMNS, build_common_flight, build_trailing, publish_full,
                            publish_versioned, refresh_versioned)

AS_OF = dt.date(2001, 8, 1)
CREATED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
TRAILING_AS_OF = dt.date(2025, 6, 20)
REFRESHED_AT = dt.datetime(2024, 3, 1, 0, 0, 0)
MAX_GAP = 1800  # seconds
LEG_ORDER = ["start_ts", "pos", "leg_id"]


def _ids_text(c: str) -> F.Column:
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")


# -- building blocks shared by several queries --------------------------------

def matched_legs(t: Tables) -> DataFrame:
    return op.interval_match(roles.legs(t), roles.recs(t), leg_id="leg_id", keys=["key"],
                             start="start_ts", end="end_ts", rec_ts="rec_ts", rec_id="rec_id",
                             chosen="rec_id", ids_out="rec_ids", count_out="rec_count")


def with_unmatched(t: Tables) -> DataFrame:
    m = cut_lineage(matched_legs(t), "matched")  # read twice
    un = op.unmatched_records(roles.recs(t), m, rec_keys=["rec_id", "key"], ids_col="rec_ids",
                              matched_keys=["key"])
    return op.append_unmatched(m, un, rec_id="rec_id", chosen="rec_id", ids_col="rec_ids",
                               rename={"key": "key"}, count_col="rec_count")


def with_rec_detail(t: Tables) -> DataFrame:
    rows = with_unmatched(t)
    det = roles.recs(t).select(F.col("rec_id").alias("_rid"), F.col("key").alias("_rkey"),
                               "rec_ts", "rec_dep")
    return left_join(rows, det, [("rec_id", "_rid"), ("key", "_rkey")]).drop("_rid", "_rkey")


def fa_candidates(t: Tables) -> DataFrame:
    rows = cut_lineage(with_rec_detail(t), "recordings")  # the nearest match reads them several times
    return (rows.withColumns({
        "_lo": F.coalesce(F.col("start_ts"), shift("rec_ts", "-25 minutes")),
        "_hi": F.coalesce(F.col("end_ts"), shift("rec_ts", "25 minutes")),
        "_at": F.coalesce(F.col("start_ts"), F.col("rec_ts"))}))


def fa_matched(t: Tables) -> DataFrame:
    rows = fa_candidates(t)
    return op.nearest_match(rows, roles.obs(t), row_key=["leg_id", "rec_id"], id_col="leg_id",
                            keys=["key"], lo="_lo", hi="_hi", at="_at", obs_ts="obs_ts",
                            tiebreak="obs_id", obs_cols=["obs_id", "obs_dep"])


def marked_legs(t: Tables) -> DataFrame:
    return op.mark_parents(roles.legs(t, None), tail="tail", at="start_ts", start="start_ts",
                           end="end_ts", order=LEG_ORDER)


def sibling_rows(t: Tables) -> DataFrame:
    return op.group_siblings(marked_legs(t), tail="tail", at="start_ts", start="start_ts",
                             end="end_ts", id_col="leg_id", order=LEG_ORDER)


def distance_legs(t: Tables) -> DataFrame:
    return op.attach_distance(roles.legs(t), roles.airports(t), dep="dep", arr="arr")


def _roster_sources(t: Tables, families) -> list:
    fl, pa = roles.rmd_flights(t), roles.rmd_params(t)
    if families is None:
        return [("genx", fl, pa)]
    return [(f, fl.where(F.col("family") == f), pa.where(F.col("family") == f))
            for f in families]


# -- the queries ---------------------------------------------------------------

def q01(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return (t.customer.where(F.col("c_mktsegment") == "BUILDING")
            .select(F.col("c_custkey").alias("cust_id"), normalize_id("c_name").alias("name_norm"),
                    F.col("c_nationkey").cast("long").alias("nation_id")))


def q02(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    s, n = t.supplier, t.nation
    return (s.join(n, s["s_nationkey"] == n["n_nationkey"], "left")
            .select("s_suppkey", "s_name", F.col("n_name").alias("nation_name")))


def q03(spark: SparkSession, sf: str) -> DataFrame:
    m = matched_legs(Tables(spark, sf))
    return m.select("leg_id", "rec_id", _ids_text("rec_ids").alias("rec_ids"),
                    F.col("rec_count").cast("long").alias("rec_count"))


def q04(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_unmatched(Tables(spark, sf))
    return rows.select("leg_id", "key", "rec_id", _ids_text("rec_ids").alias("rec_ids"),
                       F.col("rec_count").cast("long").alias("rec_count"))


def q05(spark: SparkSession, sf: str) -> DataFrame:
    return with_rec_detail(Tables(spark, sf)).select("leg_id", "key", "rec_id", "rec_ts")


def q06(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_rec_detail(Tables(spark, sf))
    return rows.select("leg_id", "rec_id", present_flag("rec_ts").alias("has_duplicates"),
                       present_flag("rec_id").alias("is_overlapping"))


def q07(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    legs = roles.legs(t).withColumns({"_lo": shift("start_ts", "-25 minutes"),
                                      "_hi": shift("end_ts", "25 minutes")})
    m = op.nearest_match(legs, roles.obs(t), row_key=["leg_id"], id_col="leg_id", keys=["key"],
                         lo="_lo", hi="_hi", at="start_ts", obs_ts="obs_ts", tiebreak="obs_id",
                         obs_cols=["obs_id"])
    return m.select("leg_id", "obs_id")


def q08(spark: SparkSession, sf: str) -> DataFrame:
    return fa_matched(Tables(spark, sf)).select("leg_id", "rec_id", "obs_id")


def q09(spark: SparkSession, sf: str) -> DataFrame:
    rows = fa_matched(Tables(spark, sf))
    rows = op.best_of(rows, "best_depart", [("PHM", "dep"), ("FFD", "rec_dep"),
                                            ("Flightaware", "obs_dep")],
                      src_out="depart_src", ambiguous=F.col("rec_count") > 1)
    return rows.select("leg_id", "rec_id", "obs_id", "best_depart", "depart_src")


def q10(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    legs = roles.legs(t)
    gaps = op.observation_gaps(roles.wx(t), ts_type=ts_type_of(legs, "start_ts"))
    out = op.nearest_observations(legs, gaps, {"metar_id_depart": ("dep", "start_ts"),
                                               "metar_id_destination": ("arr", "end_ts")})
    return out.select("leg_id", "metar_id_depart", "metar_id_destination")


def q11(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    d = op.airport_pair_distances(roles.legs(t), roles.airports(t), dep="dep", arr="arr")
    return d.select("dep", "arr", F.round("great_circle_distance", 3)
                    .alias("great_circle_distance"))


def q12(spark: SparkSession, sf: str) -> DataFrame:
    d = distance_legs(Tables(spark, sf))
    return d.select("leg_id", F.round("great_circle_distance", 3).alias("great_circle_distance"))


def q13(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    legs = roles.legs(t).withColumns({"depart_date": F.col("start_ts").cast("date"),
                                      "dest_date": F.col("end_ts").cast("date")})
    dated, undated = roles.env_dated(t), roles.env_undated(t)
    for end, code, day in (("depart", "dep", "depart_date"), ("destination", "arr", "dest_date")):
        legs = op.dated_lookup(legs, dated, undated, code=code, day=day, hit="env_airport_id",
                               ids={f"environment_id_{end}": "env_airport_id",
                                    f"airport_{end}_env_6x_id": "env_6x_id",
                                    f"airport_{end}_env_5x_id": "env_5x_id",
                                    f"airport_{end}_env_4x_id": "env_4x_id"})
    return legs.select("leg_id", *[f"{p}{end}{s}" for end in ("depart", "destination")
                                   for p, s in (("environment_id_", ""), ("airport_", "_env_6x_id"),
                                                ("airport_", "_env_5x_id"),
                                                ("airport_", "_env_4x_id"))])


def q14(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    out = op.timeline_lookup(roles.legs(t), roles.timeline(t), keys=[("key", "tl_key")],
                             at="start_ts", begin="begin_ts", end="end_ts",
                             cols={"tl_id": "tl_id", "engine_model_mdm": "engine_model_mdm",
                                   "engine_series_mdm": "engine_series_mdm"})
    return out.select("leg_id", "tl_id", "engine_model_mdm", "engine_series_mdm")


def q15(spark: SparkSession, sf: str) -> DataFrame:
    return marked_legs(Tables(spark, sf)).select("leg_id", "tail", "is_parent")


def q16(spark: SparkSession, sf: str) -> DataFrame:
    rows = sibling_rows(Tables(spark, sf))
    return rows.select("leg_id", "tail", "is_parent", "parent_datetime")


def q17(spark: SparkSession, sf: str) -> DataFrame:
    rows = sibling_rows(Tables(spark, sf))
    rows = op.assign_slots(rows, esns=["esn_1", "esn_2", "esn_3", "esn_4"], ids="sibling_ids",
                           prefix="slot_", joined="slots")
    return rows.select("leg_id", "parent_datetime", _ids_text("sibling_ids").alias("sibling_ids"),
                       "slot_1", "slot_2", "slot_3", "slot_4", "slots")


def q18(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    out = op.prior_events_max(roles.legs(t), roles.hist(t), key="key", at="start_ts",
                              event_key="hist_key", event_ts="ev_ts", require="leg_id",
                              cols={"fdm_event_date": "ev_ts", "fdm_removal_count": "removals",
                                    "fdm_shop_visit_count": "visits"})
    return out.select("leg_id", "fdm_event_date", "fdm_removal_count", "fdm_shop_visit_count")


def q19(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    legs = roles.legs(t).withColumns({
        "best_depart": F.when(F.col("leg_id") % 5 == 0, F.lit(None)).otherwise(F.col("dep")),
        "best_arrival": F.when(F.col("leg_id") % 7 == 0, F.lit(None)).otherwise(F.col("arr"))})
    out = op.attach_reports(legs, roles.reports(t), leg_id="leg_id", report_id="report_def_id",
                            fallbacks={"airport_depart": ("best_depart", "rmd_dep"),
                                       "airport_destination": ("best_arrival", "rmd_arr")})
    return out.select("leg_id", "report_id", "airport_depart", "airport_destination")


def q20(spark: SparkSession, sf: str) -> DataFrame:
    legs = roles.legs(Tables(spark, sf), None)
    return legs.select("leg_id", F.col("n_eng").alias("no_of_engines"),
                       position_label("pos", "n_eng").alias("engine_position_description"))


def q21(spark: SparkSession, sf: str) -> DataFrame:
    d = distance_legs(Tables(spark, sf))
    flags = {"missing_distance": "great_circle_distance", "missing_esn_1": "esn_1",
             "missing_esn_2": "esn_2", "missing_esn_3": "esn_3", "missing_esn_4": "esn_4"}
    return quality_flags(d, flags).select("leg_id", *flags)


def q22(spark: SparkSession, sf: str) -> DataFrame:
    legs = roles.legs(Tables(spark, sf), None)
    return legs.select("leg_id", composite_id("leg_id", "esn_1").alias("ID"),
                       engine_fit_string("esn_1", "start_ts").alias("enginefitstring"),
                       report_nkey("dep", "esn_1", "pos", "start_ts").alias("nkey"))


def q23(spark: SparkSession, sf: str) -> DataFrame:
    legs = roles.legs(Tables(spark, sf), None)
    return legs.select("leg_id", month_key_int("start_ts").alias("best_yearmonth"))


def q24(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    return (sink.trailing_months(o, "o_orderdate", AS_OF)
            .select("o_orderkey", "o_orderdate",
                    month_key_int("o_orderdate").alias("best_yearmonth")))


def q25(spark: SparkSession, sf: str) -> DataFrame:
    """Full publish, trailing refresh at one stroke (one month emptied), read
    back by name."""
    o = Tables(spark, sf).orders.select(
        "o_orderkey", "o_totalprice",
        month_key_int("o_orderdate").alias("best_yearmonth"))
    cutoff = sink.cutoff_month(AS_OF)
    path = scratch_path(spark, "q25")
    name = "contrail_q25_" + path.rsplit("-", 1)[-1]
    versions.publish(o, name, path, "best_yearmonth")
    fresh = (o.where(F.col("best_yearmonth") > cutoff)
             .select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"),
                     "best_yearmonth"))
    versions.refresh(fresh, name, path, "best_yearmonth", cutoff)
    return spark.table(name).select("o_orderkey", "o_totalprice",
                                    F.col("best_yearmonth").cast("int").alias("best_yearmonth"))


def q26(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return op.message_roster(_roster_sources(t, roles.ROSTER_FAMILIES))


def q27(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return op.message_roster(_roster_sources(t, None))


def _hash_stable(out: DataFrame) -> DataFrame:
    """Distance to 3 decimals, matched record ids as a sorted comma list."""
    return out.withColumns({
        "great_circle_distance": F.round("great_circle_distance", 3),
        "matched_adi_flight_rec_nos": _ids_text("matched_adi_flight_rec_nos")})


def q28(spark: SparkSession, sf: str) -> DataFrame:
    """End to end: every step, fixed output columns, one engine family of two."""
    t = Tables(spark, sf)
    return _hash_stable(build_common_flight(adapter.common_flight_inputs(t), adapter.FAMILY,
                                            CREATED_AT))


def q29(spark: SparkSession, sf: str) -> DataFrame:
    """q28 published by month and read back from the catalog."""
    out = q28(spark, sf)
    path = scratch_path(spark, "q29")
    name = "contrail_q29_" + path.rsplit("-", 1)[-1]
    publish_full(out, path, name)
    return spark.table(name).select(*out.columns)


def q30(spark: SparkSession, sf: str) -> DataFrame:
    """Trailing twelve-month build (as of 2025-06-20: months >= 202406), with
    the hash-stable values of q28."""
    t = Tables(spark, sf)
    out = build_trailing(adapter.common_flight_inputs(t), adapter.FAMILY, CREATED_AT,
                         as_of=TRAILING_AS_OF)
    return _hash_stable(out)


def q31(spark: SparkSession, sf: str) -> DataFrame:
    """Interval match over flights listed twice and flights without an id."""
    t = Tables(spark, sf)
    out = op.interval_match(roles.repeated_legs(t), roles.recs(t), leg_id="leg_id", keys=["key"],
                            start="start_ts", end="end_ts", rec_ts="rec_ts", rec_id="rec_id")
    return out.select("leg_id", "key", "start_ts", "rec_id",
                      F.col("rec_count").cast("long").alias("rec_count"))


def q32(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest match over the same rows: one row per id, and without an id every
    candidate."""
    t = Tables(spark, sf)
    rows = roles.repeated_legs(t).withColumns({"_lo": shift("start_ts", "-25 minutes"),
                                               "_hi": shift("end_ts", "25 minutes")})
    out = op.nearest_match(rows, roles.obs(t), row_key=["start_ts"], id_col="leg_id", keys=["key"],
                           lo="_lo", hi="_hi", at="start_ts", obs_ts="obs_ts", tiebreak="obs_id",
                           obs_cols=["obs_id"])
    return out.select("leg_id", "key", "start_ts", "obs_id")


def q33(spark: SparkSession, sf: str) -> DataFrame:
    """The whole build published, then its trailing twelve months built anew at
    a later time and published over it, read back by name."""
    t = Tables(spark, sf)
    inputs = adapter.common_flight_inputs(t)
    path = scratch_path(spark, "q33")
    name = "contrail_q33_" + path.rsplit("-", 1)[-1]
    publish_versioned(_hash_stable(build_common_flight(inputs, adapter.FAMILY, CREATED_AT)), path, name)
    recent = build_trailing(inputs, adapter.FAMILY, REFRESHED_AT, as_of=TRAILING_AS_OF)
    refresh_versioned(_hash_stable(recent), path, name, TRAILING_AS_OF)
    return spark.table(name).select(*OUTPUT_COLUMNS)


def q34(spark: SparkSession, sf: str) -> DataFrame:
    """The roster staged as one unpartitioned table, written twice (the second
    overwrites), read back from the catalog."""
    roster = report_staging.build_roster(_roster_sources(Tables(spark, sf), roles.ROSTER_FAMILIES))
    path = scratch_path(spark, "q34")
    name = "contrail_q34_" + path.rsplit("-", 1)[-1]
    report_staging.publish_roster(roster.where(F.col("engine_family") == "genx"), path, name)
    report_staging.publish_roster(roster, path, name)
    return spark.table(name).select(*roster.columns)


def q35(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest weather reading no more than half an hour away."""
    t = Tables(spark, sf)
    legs = roles.legs(t)
    gaps = op.observation_gaps(roles.wx(t), ts_type=ts_type_of(legs, "start_ts"))
    out = op.nearest_observation(legs, gaps, airport="dep", at="start_ts", out="metar_id_depart",
                                 max_gap=MAX_GAP)
    return out.select("leg_id", "metar_id_depart")


def q36(spark: SparkSession, sf: str) -> DataFrame:
    """Quality flags profiled by number of engines and month, each alone and over all."""
    legs = roles.legs(Tables(spark, sf), None)
    flags = {f"missing_esn_{k}": f"esn_{k}" for k in range(1, 5)}
    flagged = quality_flags(legs, flags).select(F.col("n_eng").alias("no_of_engines"),
                                                month_key_int("start_ts").alias("best_yearmonth"), *flags)
    return op.flag_profile(flagged, list(flags), ["no_of_engines", "best_yearmonth"])


def q37(spark: SparkSession, sf: str) -> DataFrame:
    """Two builds of the flights compared: the second lacks every thirteenth,
    lists every seventeenth twice and moves the start of every eleventh."""
    t = Tables(spark, sf)
    cols = ["leg_id", "tail", "pos", "start_ts", "dep", "esn_1"]
    legs = roles.legs(t, None).select(*cols)
    e = F.col("leg_id")
    other = legs.where(e % 13 != 0).withColumns({
        "start_ts": F.when(e % 11 == 0, shift("start_ts", "1 minute")).otherwise(F.col("start_ts")),
        "esn_1": F.when(e % 7 == 0, F.lit(None)).otherwise(F.col("esn_1"))})
    return op.reconcile(legs, other.unionByName(other.where(e % 17 == 0)), ["leg_id"])


def q38(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct aircraft of the trailing months from sketches stored by month,
    beside the exact number: whether the two agree within three per cent (the
    sketch's standard error is 0.8)."""
    legs = roles.legs(Tables(spark, sf), None).select("tail", month_key_int("start_ts").alias("best_yearmonth"))
    since = sink.cutoff_month(TRAILING_AS_OF)
    stored = cut_lineage(op.month_sketches(legs, "best_yearmonth", ["tail"], []), "sketches")
    merged = op.merged_sketches(stored, "best_yearmonth", since)
    exact = legs.where(F.col("best_yearmonth") >= since).agg(F.count_distinct("tail").alias("n"))
    none = F.lit(None).cast("long")
    both = merged.select("n_rows", "distinct_tail", none.alias("n")).unionByName(
        exact.select(none.alias("n_rows"), none.alias("distinct_tail"), "n"))
    found = both.agg(F.max("n_rows").alias("n_rows"), F.max("n").alias("distinct_tails"),
                     F.max("distinct_tail").alias("e"))
    near = F.abs(F.col("e") - F.col("distinct_tails")) <= 0.03 * F.col("distinct_tails")
    return found.select("n_rows", "distinct_tails", near.alias("sketch_agrees"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f"q{n:02d}": fn for n, fn in enumerate(
        [q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12, q13, q14, q15, q16, q17,
         q18, q19, q20, q21, q22, q23, q24, q25, q26, q27, q28, q29, q30, q31, q32, q33, q34, q35, q36,
         q37, q38], start=1)
}
