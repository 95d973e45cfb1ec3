"""Role frames: the driver tables re-cast as the inputs of the stitching job.

Each role is a projection (sometimes an aggregate) of one driver table, so it
grows with the table and the DuckDB oracle can define it with the same
expressions (see ``contrail.plans.oracle``). The event types of ``events``
stand for the different record sources; a role without a second source reads
every event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Tables

# Engine families of the report roster, in roster order.
ROSTER_FAMILIES = ["cf34", "cf6", "cfm56", "ge90", "genx", "gp7270", "leap"]

# Report types of the parameter role (the first six are the
# ones the roster keeps).
PARAM_REPORT_TYPES = ["Engine Start", "TakeOff", "Climb", "Cruise", "PostFlight",
                      "Post Flight Summary", "Ground Run", "Maintenance"]


def airport_code_sql(n: str) -> str:
    """SQL text of :func:`airport_code` for the SQL expression ``n``."""
    return (f"CASE WHEN ({n}) < 20 THEN concat('K', lpad(CAST(({n}) AS STRING), 3, '0')) "
            f"ELSE concat('X', CAST(({n}) AS STRING)) END")


def airport_code(n: Column | str) -> Column:
    """Codes 0..19 -> 'K000'..'K019' (4 characters); others -> 'X<n>'.
    ``n`` may be a SQL expression string (one JVM-side parse)."""
    if isinstance(n, str):
        return F.expr(airport_code_sql(n))
    return F.when(n < 20, F.concat(F.lit("K"), F.lpad(n.cast("string"), 3, "0"))) \
            .otherwise(F.concat(F.lit("X"), n.cast("string")))


def _events(t: Tables, kind: str | None) -> DataFrame:
    """Events of a kind (None: all), each user's moved by 0 to 13 times 30
    days, so that the times of ``events`` spread over fourteen months."""
    e = t.events if kind is None else t.events.where(F.col("event_type") == kind)
    return e.withColumn("ts", F.expr("timestampadd(DAY, CAST(user_id % 14 * 30 AS INT), ts)"))


def _esn(k: int) -> Column:
    u = F.col("user_id")
    return F.when((u + k) % 3 == 0, F.lit(None).cast("string")) \
            .otherwise(F.concat(F.lit("E"), u.cast("string"), F.lit(f"-{k}")))


def legs(t: Tables, kind: str | None = "purchase") -> DataFrame:
    """PHM flights: one per purchase event (``kind=None``: per event)."""
    e, u = F.col("event_id"), F.col("user_id")
    return _events(t, kind).select(
        e.alias("leg_id"),
        F.concat(F.lit("T-"), u.cast("string")).alias("tail"),
        u.alias("key"),
        (e % 4 + 1).alias("pos"),
        F.col("ts").alias("start_ts"),
        F.timestamp_add("SECOND", F.floor(F.col("value") * 1800), F.col("ts")).alias("end_ts"),
        airport_code("user_id div 2").alias("dep"),
        airport_code("(user_id + event_id % 9) div 2").alias("arr"),
        (e % 3 + 2).alias("n_eng"),
        *[_esn(k).alias(f"esn_{k}") for k in range(1, 5)],
    )


def repeated_legs(t: Tables) -> DataFrame:
    """The flights with every twentieth listed again a minute later, and every
    seventeenth without an id."""
    rows = legs(t).select("leg_id", "key", "start_ts", "end_ts")
    again = rows.where(F.col("leg_id") % 20 == 0).withColumn(
        "start_ts", F.timestamp_add("MINUTE", F.lit(1), F.col("start_ts")))
    none = F.col("leg_id") % 17 == 0
    return rows.unionByName(again).withColumn("leg_id", F.when(~none, F.col("leg_id")))


def recs(t: Tables) -> DataFrame:
    """Full-flight-data recordings: view events."""
    e = F.col("event_id")
    return _events(t, "view").select(
        e.alias("rec_id"), F.col("user_id").alias("key"), F.col("ts").alias("rec_ts"),
        F.when(e % 4 == 0, F.lit(None).cast("string")).otherwise(airport_code("(user_id + event_id % 5) div 2"))
        .alias("rec_dep"))


def obs(t: Tables) -> DataFrame:
    """Flight-tracking observations: click events."""
    e = F.col("event_id")
    return _events(t, "click").select(
        e.alias("obs_id"), F.col("user_id").alias("key"), F.col("ts").alias("obs_ts"),
        airport_code("(user_id + event_id % 5) div 2").alias("obs_dep"))


def wx(t: Tables) -> DataFrame:
    """Weather readings packed per (airport, month, station): error events. An
    airport and month can have several rows, so that no list grows with the
    whole airport."""
    reading = F.concat(F.col("event_id").cast("string"), F.lit("@"),
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return (_events(t, "error")
            .groupBy(airport_code("user_id div 2").alias("airport_str"),
                     F.date_format("ts", "yyyyMM").alias("metar_year_month"), "user_id")
            .agg(F.collect_list(reading).alias("metar_arr")).drop("user_id"))


def airports(t: Tables) -> DataFrame:
    """Airport coordinates (radians) from customer: every other airport has some."""
    n = F.col("c_custkey")
    return t.customer.select(airport_code("c_custkey * 2").alias("airport_code"),
                             F.radians(n % 24 * 7 - 84).alias("latitude_rad"),
                             F.radians(n % 25 * 14 - 168).alias("longitude_rad"))


def env_dated(t: Tables) -> DataFrame:
    """Dated environment ids per (airport, day): signup events."""
    lo, hi = F.min("event_id"), F.max("event_id")
    return (_events(t, "signup")
            .groupBy(airport_code("user_id div 2").alias("icao_code"),
                     F.col("ts").cast("date").alias("nrl_date_year"))
            .agg(lo.alias("env_airport_id"),
                 F.concat(F.lit("V6-"), lo.cast("string")).alias("env_6x_id"),
                 F.when(lo % 3 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("V5-"), lo.cast("string"))).alias("env_5x_id"),
                 F.concat(F.lit("V4-"), hi.cast("string")).alias("env_4x_id")))


def env_undated(t: Tables) -> DataFrame:
    """Undated environment ids per airport that has a signup event."""
    lo, hi = F.min("event_id"), F.max("event_id")
    return (_events(t, "signup")
            .groupBy(airport_code("user_id div 2").alias("icao_code"))
            .agg(lo.alias("env_airport_id"),
                 F.concat(F.lit("U6-"), lo.cast("string")).alias("env_6x_id"),
                 F.concat(F.lit("U5-"), hi.cast("string")).alias("env_5x_id"),
                 F.concat(F.lit("U4-"), lo.cast("string")).alias("env_4x_id")))


def timeline(t: Tables) -> DataFrame:
    """Engine master-data validity periods: each error event opens a period
    that the user's next error event closes (the last stays open: NULL)."""
    e = F.col("event_id")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _events(t, "error").select(
        F.col("user_id").alias("tl_key"), e.alias("tl_id"), F.col("ts").alias("begin_ts"),
        F.lead("ts").over(w).alias("end_ts"),
        F.concat(F.lit("M"), (e % 5).cast("string")).alias("engine_model_mdm"),
        F.concat(F.lit("S"), (e % 3).cast("string")).alias("engine_series_mdm"))


def hist(t: Tables) -> DataFrame:
    """Engine removal / shop-visit events: signup events."""
    e = F.col("event_id")
    return _events(t, "signup").select(
        F.col("user_id").alias("hist_key"), F.col("ts").alias("ev_ts"),
        (e % 7).alias("removals"), (e % 5).alias("visits"))


def reports(t: Tables) -> DataFrame:
    """Flight reports per purchase event; two in three name no flight (a
    negative id)."""
    e = F.col("event_id")
    return _events(t, "purchase").select(
        F.when(e % 3 == 0, e).otherwise(-e).alias("report_def_id"), F.concat(F.lit("R"), e.cast("string")).alias("report_id"),
        airport_code("(user_id + event_id % 5) div 2").alias("rmd_dep"),
        airport_code("(user_id + event_id % 3) div 2").alias("rmd_arr"))


def _family(u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f in ROSTER_FAMILIES]),
                        (u % len(ROSTER_FAMILIES) + 1).cast("int"))


def rmd_flights(t: Tables) -> DataFrame:
    """Report flights: purchase events with up to five message ids."""
    e, u, m = F.col("event_id"), F.col("user_id"), F.expr("event_id div 8")
    none = F.lit(None).cast("long")
    return _events(t, "purchase").select(
        F.when(e % 5 == 0, m).alias("st_message_seq_id"),
        F.when(e % 5 == 1, m).alias("tk_message_seq_id"),
        F.when(e % 5 == 2, m).alias("cl_message_seq_id"),
        F.when(e % 7 == 0, m).alias("cr1_message_seq_id"),
        none.alias("pf_message_seq_id"),
        e.alias("rmd_flight_def_id"),
        F.concat(F.lit("E"), u.cast("string")).alias("serlzd_eng_ser_num"),
        (e % 4 + 1).alias("engine_position"),
        airport_code("user_id div 2").alias("airport_depart"),
        airport_code("(user_id + event_id % 9) div 2").alias("airport_dest"),
        _family(m).alias("family"))


def rmd_params(t: Tables) -> DataFrame:
    """Report parameters: click events."""
    e, u, m = F.col("event_id"), F.col("user_id"), F.expr("event_id div 8")
    types = F.array(*[F.lit(x) for x in PARAM_REPORT_TYPES])
    return _events(t, "click").select(
        m.alias("message_seq_id"),
        F.when(u % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), (u % 10).cast("string"))).alias("src_icao_cd"),
        F.when(u % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("E"), u.cast("string"))).alias("serlzd_eng_ser_num"),
        F.when(e % 13 == 0, F.lit(None).cast("long")).otherwise(e % 4 + 1).alias("engine_position"),
        F.when(u % 9 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("DAY", u, F.expr("TIMESTAMP_NTZ'2020-01-01 00:00:00'")))
        .alias("install_datetime"),
        F.col("ts").alias("message_date_time"),
        F.element_at(types, (e % len(PARAM_REPORT_TYPES) + 1).cast("int")).alias("report_type"),
        _family(m).alias("family"))
