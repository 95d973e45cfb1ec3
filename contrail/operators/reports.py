"""Flight-report attachment and the per-family report-message roster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import report_nkey
from .ranges import left_join

# Report types kept by the message roster.
REPORT_TYPES = ["Engine Start", "TakeOff", "Climb", "Cruise", "PostFlight", "Post Flight Summary"]

# Message-id columns of a report flight, in priority order.
MESSAGE_ID_COLUMNS = ["st_message_seq_id", "tk_message_seq_id", "cl_message_seq_id",
                      "cr1_message_seq_id", "pf_message_seq_id"]

ROSTER_COLUMNS = ["message_seq_id_rmd", "rmd_flight_def_id", "serlzd_eng_ser_num",
                  "engine_position", "airport_depart", "airport_dest", "nkey",
                  "message_date_time", "message_seq_id", "engine_family"]


def attach_reports(legs: DataFrame, reports: DataFrame, *, leg_id: str, report_id: str,
                   fallbacks: Mapping[str, tuple[str, str]] | None = None,
                   drop: Sequence[str] = ()) -> DataFrame:
    """Left join ``reports`` on ``legs[leg_id] == reports[report_id]`` (fans
    out on repeated report ids). ``fallbacks`` maps an output name to
    ``(leg column, report column)``: the leg value, else the report's. The
    report id column, the fallback report columns and ``drop`` are removed."""
    fallbacks = dict(fallbacks or {})
    out = left_join(legs, reports, [(leg_id, report_id)])
    out = out.withColumns({name: F.coalesce(F.col(a), F.col(b))
                           for name, (a, b) in fallbacks.items()})
    gone = {report_id, *drop, *[b for _, b in fallbacks.values()]}
    return out.drop(*[c for c in gone if c not in fallbacks])


def _flight_cols():
    return [F.coalesce(*[F.col(c) for c in MESSAGE_ID_COLUMNS]).alias("message_seq_id_rmd"),
            "rmd_flight_def_id", "serlzd_eng_ser_num", "engine_position", "airport_depart",
            "airport_dest"]


def _param_cols():
    return [report_nkey("src_icao_cd", "serlzd_eng_ser_num", "engine_position",
                        "install_datetime").alias("nkey"),
            "message_date_time", "message_seq_id"]


def roster_flights(flights: DataFrame) -> DataFrame:
    """Distinct report flights keyed by their first non-NULL message id."""
    return flights.select(*_flight_cols()).distinct()


def roster_params(params: DataFrame, report_types: Sequence[str] = REPORT_TYPES) -> DataFrame:
    """Distinct report parameters of the listed types with their ``nkey``."""
    return (params.where(F.col("report_type").isin(list(report_types)))
            .select(*_param_cols()).distinct())


def message_roster(sources: Sequence[tuple[str, DataFrame, DataFrame]],
                   report_types: Sequence[str] = REPORT_TYPES) -> DataFrame:
    """Staging frame of report messages for several engine families.

    ``sources`` holds ``(family, flights, params)``. Per family: distinct
    flights (message id = first non-NULL of the five message ids), distinct
    parameters of the listed report types, inner join on the message id,
    family tag; then the union of all families.

    Plan: the families are tagged and unioned *before* the distinct and the
    join, so the whole roster is one pair of aggregates and one join keyed by
    (family, message id) instead of one pipeline per family.
    """
    fl = None
    pa = None
    for family, flights, params in sources:
        f = flights.select(*_flight_cols(), F.lit(family).alias("engine_family"))
        p = (params.where(F.col("report_type").isin(list(report_types)))
             .select(*_param_cols(), F.lit(family).alias("_fam")))
        fl = f if fl is None else fl.unionByName(f)
        pa = p if pa is None else pa.unionByName(p)
    fl, pa = fl.distinct(), pa.distinct()
    joined = fl.join(pa, on=[fl["engine_family"] == pa["_fam"],
                             fl["message_seq_id_rmd"] == pa["message_seq_id"]])
    return joined.select(*ROSTER_COLUMNS)
