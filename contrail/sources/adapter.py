"""Adapter: role frames -> the input schemas of the common-flight build.

Every input is a projection of a role frame (and so of a driver table).
Tail, ESN and position are filled so that the legs of one user share a tail
and its four engine serial numbers are ``E<user>-<position>``. Projections are
written as SQL expressions (``selectExpr``): one JVM-side parse per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.common_flight import REPORT_KINDS, SEDI_COLUMNS
from . import roles
from .roles import airport_code_sql
from .tables import Tables

FAMILY = "GENX"

def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _family(user: str) -> str:
    """A third of the users fly another family than the one that is built."""
    return f"CASE WHEN {user} % 3 = 0 THEN 'CF34' ELSE '{FAMILY}' END"


def _esn(user: str, pos: str) -> str:
    return f"concat('E', {_s(user)}, '-', {_s(pos)})"


def _day(start: str, days: str) -> str:
    return f"timestampadd(DAY, {days}, TIMESTAMP_NTZ'{start} 00:00:00')"


def phm(t: Tables) -> DataFrame:
    return roles.legs(t).selectExpr(
        f"{_family('key')} AS engine_family", "leg_id AS phm_flight_def_id",
        f"concat('C', {_s('key % 10')}) AS src_icao_cd",
        f"{_esn('key', 'pos')} AS serlzd_eng_ser_num",
        f"concat('AT', {_s('key % 30')}) AS aircraft_type",
        f"CASE WHEN leg_id % 6 = 0 THEN NULL ELSE concat('ET', {_s('key % 3')}) END AS engine_type",
        "CAST(pos AS INT) AS engine_position",
        f"concat(' t-', {_s('key')}, ' ') AS src_tl_num",
        f"{_day('2020-01-01', 'key')} AS install_datetime",
        "CASE WHEN key % 5 = 0 THEN TIMESTAMP_NTZ'2025-01-01 00:00:00' END AS removal_datetime",
        "start_ts AS flight_start_time", "end_ts AS flight_end_time",
        "CASE WHEN leg_id % 9 = 0 THEN NULL ELSE dep END AS cleansed_airport_depart_icao",
        "arr AS cleansed_airport_destination_icao",
        "substring(dep, 2, 3) AS cleansed_airport_depart_iata",
        "substring(arr, 2, 3) AS cleansed_airport_destination_iata",
        "start_ts AS best_datetime", f"concat('ST', {_s('leg_id')}) AS phm_st_id",
        "start_ts AS phm_st_date_time", f"concat('MF', {_s('leg_id')}) AS master_flght_id",
        "CAST(n_eng AS INT) AS no_of_engs")


def aircraft_types(t: Tables) -> DataFrame:
    """Twenty types, five of them listed twice."""
    return t.nation.selectExpr(
        f"concat('AT', {_s('n_nationkey % 20')}) AS aircrft_typ_cd",
        f"concat('FAM', {_s('n_nationkey % 2')}) AS vld_arfrmr_nm")


def ffd(t: Tables) -> DataFrame:
    return roles.recs(t).selectExpr(
        f"{_family('key')} AS ffd_engine_family", f"{_esn('key', 'rec_id % 4 + 1')} AS ffd_esn",
        "CAST(rec_id % 4 + 1 AS INT) AS ffd_engine_position",
        f"concat('T', {_s('key')}) AS ffd_tail_number", "rec_ts AS flight_date_exact",
        "rec_id AS adi_flight_record_number", f"concat('FK', {_s('rec_id')}) AS flight_key_no",
        f"concat('C', {_s('key % 10')}) AS ffd_icao_cd",
        f"concat('AT', {_s('key % 5')}) AS ffd_aircraft_type",
        f"concat('ET', {_s('key % 3')}) AS ffd_engine_type",
        f"{_day('2020-01-02', 'key')} AS ffd_install_date", "rec_dep AS ffd_depart_icao",
        f"{airport_code_sql('(key + rec_id % 7) div 2')} AS ffd_arrival_icao")


def fa(t: Tables) -> DataFrame:
    return roles.obs(t).selectExpr(
        f"{_family('key')} AS fa_engine_family", f"concat('T', {_s('key')}) AS fa_tail_number",
        f"{_esn('key', 'obs_id % 4 + 1')} AS fa_esn",
        "CAST(obs_id % 4 + 1 AS INT) AS fa_eng_position", "obs_ts AS faware_dt",
        "obs_id AS internal_id", f"concat('FA', {_s('obs_id')}) AS faware_id",
        f"concat('C', {_s('key % 10')}) AS fa_icao_cd",
        f"concat('AT', {_s('key % 5')}) AS fa_aircraft_type",
        f"{_day('2020-01-03', 'key')} AS fa_eng_instl_dt",
        "CASE WHEN obs_id % 4 = 0 THEN TIMESTAMP_NTZ'2026-01-01 00:00:00' END AS fa_eng_rmvl_dt",
        "CAST(obs_id % 3 + 2 AS INT) AS no_of_engines",
        "timestampadd(HOUR, -1, obs_ts) AS planned_flight_time_utc",
        "obs_ts AS estimated_depart_time_utc",
        "timestampadd(HOUR, 2, obs_ts) AS estimated_dest_time_utc",
        "obs_dep AS faware_depart",
        f"{airport_code_sql('(key + obs_id % 6) div 2')} AS faware_destination",
        "CAST(NULL AS TIMESTAMP_NTZ) AS timeline_begin_date",
        "CAST(NULL AS TIMESTAMP_NTZ) AS timeline_end_date",
        f"CASE WHEN obs_id % 2 = 0 THEN '{FAMILY}' END AS engine_family_mdm",
        f"CASE WHEN obs_id % 3 = 0 THEN concat('FM', {_s('obs_id % 4')}) END AS engine_model_mdm",
        f"CASE WHEN obs_id % 5 = 0 THEN concat('FS', {_s('obs_id % 2')}) END AS engine_series_mdm",
        "CAST(NULL AS STRING) AS esn_sister_array", "CAST(NULL AS STRING) AS esn_sister_comment",
        *[f"CASE WHEN obs_id % 7 = 0 THEN {_esn('key', str(j))} END AS eng_pos_{j}_esn"
          for j in range(1, 5)])


def denorm(t: Tables) -> DataFrame:
    return roles.timeline(t).selectExpr(
        f"{_esn('tl_key', 'tl_id % 4 + 1')} AS esn",
        f"concat('T', {_s('tl_key')}) AS denorm_tail_number",
        "begin_ts AS timeline_begin_date", "end_ts AS timeline_end_date",
        f"{_family('tl_key')} AS engine_family_denorm", f"'{FAMILY}' AS engine_family_mdm",
        "engine_model_mdm", "engine_series_mdm",
        *[f"CASE WHEN (tl_key + {j}) % 3 = 0 THEN NULL ELSE {_esn('tl_key', str(j))} END "
          f"AS eng_pos_{j}_esn" for j in range(1, 5)],
        f"concat('SIS', {_s('tl_key')}) AS esn_sister_array",
        f"concat('C', {_s('tl_id')}) AS esn_sister_comment")


def fdm(t: Tables) -> DataFrame:
    return roles.hist(t).selectExpr(
        f"{_esn('hist_key', 'removals % 4 + 1')} AS serialized_engine_id",
        "ev_ts AS event_date", "CAST(removals AS INT) AS current_removal_count",
        "CAST(visits AS INT) AS current_shop_visit_count")


def phm_rmd(t: Tables) -> DataFrame:
    rid = "report_def_id"
    cols = [f"{rid} AS phm_flight_def_id"]
    cols += [f"{rid} % {n + 7} AS {c}" for n, c in enumerate(SEDI_COLUMNS)]
    for kind in REPORT_KINDS:
        for j in range(1, 5):
            cols.append(f"CASE WHEN ({rid} + {j}) % 4 != 0 THEN concat('{kind.upper()}{j}-', "
                        f"{_s(rid)}) END AS {kind}_rprt_id_eng_pos_{j}")
        cols.append(f"concat('{kind.upper()}-', {_s(rid)}) AS {kind}_rprt_id_eng_pos_array")
    cols += [f"{rid} AS rmd_flight_def_id", "rmd_dep AS airport_depart", "rmd_arr AS airport_dest",
             f"concat('ES', {_s(rid + ' % 3')}) AS dlgs_es_ct_code",
             f"concat('TO', {_s(rid + ' % 4')}) AS dlgs_to_ct_code"]
    return roles.reports(t).selectExpr(*cols)


def common_flight_inputs(t: Tables) -> dict[str, DataFrame]:
    """All eleven inputs of the common-flight build."""
    return {
        "phm": phm(t), "aircraft_type": aircraft_types(t), "ffd": ffd(t), "fa": fa(t),
        "metar": roles.wx(t), "airports": roles.airports(t), "env": roles.env_dated(t),
        "env_ver": roles.env_undated(t), "denorm": denorm(t), "fdm": fdm(t),
        "phm_rmd": phm_rmd(t),
    }
