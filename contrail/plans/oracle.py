"""DuckDB SQL for every registered query (the correctness oracle).

The role CTEs restate ``contrail.sources.roles`` in SQL over the same driver
tables; each query is then written the direct, brute-force way (plain range
joins, ``row_number``) so it checks the Spark plans independently.
"""

from __future__ import annotations


def _code(n: str) -> str:
    return (f"(CASE WHEN ({n}) < 20 THEN 'K' || lpad(CAST(({n}) AS VARCHAR), 3, '0') "
            f"ELSE 'X' || CAST(({n}) AS VARCHAR) END)")


def _esn(k: int) -> str:
    return (f"CASE WHEN (user_id + {k}) % 3 = 0 THEN NULL "
            f"ELSE 'E' || CAST(user_id AS VARCHAR) || '-{k}' END AS esn_{k}")


def _secs(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


FAMILIES = ["cf34", "cf6", "cfm56", "ge90", "genx", "gp7270", "leap"]
PARAM_TYPES = ["Engine Start", "TakeOff", "Climb", "Cruise", "PostFlight",
               "Post Flight Summary", "Ground Run", "Maintenance"]
KEPT_TYPES = PARAM_TYPES[:6]


def _list(xs) -> str:
    return "[" + ", ".join("'" + x + "'" for x in xs) + "]"


ROLES = {
    "legs": f"""legs AS (
  SELECT event_id AS leg_id, 'T-' || CAST(user_id AS VARCHAR) AS tail, user_id AS key,
         event_id % 4 + 1 AS pos, ts AS start_ts,
         ts + to_seconds(CAST(floor(value * 1800) AS BIGINT)) AS end_ts,
         {_code('user_id // 2')} AS dep, {_code('(user_id + event_id % 9) // 2')} AS arr,
         event_id % 3 + 2 AS n_eng, {', '.join(_esn(k) for k in range(1, 5))}
  FROM ev WHERE event_type = 'purchase')""",
    "recs": f"""recs AS (
  SELECT event_id AS rec_id, user_id AS key, ts AS rec_ts,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE {_code('(user_id + event_id % 5) // 2')} END AS rec_dep
  FROM ev WHERE event_type = 'view')""",
    "obs": f"""obs AS (
  SELECT event_id AS obs_id, user_id AS key, ts AS obs_ts, {_code('(user_id + event_id % 5) // 2')} AS obs_dep
  FROM ev WHERE event_type = 'click')""",
    "wx": f"""wx AS (
  SELECT {_code('user_id // 2')} AS airport_str, strftime(ts, '%Y%m') AS metar_year_month,
         list(CAST(event_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))
           AS metar_arr
  FROM ev WHERE event_type = 'error' GROUP BY 1, 2, user_id)""",
    "airports": f"""airports AS (
  SELECT {_code('c_custkey * 2')} AS airport_code, radians(c_custkey % 24 * 7 - 84) AS latitude_rad,
         radians(c_custkey % 25 * 14 - 168) AS longitude_rad FROM customer)""",
    "env_dated": f"""env_dated AS (
  SELECT {_code('user_id // 2')} AS icao_code, CAST(ts AS DATE) AS nrl_date_year,
         min(event_id) AS env_airport_id, 'V6-' || CAST(min(event_id) AS VARCHAR) AS env_6x_id,
         CASE WHEN min(event_id) % 3 = 0 THEN NULL ELSE 'V5-' || CAST(min(event_id) AS VARCHAR)
         END AS env_5x_id, 'V4-' || CAST(max(event_id) AS VARCHAR) AS env_4x_id
  FROM ev WHERE event_type = 'signup' GROUP BY 1, 2)""",
    "env_undated": f"""env_undated AS (
  SELECT {_code('user_id // 2')} AS icao_code, min(event_id) AS env_airport_id,
         'U6-' || CAST(min(event_id) AS VARCHAR) AS env_6x_id,
         'U5-' || CAST(max(event_id) AS VARCHAR) AS env_5x_id,
         'U4-' || CAST(min(event_id) AS VARCHAR) AS env_4x_id
  FROM ev WHERE event_type = 'signup' GROUP BY 1)""",
    "timeline": """timeline AS (
  SELECT user_id AS tl_key, event_id AS tl_id, ts AS begin_ts,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts,
         'M' || CAST(event_id % 5 AS VARCHAR) AS engine_model_mdm,
         'S' || CAST(event_id % 3 AS VARCHAR) AS engine_series_mdm
  FROM ev WHERE event_type = 'error')""",
    "hist": """hist AS (
  SELECT user_id AS hist_key, ts AS ev_ts, event_id % 7 AS removals, event_id % 5 AS visits
  FROM ev WHERE event_type = 'signup')""",
    "reports": f"""reports AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN event_id ELSE -event_id END AS report_def_id, 'R' || CAST(event_id AS VARCHAR) AS report_id,
         {_code('(user_id + event_id % 5) // 2')} AS rmd_dep, {_code('(user_id + event_id % 3) // 2')} AS rmd_arr
  FROM ev WHERE event_type = 'purchase')""",
    "rmd_flights": f"""rmd_flights AS (
  SELECT CASE WHEN event_id % 5 = 0 THEN event_id // 8 END AS st_message_seq_id,
         CASE WHEN event_id % 5 = 1 THEN event_id // 8 END AS tk_message_seq_id,
         CASE WHEN event_id % 5 = 2 THEN event_id // 8 END AS cl_message_seq_id,
         CASE WHEN event_id % 7 = 0 THEN event_id // 8 END AS cr1_message_seq_id,
         CAST(NULL AS BIGINT) AS pf_message_seq_id, event_id AS rmd_flight_def_id,
         'E' || CAST(user_id AS VARCHAR) AS serlzd_eng_ser_num, event_id % 4 + 1 AS engine_position,
         {_code('user_id // 2')} AS airport_depart, {_code('(user_id + event_id % 9) // 2')} AS airport_dest,
         {_list(FAMILIES)}[(event_id // 8) % 7 + 1] AS family
  FROM ev WHERE event_type = 'purchase')""",
    "rmd_params": f"""rmd_params AS (
  SELECT event_id // 8 AS message_seq_id,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'C' || CAST(user_id % 10 AS VARCHAR) END AS src_icao_cd,
         CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'E' || CAST(user_id AS VARCHAR) END AS serlzd_eng_ser_num,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 4 + 1 END AS engine_position,
         CASE WHEN user_id % 9 = 0 THEN NULL
              ELSE TIMESTAMP '2020-01-01 00:00:00' + to_days(CAST(user_id AS INTEGER)) END AS install_datetime,
         ts AS message_date_time, {_list(PARAM_TYPES)}[event_id % 8 + 1] AS report_type,
         {_list(FAMILIES)}[(event_id // 8) % 7 + 1] AS family
  FROM ev WHERE event_type = 'click')""",
}


ROLES["all_legs"] = ROLES["legs"].replace(" WHERE event_type = 'purchase'", "")
ROLES["repeated_legs"] = """repeated AS (
  SELECT CASE WHEN leg_id % 17 <> 0 THEN leg_id END AS leg_id, key, start_ts, end_ts FROM (
    SELECT leg_id, key, start_ts, end_ts FROM legs UNION ALL
    SELECT leg_id, key, start_ts + INTERVAL 1 MINUTE, end_ts FROM legs WHERE leg_id % 20 = 0))"""

EV = """ev AS (
  SELECT * REPLACE (ts + to_days(CAST(user_id % 14 * 30 AS INTEGER)) AS ts) FROM events)"""


def _with(*names: str, extra: str = "") -> str:
    parts = [EV, *[ROLES[n] for n in names]]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


_MATCH = """m AS (
  SELECT l.leg_id, l.key, r.rec_id FROM legs l JOIN recs r
    ON l.key = r.key AND r.rec_ts BETWEEN l.start_ts - INTERVAL 20 MINUTE AND l.end_ts),
q3 AS (
  SELECT l.leg_id, l.key, max(m.rec_id) AS rec_id,
         coalesce(string_agg(CAST(m.rec_id AS VARCHAR), ',' ORDER BY m.rec_id), '') AS rec_ids,
         CAST(count(m.rec_id) AS BIGINT) AS rec_count
  FROM legs l LEFT JOIN m ON l.leg_id = m.leg_id GROUP BY l.leg_id, l.key),
q4 AS (
  SELECT leg_id, key, rec_id, rec_ids, rec_count FROM q3
  UNION ALL
  SELECT NULL, r.key, r.rec_id, CAST(r.rec_id AS VARCHAR), 1
  FROM (SELECT DISTINCT rec_id, key FROM recs) r
  WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.rec_id = r.rec_id AND m.key = r.key)),
q5 AS (
  SELECT q4.*, r.rec_ts, r.rec_dep FROM q4 LEFT JOIN recs r ON q4.rec_id = r.rec_id AND q4.key = r.key)"""

_FA = """fa_rows AS (
  SELECT q5.*, l.start_ts, l.end_ts, l.dep,
         coalesce(l.start_ts, q5.rec_ts - INTERVAL 25 MINUTE) AS lo,
         coalesce(l.end_ts, q5.rec_ts + INTERVAL 25 MINUTE) AS hi,
         coalesce(l.start_ts, q5.rec_ts) AS at
  FROM q5 LEFT JOIN legs l ON q5.leg_id = l.leg_id),
fa_c AS (
  SELECT f.leg_id, f.rec_id, o.obs_id, o.obs_dep,
         row_number() OVER (PARTITION BY f.leg_id, f.rec_id ORDER BY
           abs(""" + _secs("f.at") + " - " + _secs("o.obs_ts") + """),
           sign(""" + _secs("f.at") + " - " + _secs("o.obs_ts") + """), o.obs_id) AS rn
  FROM fa_rows f JOIN obs o ON f.key = o.key AND o.obs_ts BETWEEN f.lo AND f.hi),
fa AS (
  SELECT f.*, c.obs_id, c.obs_dep FROM fa_rows f LEFT JOIN fa_c c
    ON f.leg_id IS NOT DISTINCT FROM c.leg_id AND f.rec_id IS NOT DISTINCT FROM c.rec_id
   AND (f.leg_id IS NULL OR c.rn = 1))"""


def _nearest_wx(end: str, code: str, ts: str) -> str:
    at = f"l.{ts}"
    return f"""wx_{end} AS (
  SELECT leg_id, id FROM (
    SELECT l.leg_id, r.id, row_number() OVER (PARTITION BY l.leg_id ORDER BY
             abs({_secs('r.rts')} - {_secs(at)}), sign({_secs('r.rts')} - {_secs(at)}), r.id) AS rn
    FROM legs l JOIN rd r ON r.airport_str = l.{code}
      AND r.metar_year_month BETWEEN strftime({at} - INTERVAL 5 HOUR, '%Y%m')
                                 AND strftime({at} + INTERVAL 5 HOUR, '%Y%m')
    WHERE r.rts IS NOT NULL) WHERE rn = 1)"""


def _gcd(lat1, lon1, lat2, lon2) -> str:
    dl = f"abs({lon1} - {lon2})"
    return (f"3959.0 * atan2(sqrt(pow(cos({lat2}) * sin({dl}), 2) + pow(cos({lat1}) * sin({lat2}) "
            f"- sin({lat1}) * cos({lat2}) * cos({dl}), 2)), sin({lat1}) * sin({lat2}) + "
            f"cos({lat1}) * cos({lat2}) * cos({dl}))")


_PAIRS = """pairs AS (
  SELECT DISTINCT dep, arr FROM legs WHERE dep IS NOT NULL AND arr IS NOT NULL),
coords AS (SELECT DISTINCT airport_code, latitude_rad, longitude_rad FROM airports),
dist AS (
  SELECT p.dep, p.arr, """ + _gcd("d.latitude_rad", "d.longitude_rad", "a.latitude_rad",
                                  "a.longitude_rad") + """ AS great_circle_distance
  FROM pairs p JOIN coords d ON p.dep = d.airport_code JOIN coords a ON p.arr = a.airport_code)"""


def _env(end: str, code: str, day: str) -> str:
    return f"""env_{end} AS (
  SELECT l.leg_id,
         CASE WHEN d.env_airport_id IS NOT NULL THEN d.env_airport_id ELSE coalesce(d.env_airport_id, u.env_airport_id) END AS environment_id_{end},
         CASE WHEN d.env_airport_id IS NOT NULL THEN d.env_6x_id ELSE coalesce(d.env_6x_id, u.env_6x_id) END AS airport_{end}_env_6x_id,
         CASE WHEN d.env_airport_id IS NOT NULL THEN d.env_5x_id ELSE coalesce(d.env_5x_id, u.env_5x_id) END AS airport_{end}_env_5x_id,
         CASE WHEN d.env_airport_id IS NOT NULL THEN d.env_4x_id ELSE coalesce(d.env_4x_id, u.env_4x_id) END AS airport_{end}_env_4x_id
  FROM legs l
  LEFT JOIN env_dated d ON l.{code} = d.icao_code AND CAST(l.{day} AS DATE) = d.nrl_date_year
                       AND length(l.{code}) = 4
  LEFT JOIN env_undated u ON l.{code} = u.icao_code AND d.env_airport_id IS NULL)"""


_MARK = """lagged AS (
  SELECT l.*, lag(start_ts) OVER w AS p_at, lag(start_ts) OVER w AS p_st, lag(end_ts) OVER w AS p_en
  FROM legs l WINDOW w AS (PARTITION BY tail ORDER BY start_ts ASC NULLS FIRST,
                                                      pos ASC NULLS FIRST, leg_id ASC NULLS FIRST)),
marked AS (
  SELECT * EXCLUDE (p_at, p_st, p_en),
         NOT coalesce(start_ts BETWEEN coalesce(p_st, p_at) AND coalesce(p_en, p_at)
                      OR start_ts = p_at, false) AS is_parent
  FROM lagged)"""

_SIBS = _MARK + """,
parents AS (SELECT * FROM marked WHERE is_parent),
kids AS (
  SELECT c.*, CASE WHEN c.tail IS NOT NULL THEN p.start_ts END AS parent_datetime
  FROM (SELECT * FROM marked WHERE NOT is_parent) c
  LEFT JOIN parents p ON c.tail = p.tail AND c.start_ts BETWEEN p.start_ts AND p.end_ts),
sib AS (
  SELECT *, CASE WHEN tail IS NOT NULL THEN start_ts END AS parent_datetime FROM parents
  UNION
  SELECT * FROM kids),
groups AS (
  SELECT tail, parent_datetime,
         list(leg_id ORDER BY start_ts ASC NULLS FIRST, pos ASC NULLS FIRST, leg_id ASC NULLS FIRST)
           FILTER (WHERE leg_id IS NOT NULL) AS ids
  FROM sib WHERE parent_datetime IS NOT NULL GROUP BY 1, 2),
sibs AS (
  SELECT s.*, g.ids FROM sib s LEFT JOIN groups g
    ON s.tail = g.tail AND s.parent_datetime = g.parent_datetime)"""


def _slot(k: int) -> str:
    cnt = " + ".join(f"(CASE WHEN esn_{j} IS NOT NULL THEN 1 ELSE 0 END)" for j in range(1, k + 1))
    return (f"CASE WHEN esn_{k} IS NULL THEN 'no_def_id' "
            f"ELSE CAST(ids[{cnt}] AS VARCHAR) END AS slot_{k}")


def _roster(families: list[str] | None) -> str:
    fam_f = "" if families is None else "WHERE family IN " + "(" + ", ".join(
        f"'{f}'" for f in families) + ")"
    fam_sel = "'genx'" if families is None else "family"
    return f"""fl AS (
  SELECT DISTINCT coalesce(st_message_seq_id, tk_message_seq_id, cl_message_seq_id,
                           cr1_message_seq_id, pf_message_seq_id) AS message_seq_id_rmd,
         rmd_flight_def_id, serlzd_eng_ser_num, engine_position, airport_depart, airport_dest,
         {fam_sel} AS engine_family
  FROM rmd_flights {fam_f}),
pa AS (
  SELECT DISTINCT coalesce(src_icao_cd, 'z') || coalesce(serlzd_eng_ser_num, 'x')
           || coalesce(CAST(engine_position AS VARCHAR), 'y')
           || coalesce(CAST({_secs('install_datetime')} AS VARCHAR), '-2') AS nkey,
         message_date_time, message_seq_id, {fam_sel} AS engine_family
  FROM rmd_params WHERE report_type IN ({', '.join("'" + x + "'" for x in KEPT_TYPES)}))"""


_ROSTER_SELECT = """SELECT fl.message_seq_id_rmd, fl.rmd_flight_def_id, fl.serlzd_eng_ser_num,
       fl.engine_position, fl.airport_depart, fl.airport_dest, pa.nkey, pa.message_date_time,
       pa.message_seq_id, fl.engine_family
FROM fl JOIN pa ON fl.engine_family = pa.engine_family AND fl.message_seq_id_rmd = pa.message_seq_id"""


SQL: dict[str, str] = {
    "q01": """SELECT c_custkey AS cust_id,
       upper(regexp_replace(trim(c_name), '[^a-zA-Z0-9]', '', 'g')) AS name_norm,
       CAST(c_nationkey AS BIGINT) AS nation_id
FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "q02": """SELECT s_suppkey, s_name, n_name AS nation_name
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "q03": _with("legs", "recs", extra=_MATCH) + "SELECT leg_id, rec_id, rec_ids, rec_count FROM q3",
    "q04": _with("legs", "recs", extra=_MATCH) + "SELECT leg_id, key, rec_id, rec_ids, rec_count FROM q4",
    "q05": _with("legs", "recs", extra=_MATCH) + "SELECT leg_id, key, rec_id, rec_ts FROM q5",
    "q06": _with("legs", "recs", extra=_MATCH) + """SELECT leg_id, rec_id,
  CASE WHEN rec_ts IS NOT NULL THEN 't' ELSE 'f' END AS has_duplicates,
  CASE WHEN rec_id IS NOT NULL THEN 't' ELSE 'f' END AS is_overlapping FROM q5""",
    "q07": _with("legs", "obs", extra="""c AS (
  SELECT l.leg_id, o.obs_id, row_number() OVER (PARTITION BY l.leg_id ORDER BY
           abs(""" + _secs("l.start_ts") + " - " + _secs("o.obs_ts") + """),
           sign(""" + _secs("l.start_ts") + " - " + _secs("o.obs_ts") + """), o.obs_id) AS rn
  FROM legs l JOIN obs o ON l.key = o.key
   AND o.obs_ts BETWEEN l.start_ts - INTERVAL 25 MINUTE AND l.end_ts + INTERVAL 25 MINUTE)""")
    + "SELECT l.leg_id, c.obs_id FROM legs l LEFT JOIN c ON l.leg_id = c.leg_id AND c.rn = 1",
    "q08": _with("legs", "recs", "obs", extra=_MATCH + ",\n" + _FA)
    + "SELECT leg_id, rec_id, obs_id FROM fa",
    "q09": _with("legs", "recs", "obs", extra=_MATCH + ",\n" + _FA) + """SELECT leg_id, rec_id, obs_id,
  coalesce(dep, rec_dep, obs_dep) AS best_depart,
  CASE WHEN rec_count > 1 THEN NULL WHEN dep IS NOT NULL THEN 'PHM'
       WHEN rec_dep IS NOT NULL THEN 'FFD' WHEN obs_dep IS NOT NULL THEN 'Flightaware' END AS depart_src
FROM fa""",
    "q10": _with("legs", "wx", extra="""rd AS (
  SELECT airport_str, metar_year_month, split_part(r, '@', 1) AS id,
         TRY_CAST(split_part(r, '@', 2) AS TIMESTAMP) AS rts
  FROM (SELECT airport_str, metar_year_month, unnest(metar_arr) AS r FROM wx)),
""" + _nearest_wx("dep", "dep", "start_ts") + ",\n" + _nearest_wx("arr", "arr", "end_ts"))
    + """SELECT l.leg_id, a.id AS metar_id_depart, b.id AS metar_id_destination
FROM legs l LEFT JOIN wx_dep a ON l.leg_id = a.leg_id LEFT JOIN wx_arr b ON l.leg_id = b.leg_id""",
    "q11": _with("legs", "airports", extra=_PAIRS)
    + "SELECT dep, arr, round(great_circle_distance, 3) AS great_circle_distance FROM dist",
    "q12": _with("legs", "airports", extra=_PAIRS)
    + """SELECT l.leg_id, round(d.great_circle_distance, 3) AS great_circle_distance
FROM legs l LEFT JOIN dist d ON l.dep = d.dep AND l.arr = d.arr""",
    "q13": _with("legs", "env_dated", "env_undated",
                 extra=_env("depart", "dep", "start_ts") + ",\n" + _env("destination", "arr", "end_ts"))
    + """SELECT a.leg_id, a.environment_id_depart, a.airport_depart_env_6x_id,
  a.airport_depart_env_5x_id, a.airport_depart_env_4x_id, b.environment_id_destination,
  b.airport_destination_env_6x_id, b.airport_destination_env_5x_id, b.airport_destination_env_4x_id
FROM env_depart a JOIN env_destination b ON a.leg_id = b.leg_id""",
    "q14": _with("legs", "timeline") + """SELECT l.leg_id, t.tl_id, t.engine_model_mdm, t.engine_series_mdm
FROM legs l LEFT JOIN timeline t ON l.key = t.tl_key AND l.start_ts BETWEEN t.begin_ts AND t.end_ts""",
    "q15": _with("all_legs", extra=_MARK) + "SELECT leg_id, tail, is_parent FROM marked",
    "q16": _with("all_legs", extra=_SIBS) + "SELECT leg_id, tail, is_parent, parent_datetime FROM sib",
    "q17": _with("all_legs", extra=_SIBS) + "SELECT leg_id, parent_datetime, "
    + "array_to_string(ids, ',') AS sibling_ids, slot_1, slot_2, slot_3, slot_4, "
    + "concat_ws(',', slot_1, slot_2, slot_3, slot_4) AS slots FROM ("
    + "SELECT *, " + ", ".join(_slot(k) for k in range(1, 5)) + " FROM sibs) x",
    "q18": _with("legs", "hist") + """SELECT l.leg_id, max(h.ev_ts) AS fdm_event_date,
  max(h.removals) AS fdm_removal_count, max(h.visits) AS fdm_shop_visit_count
FROM legs l LEFT JOIN hist h ON l.key = h.hist_key AND l.start_ts > h.ev_ts AND l.start_ts IS NOT NULL
GROUP BY l.leg_id""",
    "q19": _with("legs", "reports") + """SELECT l.leg_id, r.report_id,
  coalesce(CASE WHEN l.leg_id % 5 = 0 THEN NULL ELSE l.dep END, r.rmd_dep) AS airport_depart,
  coalesce(CASE WHEN l.leg_id % 7 = 0 THEN NULL ELSE l.arr END, r.rmd_arr) AS airport_destination
FROM legs l LEFT JOIN reports r ON l.leg_id = r.report_def_id""",
    "q20": _with("all_legs") + """SELECT leg_id, n_eng AS no_of_engines,
  CASE WHEN n_eng = 2 THEN (CASE WHEN pos = 1 THEN 'LI' WHEN pos = 2 THEN 'RI' END)
       WHEN n_eng = 3 THEN (CASE WHEN pos = 1 THEN 'LI' WHEN pos = 2 THEN 'C' WHEN pos = 3 THEN 'RI' END)
       WHEN n_eng = 4 THEN (CASE WHEN pos = 1 THEN 'LO' WHEN pos = 2 THEN 'LI' WHEN pos = 3 THEN 'RI'
                                 WHEN pos = 4 THEN 'RO' END) END AS engine_position_description
FROM legs""",
    "q21": _with("legs", "airports", extra=_PAIRS) + """SELECT l.leg_id,
  CASE WHEN d.great_circle_distance IS NULL THEN 't' ELSE 'f' END AS missing_distance,
  CASE WHEN l.esn_1 IS NULL THEN 't' ELSE 'f' END AS missing_esn_1,
  CASE WHEN l.esn_2 IS NULL THEN 't' ELSE 'f' END AS missing_esn_2,
  CASE WHEN l.esn_3 IS NULL THEN 't' ELSE 'f' END AS missing_esn_3,
  CASE WHEN l.esn_4 IS NULL THEN 't' ELSE 'f' END AS missing_esn_4
FROM legs l LEFT JOIN dist d ON l.dep = d.dep AND l.arr = d.arr""",
    "q22": _with("all_legs") + """SELECT leg_id,
  concat_ws('-', coalesce(CAST(leg_id AS VARCHAR), '0'), coalesce(esn_1, 'xxx')) AS "ID",
  concat_ws('_', esn_1, strftime(start_ts, '%Y%m%d')) AS enginefitstring,
  coalesce(dep, 'z') || coalesce(esn_1, 'x') || coalesce(CAST(pos AS VARCHAR), 'y')
    || coalesce(CAST(""" + _secs("start_ts") + """ AS VARCHAR), '-2') AS nkey
FROM legs""",
    "q23": _with("all_legs") + "SELECT leg_id, CAST(strftime(start_ts, '%Y%m') AS INTEGER) AS best_yearmonth FROM legs",
    "q24": """SELECT o_orderkey, o_orderdate, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS best_yearmonth
FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) >= 200008""",
    "q25": """SELECT o_orderkey, o_totalprice, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS best_yearmonth
FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) < 200008
UNION ALL
SELECT o_orderkey, o_totalprice * 2, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)
FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) > 200008""",
    "q31": _with("legs", "recs", "repeated_legs", extra="""one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY leg_id ORDER BY start_ts) AS rn FROM repeated)
  WHERE rn = 1 AND leg_id IS NOT NULL),
mm AS (
  SELECT o.leg_id, count(r.rec_id) AS n, max(r.rec_id) AS rec_id FROM one o LEFT JOIN recs r
    ON o.key = r.key AND r.rec_ts BETWEEN o.start_ts - INTERVAL 20 MINUTE AND o.end_ts GROUP BY 1)""")
    + """SELECT o.leg_id, o.key, o.start_ts, mm.rec_id, mm.n AS rec_count FROM one o JOIN mm ON o.leg_id = mm.leg_id
UNION ALL SELECT NULL, key, start_ts, NULL, 0 FROM repeated WHERE leg_id IS NULL""",
    "q32": _with("legs", "obs", "repeated_legs", extra="""c AS (
  SELECT l.leg_id, l.key, l.start_ts, o.obs_id,
         row_number() OVER (PARTITION BY l.leg_id ORDER BY o.obs_id IS NULL,
           abs(""" + _secs("l.start_ts") + " - " + _secs("o.obs_ts") + """),
           sign(""" + _secs("l.start_ts") + " - " + _secs("o.obs_ts") + """), o.obs_id, l.start_ts) AS rn
  FROM repeated l LEFT JOIN obs o ON l.key = o.key
   AND o.obs_ts BETWEEN l.start_ts - INTERVAL 25 MINUTE AND l.end_ts + INTERVAL 25 MINUTE)""")
    + "SELECT leg_id, key, start_ts, obs_id FROM c WHERE leg_id IS NULL OR rn = 1",
    "q26": _with("rmd_flights", "rmd_params", extra=_roster(FAMILIES)) + _ROSTER_SELECT,
    "q27": _with("rmd_flights", "rmd_params", extra=_roster(None)) + _ROSTER_SELECT,
}


def _end_to_end(where: str = "", **kw) -> str:
    from .common_flight import OUTPUT_COLUMNS
    from .oracle_e2e import end_to_end_sql
    return end_to_end_sql(OUTPUT_COLUMNS, where, **kw)


SQL["q28"] = SQL["q29"] = _end_to_end()
SQL["q30"] = _end_to_end("CAST(strftime(best_datetime, '%Y%m') AS INTEGER) >= 202406")
SQL["q33"] = _end_to_end(created="""CASE WHEN CAST(strftime(best_datetime, '%Y%m') AS INTEGER) >= 202406
          THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END""")
SQL["q34"] = SQL["q26"]
SQL["q35"] = _with("legs", "wx", extra="""rd AS (
  SELECT airport_str, metar_year_month, split_part(r, '@', 1) AS id,
         TRY_CAST(split_part(r, '@', 2) AS TIMESTAMP) AS rts
  FROM (SELECT airport_str, metar_year_month, unnest(metar_arr) AS r FROM wx)),
""" + _nearest_wx("dep", "dep", "start_ts")) + f"""SELECT l.leg_id,
  CASE WHEN abs({_secs('rd.rts')} - {_secs('l.start_ts')}) <= 1800 THEN a.id END AS metar_id_depart
FROM legs l LEFT JOIN wx_dep a ON l.leg_id = a.leg_id LEFT JOIN rd ON rd.id = a.id"""

_FLAGGED = """flagged AS (
  SELECT n_eng AS no_of_engines, CAST(strftime(start_ts, '%Y%m') AS INTEGER) AS best_yearmonth,
         esn_1, esn_2, esn_3, esn_4 FROM legs),
sets AS (
  SELECT no_of_engines, best_yearmonth,
         CAST(GROUPING(no_of_engines, best_yearmonth) AS BIGINT) AS level, count(*) AS n_rows,
         count(*) - count(esn_1) AS n1, count(*) - count(esn_2) AS n2,
         count(*) - count(esn_3) AS n3, count(*) - count(esn_4) AS n4
  FROM flagged
  GROUP BY GROUPING SETS ((no_of_engines, best_yearmonth), (no_of_engines), (best_yearmonth), ()))"""
SQL["q36"] = _with("all_legs", extra=_FLAGGED) + " UNION ALL ".join(
    f"SELECT 'missing_esn_{k}' AS flag, no_of_engines, best_yearmonth, level, n_rows, n{k} AS n_set FROM sets"
    for k in range(1, 5))

_COMPARED = ["tail", "pos", "start_ts", "dep", "esn_1"]
SQL["q37"] = _with("all_legs", extra="""other AS (
  SELECT leg_id, tail, pos, CASE WHEN leg_id % 11 = 0 THEN start_ts + INTERVAL 1 MINUTE ELSE start_ts END
           AS start_ts, dep, CASE WHEN leg_id % 7 = 0 THEN NULL ELSE esn_1 END AS esn_1
  FROM legs WHERE leg_id % 13 <> 0),
met AS (
  SELECT """ + ", ".join(f"l.{c} IS NOT DISTINCT FROM o.{c} AS e_{c}" for c in _COMPARED) + """
  FROM legs l JOIN other o ON l.leg_id = o.leg_id)""") + """SELECT '(rows)' AS "column", count(*) AS n_equal,
  CAST(NULL AS BIGINT) AS n_differ, (SELECT count(*) FROM legs WHERE leg_id % 13 = 0) AS n_left,
  (SELECT count(*) FROM other WHERE leg_id % 17 = 0) AS n_right FROM met
""" + "".join(f"UNION ALL SELECT '{c}', count(*) FILTER (e_{c}), count(*) FILTER (NOT e_{c}), NULL, NULL FROM met\n"
              for c in _COMPARED)
SQL["q38"] = _with("all_legs") + """SELECT count(*) AS n_rows, count(DISTINCT tail) AS distinct_tails,
  TRUE AS sketch_agrees FROM legs WHERE CAST(strftime(start_ts, '%Y%m') AS INTEGER) >= 202406"""
