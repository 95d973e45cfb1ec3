"""Labels and quality flags ('t' / 'f' strings, kept for output parity)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timecols import col_of

# Engine position labels by engine count (count -> labels for
# positions 1, 2, ...).
POSITION_LABELS = {
    2: ["LI", "RI"],
    3: ["LI", "C", "RI"],
    4: ["LO", "LI", "RI", "RO"],
}

# missing/invalid flag name -> column that must not be NULL.
MISSING_FLAGS = {
    "missing_aircraft_type": "aircraft_type",
    "missing_engine_type": "engine_type",
    "missing_engine_family": "engine_family",
    "invalid_airport_depart_cd": "best_depart_icao",
    "invalid_airport_dest_cd": "best_arrival_icao",
    "missing_flight_key_no": "flight_key_no",
    "missing_tail_number": "tail_number",
    "missing_engine_serial_number": "engine_serial_number",
    "missing_installation_date": "installation_date",
    "missing_removal_date": "removal_date",
    "missing_customer_icao_code": "customer_icao_code",
    "missing_engine_family_cd": "engine_family_mdm",
    "missing_engine_model_cd": "engine_model_mdm",
    "missing_engine_series_cd": "engine_series_mdm",
    "missing_aircraft_family": "aircraft_family",
}


def tf(cond: Column) -> Column:
    """'t' when ``cond`` is true, else 'f' (NULL counts as false)."""
    return F.when(cond, F.lit("t")).otherwise(F.lit("f"))


def present_flag(c: Column | str) -> Column:
    if isinstance(c, str):
        return F.expr(f"CASE WHEN {_sql(c)} IS NOT NULL THEN 't' ELSE 'f' END")
    return tf(c.isNotNull())


def missing_flag(c: Column | str) -> Column:
    if isinstance(c, str):
        return F.expr(f"CASE WHEN {_sql(c)} IS NULL THEN 't' ELSE 'f' END")
    return tf(c.isNull())


def quality_flags(df: DataFrame, flags: Mapping[str, str] = MISSING_FLAGS) -> DataFrame:
    """Adds one 't'/'f' column per entry: 't' when the watched column is NULL."""
    return df.withColumns({name: missing_flag(src) for name, src in flags.items()})


def position_label(position: Column | str, engines: Column | str) -> Column:
    """LI/RI, LI/C/RI or LO/LI/RI/RO by engine count; NULL otherwise.
    Non-numeric input gives NULL (``try_cast``)."""
    if isinstance(position, str) and isinstance(engines, str):
        pos, n = f"try_cast({_sql(position)} AS INT)", f"try_cast({_sql(engines)} AS INT)"
        outer = []
        for count, labels in POSITION_LABELS.items():
            inner = " ".join(f"WHEN {pos} = {i} THEN '{label}'"
                             for i, label in enumerate(labels, start=1))
            outer.append(f"WHEN {n} = {count} THEN (CASE {inner} END)")
        return F.expr(f"CASE {' '.join(outer)} END")
    pos = F.expr(f"try_cast({_sql(position)} AS INT)") if isinstance(position, str) else position
    n = F.expr(f"try_cast({_sql(engines)} AS INT)") if isinstance(engines, str) else engines
    out = None
    for count, labels in POSITION_LABELS.items():
        inner = None
        for i, label in enumerate(labels, start=1):
            inner = F.when(pos == i, label) if inner is None else inner.when(pos == i, label)
        out = F.when(n == count, inner) if out is None else out.when(n == count, inner)
    return out


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
