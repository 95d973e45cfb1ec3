"""Scalar key builders: canonical ids, composite ids, report keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecols import col_of, epoch_seconds


def normalize_id(c: Column | str) -> Column:
    """Upper-case, trimmed, alphanumerics only. NULL stays NULL; a value made
    only of punctuation becomes the empty string."""
    return F.upper(F.regexp_replace(F.trim(col_of(c)), "[^a-zA-Z0-9]", ""))


def composite_id(flight_id: Column | str, esn: Column | str) -> Column:
    """``<flight id>-<esn>`` with ``0`` / ``xxx`` standing in for NULLs."""
    return F.concat_ws(
        "-",
        F.coalesce(col_of(flight_id).cast("string"), F.lit("0")),
        F.coalesce(col_of(esn).cast("string"), F.lit("xxx")),
    )


def engine_fit_string(esn: Column | str, installed: Column | str) -> Column:
    """``<esn>_<install day yyyyMMdd>``; NULL parts are skipped."""
    return F.concat_ws("_", col_of(esn), F.date_format(col_of(installed), "yyyyMMdd"))


def report_nkey(icao: Column | str, esn: Column | str, position: Column | str,
                installed: Column | str) -> Column:
    """Report-parameter key: icao (or 'z') + ESN (or 'x') + position (or 'y')
    + install epoch seconds (or -2), concatenated without separator."""
    return F.concat(
        F.coalesce(col_of(icao).cast("string"), F.lit("z")),
        F.coalesce(col_of(esn).cast("string"), F.lit("x")),
        F.coalesce(col_of(position).cast("string"), F.lit("y")),
        F.coalesce(epoch_seconds(installed), F.lit(-2)).cast("string"),
    )
