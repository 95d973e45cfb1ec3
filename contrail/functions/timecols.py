"""Time helpers that stay inside Spark's codegen.

Columns that are compared or binned together are first brought to one type
(``in_one_type``): bins and comparisons then always see the same value. With
``TIMESTAMP_NTZ`` or ``DATE`` columns alone nothing depends on the session time
zone; where a zoned ``TIMESTAMP`` takes part, the others are read in that zone,
as Spark's own comparison does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_type_of(df, col: str) -> str:
    """SQL name of a timestamp column's type: 'timestamp_ntz' or 'timestamp'."""
    return "timestamp_ntz" if df.schema[col].dataType.typeName() == "timestamp_ntz" \
        else "timestamp"


_TIMES = ("date", "timestamp_ntz", "timestamp")


def common_time_type(*types) -> str:
    """The type in which Spark compares time columns of these types; anything
    but DATE, TIMESTAMP_NTZ and TIMESTAMP is refused."""
    names = {t.typeName() for t in types}
    if not names <= set(_TIMES):
        raise TypeError(f"not a time column: {', '.join(sorted(names - set(_TIMES)))}")
    return "timestamp" if "timestamp" in names else "timestamp_ntz"


def in_one_type(*frames_and_columns: tuple) -> list:
    """``(frame, [columns])`` pairs -> the frames with these time columns cast
    to their common type."""
    kind = common_time_type(*[df.schema[c].dataType for df, cols in frames_and_columns
                              for c in cols])
    return [df.withColumns({c: F.col(c).cast(kind) for c in cols
                            if df.schema[c].dataType.typeName() != kind} or {})
            if any(df.schema[c].dataType.typeName() != kind for c in cols) else df
            for df, cols in frames_and_columns]


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch (the unit the nearest-match rules use)."""
    return F.unix_timestamp(col_of(ts))


def shift(ts: Column | str, interval: str) -> Column:
    """``ts + INTERVAL <interval>``; ``interval`` like ``'-20 minutes'``."""
    text = interval.strip()
    if text.startswith("-"):
        return col_of(ts) - F.expr(f"INTERVAL {text[1:].strip()}")
    return col_of(ts) + F.expr(f"INTERVAL {text}")


def month_key(ts: Column | str) -> Column:
    """Calendar month ``yyyyMM`` as a string (the week-year pattern of the
    original job is wrong around New Year and is not reproduced)."""
    return F.date_format(col_of(ts), "yyyyMM")


def month_key_int(ts: Column | str) -> Column:
    return month_key(ts).cast("int")
