"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from .geo import EARTH_RADIUS_MILES, great_circle_distance
from .keys import composite_id, engine_fit_string, normalize_id, report_nkey
from .labels import (MISSING_FLAGS, POSITION_LABELS, missing_flag, position_label,
                     present_flag, quality_flags, tf)
from .timecols import epoch_seconds, month_key, month_key_int, shift

__all__ = [
    "EARTH_RADIUS_MILES", "MISSING_FLAGS", "POSITION_LABELS", "composite_id",
    "engine_fit_string", "epoch_seconds", "great_circle_distance",
    "missing_flag", "month_key", "month_key_int", "normalize_id", "position_label",
    "present_flag", "quality_flags", "report_nkey", "shift", "tf",
]
