"""contrail: flight-record stitching on Spark DataFrames.

Links records about the same flight and engine from independent sources into
one best row per (flight, engine): interval and nearest-in-time matching,
unmatched-record retention, best value with provenance, nearest weather
reading, great-circle distance, dated look-ups with fallback, point-in-time
master data, sibling grouping, history counters, quality flags and
month-partitioned output.
"""

__version__ = "0.1.0"

from .plans.common_flight import (ENGINE_FAMILIES, OUTPUT_COLUMNS, build_common_flight,  # noqa: E402
                                  build_trailing, publish_full, publish_trailing)
from .plans.report_staging import build_roster, publish_roster  # noqa: E402

__all__ = ["ENGINE_FAMILIES", "OUTPUT_COLUMNS", "build_common_flight", "build_roster",
           "build_trailing", "publish_full", "publish_roster", "publish_trailing"]
