"""DataFrame -> DataFrame operators of the stitching job."""

from .asof import asof_lookup
from .distance import airport_pair_distances, attach_distance
from .history import prior_events_max
from .lookup import dated_lookup, timeline_lookup
from .match import (append_unmatched, interval_match, nearest_match, one_per_id,
                    unmatched_records)
from .observe import (nearest_observation, nearest_observation_table, nearest_observations,
                      observation_gaps)
from .quality import flag_profile, merged_sketches, month_sketches, reconcile
from .ranges import binned_range_join, interval_bins, measure
from .reports import (REPORT_TYPES, attach_reports, message_roster, roster_flights,
                      roster_params)
from .resolve import best_of, best_value, provenance
from .siblings import assign_slots, group_siblings, mark_parents, previous_values, slot_ids

__all__ = [
    "REPORT_TYPES", "airport_pair_distances", "append_unmatched", "asof_lookup", "assign_slots",
    "attach_distance", "attach_reports", "best_of", "best_value", "binned_range_join",
    "dated_lookup", "flag_profile", "group_siblings", "interval_bins", "interval_match", "mark_parents", "measure",
    "merged_sketches", "message_roster", "month_sketches", "nearest_match", "nearest_observation",
    "nearest_observation_table", "nearest_observations",
    "observation_gaps", "one_per_id",
    "previous_values", "prior_events_max", "provenance", "reconcile", "roster_flights", "roster_params",
    "slot_ids", "timeline_lookup", "unmatched_records",
]
