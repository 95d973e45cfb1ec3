"""The report-message staging job: every family's report flights joined to
their report parameters, unioned, written as one unpartitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .. import operators as op
from ..sources import sink


def build_roster(sources: Sequence[tuple[str, DataFrame, DataFrame]],
                 report_types: Sequence[str] = op.REPORT_TYPES) -> DataFrame:
    """``sources``: ``(family, report flights, report parameters)`` per family."""
    return op.message_roster(sources, report_types)


def publish_roster(roster: DataFrame, path: str, table: str | None = None) -> None:
    """Overwrite the staging table at ``path`` and (re)register it."""
    sink.write_unpartitioned(roster, path)
    if table:
        sink.register_table(roster.sparkSession, table, path, roster, None)
