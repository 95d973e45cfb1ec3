"""Best-value selection with provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import col_of


def best_value(sources: Sequence[Column | str]) -> Column:
    return F.coalesce(*[col_of(c) for c in sources])


def provenance(sources: Sequence[tuple[str, Column | str]],
               ambiguous: Column | None = None) -> Column:
    """Label of the first non-NULL source; NULL when ``ambiguous`` holds or
    no source has a value."""
    out = F.when(ambiguous, F.lit(None).cast("string")) if ambiguous is not None else None
    for label, c in sources:
        cond = col_of(c).isNotNull()
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def best_of(df: DataFrame, out: str, sources: Sequence[tuple[str, Column | str]],
            src_out: str | None = None, ambiguous: Column | None = None) -> DataFrame:
    """Adds ``out`` = first non-NULL source value and, if ``src_out`` is
    given, the label of the source it came from (NULL when ``ambiguous``)."""
    cols = {out: best_value([c for _, c in sources])}
    if src_out:
        cols[src_out] = provenance(sources, ambiguous)
    return df.withColumns(cols)
