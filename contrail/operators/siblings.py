"""Sibling grouping on one aircraft: parent/child marking, grouping of the
children under the parent interval they start in, sibling id arrays and the
assignment of those ids to engine slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.timecols import epoch_seconds
from ..session import cut_lineage
from .ranges import binned_range_join, left_join

# Default bucket for the per-aircraft previous-row look-up (1 day).
LAG_BUCKET_SECONDS = 24 * 3600
_MIN_LONG = -(2**63)


def previous_values(df: DataFrame, *, partition: Sequence[str], order: Sequence[str],
                    time_col: str, values: dict[str, str],
                    bucket_seconds: int = LAG_BUCKET_SECONDS,
                    time_in_seconds: bool = False) -> DataFrame:
    """Adds ``out = lag(src)`` for each ``out: src`` in ``values``, over
    ``partition`` ordered by ``order`` (ascending, NULLs first) whose first
    element is ``time_col`` (a timestamp, or epoch seconds when
    ``time_in_seconds``).

    Same result as one ``lag`` window, but the window runs per (partition,
    time bucket): one busy aircraft no longer lands in a single task. The
    first row of each bucket takes its previous row from the last row of the
    nearest earlier non-empty bucket (a small per-bucket table).
    """
    if order[0] != time_col:
        raise ValueError("order must start with time_col")
    secs = F.col(time_col) if time_in_seconds else epoch_seconds(time_col)
    bk = F.coalesce(F.floor(secs / F.lit(bucket_seconds)).cast("long"), F.lit(_MIN_LONG))
    d = df.withColumn("_cr_bk", bk)
    w = Window.partitionBy(*partition, "_cr_bk").orderBy(*order)
    d = d.withColumns({"_cr_rn": F.row_number().over(w),
                       **{out: F.lag(src).over(w) for out, src in values.items()}})
    ordkey = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(src).alias(out) for out, src in values.items()])
    last = (d.groupBy(*partition, "_cr_bk").agg(F.max_by(payload, ordkey).alias("_cr_last")))
    wb = Window.partitionBy(*partition).orderBy("_cr_bk")
    pk = [f"_cr_pk{n}" for n in range(len(partition))]
    carry = last.select(*[F.col(c).alias(a) for c, a in zip(partition, pk)],
                        F.col("_cr_bk").alias("_cr_cbk"),
                        F.lag("_cr_last").over(wb).alias("_cr_prev"))
    cond = [F.col(c).eqNullSafe(F.col(a)) for c, a in zip(partition, pk)]
    cond.append(F.col("_cr_bk") == F.col("_cr_cbk"))
    out = d.join(carry, on=cond, how="left")
    first = F.col("_cr_rn") == 1
    out = out.withColumns({o: F.when(first, F.col(f"_cr_prev.{o}")).otherwise(F.col(o))
                           for o in values})
    return out.drop("_cr_bk", "_cr_rn", "_cr_cbk", "_cr_prev", *pk)


def mark_parents(df: DataFrame, *, tail: str, at: str, start: str, end: str,
                 order: Sequence[str], out: str = "is_parent",
                 bucket_seconds: int = LAG_BUCKET_SECONDS) -> DataFrame:
    """``out`` is False ("child") when the row's ``at`` lies within the
    previous row's [start, end] (its ``at`` standing in for a missing end) or
    equals the previous ``at``; True otherwise, including the first row of a
    tail and rows with NULL times. Rows are ordered per ``tail`` by
    ``order`` (which must start with ``at``).

    A row without a tail is on no known aircraft and has no previous row: it is
    a parent. Rows without tail or time never enter the window (nor could they
    be another row's previous one: a NULL time makes no child)."""
    placed = F.col(tail).isNotNull() & F.col(at).isNotNull()
    d = previous_values(df.where(placed), partition=[tail], order=order, time_col=at,
                        values={"_cr_pat": at, "_cr_pst": start, "_cr_pen": end},
                        bucket_seconds=bucket_seconds)
    a = F.col(at)
    child = (a.between(F.coalesce("_cr_pst", "_cr_pat"), F.coalesce("_cr_pen", "_cr_pat"))
             | (a == F.col("_cr_pat")))
    marked = d.withColumn(out, ~F.coalesce(child, F.lit(False))).drop("_cr_pat", "_cr_pst",
                                                                       "_cr_pen")
    return marked.unionByName(df.where(~placed).withColumn(out, F.lit(True)))


def group_siblings(marked: DataFrame, *, tail: str, at: str, start: str, end: str,
                   id_col: str, order: Sequence[str], is_parent: str = "is_parent",
                   parent_key: str = "parent_datetime", ids_out: str = "sibling_ids",
                   include_parents: bool = True,
                   bin_seconds: int | None = None) -> DataFrame:
    """Attach every child to the parent interval of its aircraft that its
    ``start`` falls in (closed; a child in two parents appears twice, a child
    in none gets a NULL key), key the parents by their own ``at``, and add
    ``ids_out`` = ids of the group ordered by ``order`` (NULL ids skipped;
    NULL key -> NULL array).

    ``include_parents=False`` keeps only the child rows (the literal result
    of the original job, which rebuilt its parent set from the children).
    The union is a set union (duplicate rows collapse), as in the original.

    The marked rows are read for the parents and for the children; they are
    written to a stage table first, so that the marking runs once.
    """
    marked = cut_lineage(marked, "marked")
    parents = marked.filter(F.col(is_parent))
    children = marked.filter(~F.col(is_parent))
    piv = parents.select(F.col(tail).alias("_cr_ptail"), F.col(start).alias("_cr_plo"),
                         F.col(end).alias("_cr_phi"), F.col(at).alias(parent_key))
    kids = binned_range_join(children, piv, [(tail, "_cr_ptail")], start, "_cr_plo", "_cr_phi",
                             bin_seconds, how="left").drop("_cr_ptail", "_cr_plo", "_cr_phi")
    # a parent key needs both parts, as the concatenated key of the original
    kids = kids.withColumn(parent_key, F.when(F.col(tail).isNotNull(), F.col(parent_key)))
    if include_parents:
        own = parents.withColumn(parent_key, F.when(F.col(tail).isNotNull(), F.col(at)))
        rows = own.unionByName(kids)
    else:
        rows = kids
    rows = rows.distinct()
    # one aggregate per group, joined back: no row carries its group's list
    # through a window, and rows without a key are not gathered at all
    srt = F.struct(*[F.col(c) for c in order], F.col(id_col).alias("_cr_id"))
    groups = (rows.where(F.col(parent_key).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(tail).alias("_cr_gt"), F.col(parent_key).alias("_cr_gk"))
              .agg(F.array_sort(F.collect_list(srt)).alias("_cr_ids")))
    out = left_join(rows, groups, [(tail, "_cr_gt"), (parent_key, "_cr_gk")])
    ids = F.coalesce(F.transform("_cr_ids", lambda x: x["_cr_id"]),
                     F.array().cast(ArrayType(rows.schema[id_col].dataType)))
    return (out.withColumn(ids_out, F.when(F.col(parent_key).isNotNull(), ids))
            .drop("_cr_gt", "_cr_gk", "_cr_ids"))


def slot_ids(esns: Sequence[Column | str], ids: Column | str, literal: bool = False,
             missing: str = "no_def_id") -> list[Column]:
    """Engine-slot ids for slots 1..n: a slot with a NULL ESN gets
    ``missing``; otherwise the id at position (number of non-NULL ESNs in
    slots 1..k) of ``ids`` (NULL past the end).

    ``literal=True`` reproduces the original CASE table's one gap: slot 4 with
    slots 1-3 all NULL yields NULL instead of the first id.
    """
    e = [F.col(c) if isinstance(c, str) else c for c in esns]
    arr = F.col(ids) if isinstance(ids, str) else ids
    out = []
    for k in range(len(e)):
        cnt = sum((F.when(e[j].isNotNull(), 1).otherwise(0) for j in range(k + 1)), F.lit(0))
        val = F.get(arr, cnt - 1).cast("string")
        if literal and k == 3:
            val = F.when(e[0].isNull() & e[1].isNull() & e[2].isNull(),
                         F.lit(None).cast("string")).otherwise(val)
        out.append(F.when(e[k].isNull(), F.lit(missing)).otherwise(val))
    return out


def assign_slots(df: DataFrame, *, esns: Sequence[str], ids: str,
                 prefix: str = "phm_def_id_eng_pos_", joined: str | None = "phm_def_id_eng_pos_array",
                 literal: bool = False) -> DataFrame:
    """Adds ``<prefix>1..n`` slot ids and, if ``joined`` is given, their
    comma-joined string (NULL slots skipped)."""
    cols = slot_ids(esns, ids, literal=literal)
    names = [f"{prefix}{k + 1}" for k in range(len(cols))]
    out = df.withColumns(dict(zip(names, cols)))
    if joined:
        out = out.withColumn(joined, F.concat_ws(",", *names))
    return out
