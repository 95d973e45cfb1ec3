"""What a finished table holds: flag profiles, mergeable sketches by month, and
the comparison of two builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flag_profile(df: DataFrame, flags: Sequence[str], by: Sequence[str], set_value: str = "t") -> DataFrame:
    """Rows and set flags for every combination of ``by``, for each column of it
    alone, and over all: ``flag``, the columns of ``by`` (NULL where added up),
    ``level`` (the grouping id: 0 is the finest), ``n_rows``, ``n_set``. A NULL
    value of ``by`` is a group of its own, told from a total by ``level``.

    One aggregate over grouping sets counts all flags side by side; they become
    rows of their own afterwards, so nothing is multiplied before the shuffle."""
    names = [f"_f{n}" for n in range(len(flags))]
    sets = [list(by), *([c] for c in by if len(by) > 1), []]
    counts = [F.count_if(F.col(f) == set_value).alias(n) for f, n in zip(flags, names)]
    out = (df.select(*by, *flags).groupingSets([[F.col(c) for c in s] for s in sets], *by)
           .agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("n_rows"), *counts))
    each = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(n).alias("n_set")) for f, n in zip(flags, names)])
    return out.select(*by, "level", "n_rows", F.explode(each).alias("_e")).select(
        "_e.flag", *by, "level", "n_rows", "_e.n_set")


def month_sketches(df: DataFrame, month: str, distinct: Sequence[str], quantiles: Sequence[str],
                   lg_k: int = 14, k: int = 200) -> DataFrame:
    """One row per month: ``n_rows``, a HyperLogLog sketch ``hll_<c>`` of each
    column of ``distinct`` and a KLL sketch ``kll_<c>`` of each numeric column
    of ``quantiles``. Small, and mergeable: a window of months needs no row read
    again. NULLs are in no sketch."""
    return df.groupBy(month).agg(
        F.count("*").alias("n_rows"),
        *[F.hll_sketch_agg(F.col(c), F.lit(lg_k)).alias(f"hll_{c}") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"kll_{c}") for c in quantiles])


def merged_sketches(sketches: DataFrame, month: str, since: int | None = None,
                    ranks: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """What the months from ``since`` on hold together, from their sketches
    alone: ``n_rows``, ``distinct_<c>`` and ``quantiles_<c>`` (at ``ranks``)."""
    held = sketches if since is None else sketches.where(F.col(month) >= since)
    of = [c[4:] for c in sketches.columns if c.startswith("hll_")]
    at = [c[4:] for c in sketches.columns if c.startswith("kll_")]
    merged = held.agg(F.sum("n_rows").alias("n_rows"),
                      *[F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in of],
                      *[F.kll_merge_agg_double(f"kll_{c}").alias(f"kll_{c}") for c in at])
    points = F.array(*[F.lit(float(x)) for x in ranks])
    return merged.select("n_rows", *[F.hll_sketch_estimate(f"hll_{c}").alias(f"distinct_{c}") for c in of],
                         *[F.kll_sketch_get_quantile_double(f"kll_{c}", points).alias(f"quantiles_{c}")
                           for c in at])


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str],
              columns: Sequence[str] | None = None) -> DataFrame:
    """How two builds of one table differ: a row per column with ``n_equal``,
    ``n_differ`` (NULL and a value differ, two NULLs do not), and under the name
    ``(rows)`` the rows that both have, that only the left and that only the
    right has (``n_equal``, ``n_left``, ``n_right``).

    Rows that are equal in all columns cancel out first, in one aggregate over
    both sides that is combined before the shuffle. What is left of a key is
    paired in the order of a hash. The counts are aggregates; no row is
    collected."""
    columns = [c for c in (columns or left.columns) if c not in keys]
    sides = left.select(*keys, *columns, F.lit(1).alias("_side")).unionByName(
        right.select(*keys, *columns, F.lit(-1).alias("_side")))
    held = sides.groupBy(*keys, *columns).agg(F.count_if(F.col("_side") == 1).alias("_l"),
                                              F.count_if(F.col("_side") == -1).alias("_r"))
    rest = held.where("_l <> _r").select(
        *[F.col(c).alias(f"_k{n}") for n, c in enumerate(keys)], F.struct(*columns).alias("row"),
        (F.col("_l") > F.col("_r")).alias("first"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.abs(F.col("_l") - F.col("_r")))))
    ks = [f"_k{n}" for n in range(len(keys))]
    order = Window.partitionBy(*ks, "first").orderBy(F.xxhash64("row"))
    pairs = (rest.withColumn("n", F.row_number().over(order)).groupBy(*ks, "n").agg(
        F.first(F.when(F.col("first"), F.col("row")), ignorenulls=True).alias("a"),
        F.first(F.when(~F.col("first"), F.col("row")), ignorenulls=True).alias("b")))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    names = [f"_e{n}" for n in range(len(columns))]
    differ = pairs.agg(
        F.count_if(both).alias("both"), F.count_if(F.col("b").isNull()).alias("left"),
        F.count_if(F.col("a").isNull()).alias("right"),
        *[F.count_if(both & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(e)
          for e, c in zip(names, columns)])
    same = F.coalesce(F.sum(F.least("_l", "_r")), F.lit(0))
    equal = held.agg(same.alias("both"), F.lit(0).cast("long").alias("left"),
                     F.lit(0).cast("long").alias("right"), *[same.alias(e) for e in names])
    total = equal.unionByName(differ).agg(*[F.sum(c).alias(c) for c in ("both", "left", "right", *names)])
    none = F.lit(None).cast("long")

    def line(name: str, *counts: Column):
        return F.struct(F.lit(name).alias("column"), *[c.alias(k) for k, c in zip(
            ("n_equal", "n_differ", "n_left", "n_right"), counts)])

    lines = [line("(rows)", F.col("both"), none, F.col("left"), F.col("right")),
             *[line(c, F.col(e), F.col("both") - F.col(e), none, none) for e, c in zip(names, columns)]]
    return total.select(F.explode(F.array(*lines)).alias("x")).select("x.*")
