"""Dated look-up with undated fallback, and point-in-time timeline look-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import BUCKET_SECONDS, asof_lookup
from .ranges import _pairs, left_join


def dated_lookup(legs: DataFrame, dated: DataFrame, undated: DataFrame, *, code: str,
                 day: str, ids: Mapping[str, str], hit: str, dated_code: str = "icao_code",
                 dated_day: str = "nrl_date_year", undated_code: str = "icao_code",
                 code_len: int | None = 4) -> DataFrame:
    """Adds the ``ids`` columns (``out_name: source_col``) from the dated
    table (code equal, day equal, and ``length(code) == code_len``); legs
    whose dated ``hit`` column came back NULL fill each id from the undated
    table (code equal, no length test), a non-NULL dated id still winning.

    Same rows as the split / union form: a dated hit keeps its own NULL ids
    and never fans out on the fallback; a miss fans out on duplicate fallback
    rows exactly as a left join would.
    """
    if hit not in ids.values():
        raise ValueError("hit must be one of the id source columns")
    d_sel = [F.col(dated_code).alias("_d_code"), F.col(dated_day).alias("_d_day")]
    d_sel += [F.col(src).alias(f"_d_{n}") for n, src in enumerate(ids.values())]
    d = dated.select(*d_sel)
    u_sel = [F.col(undated_code).alias("_u_code")]
    u_sel += [F.col(src).alias(f"_u_{n}") for n, src in enumerate(ids.values())]
    u = undated.select(*u_sel)
    hit_n = list(ids.values()).index(hit)
    extra = [F.length(F.col(code)) == code_len] if code_len is not None else []
    step = left_join(legs, d, [(code, "_d_code"), (day, "_d_day")], extra) \
        .drop("_d_code", "_d_day")
    step = left_join(step, u, [(code, "_u_code")], [F.col(f"_d_{hit_n}").isNull()])
    outs = {}
    for n, out in enumerate(ids):
        outs[out] = F.when(F.col(f"_d_{hit_n}").isNotNull(), F.col(f"_d_{n}")) \
                     .otherwise(F.coalesce(F.col(f"_d_{n}"), F.col(f"_u_{n}")))
    helpers = [f"_d_{n}" for n in range(len(ids))] + [f"_u_{n}" for n in range(len(ids))]
    return step.withColumns(outs).drop("_u_code", *helpers)


def timeline_lookup(legs: DataFrame, timeline: DataFrame, *,
                    keys: Sequence[str | tuple[str, str]], at: str, begin: str, end: str,
                    cols: Mapping[str, str], coalesce_into: Mapping[str, str] | None = None,
                    bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Point-in-time (SCD-2) look-up: ``legs`` left join ``timeline`` on equal
    keys and ``begin <= at <= end`` (closed both ends; overlapping timeline
    rows fan out, a NULL ``at`` matches nothing).

    ``cols`` maps output name -> timeline column. ``coalesce_into`` maps an
    existing leg column -> output name: the leg value wins, the timeline
    value fills its NULLs, and the output column is dropped afterwards.
    """
    pairs = _pairs(keys)
    ks = [f"_t_k{n}" for n in range(len(pairs))]
    tl = timeline.select(*[F.col(b).alias(k) for k, (_, b) in zip(ks, pairs)],
                         F.col(begin).alias("_t_lo"), F.col(end).alias("_t_hi"),
                         *[F.col(src).alias(out) for out, src in cols.items()])
    # a match depends on the keys and the time alone: distinct ones are looked up
    points = legs.select(*[F.col(a).alias(k) for k, (a, _) in zip(ks, pairs)], F.col(at).alias("_t_at"),
                         F.col(at).alias("_t_own"))
    found = asof_lookup(points.dropna().distinct(), tl, ks, "_t_at", "_t_lo", "_t_hi", bucket_seconds)
    joined = left_join(legs, found.drop("_t_at", "_t_lo", "_t_hi"),
                       [*[(a, k) for k, (a, _) in zip(ks, pairs)], (at, "_t_own")]).drop("_t_own", *ks)
    if coalesce_into:
        joined = joined.withColumns({leg_col: F.coalesce(F.col(leg_col), F.col(out))
                                     for leg_col, out in coalesce_into.items()})
        joined = joined.drop(*set(coalesce_into.values()))
    return joined
