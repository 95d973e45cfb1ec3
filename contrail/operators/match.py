"""Record matching: interval match, unmatched-record retention, nearest match.

All three keep the left frame whole: rows without a partner stay, with NULL
partner columns. Ties are broken by explicit keys so results do not depend on
shuffle order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import common_time_type, epoch_seconds, in_one_type, shift
from ..session import cut_lineage
from .ranges import _pairs, binned_range_join, left_join, measure, null_salt

_LO, _HI, _AT, _PT = "_cr_lo", "_cr_hi", "_cr_at", "_cr_pt"

_SALT = "_cr_one"


def one_per_id(df: DataFrame, id_col: str, order: Sequence[str],
               salt: str | None = None) -> DataFrame:
    """One row of every non-NULL id: the first by ``order`` (NULLs last), ties
    by a hash of the whole row, so that the choice does not depend on the
    plan. Rows with a NULL id all stay. The rows come out dealt by the id and a
    salt (0, and a hash of the row where the id is NULL); as the column ``salt``
    it lets a join on both find them in place."""
    spread = df.withColumns({_SALT: null_salt(df, [id_col]), "_cr_hash": F.expr("xxhash64(*)")})
    w = Window.partitionBy(id_col, _SALT).orderBy(
        *[F.col(c).asc_nulls_last() for c in order], "_cr_hash")
    out = (spread.withColumn("_cr_rn", F.row_number().over(w))
           .where(F.col(id_col).isNull() | (F.col("_cr_rn") == 1)).drop("_cr_hash", "_cr_rn"))
    return out.withColumnRenamed(_SALT, salt) if salt else out.drop(_SALT)


def interval_match(legs: DataFrame, recs: DataFrame, *, leg_id: str,
                   keys: Sequence[str | tuple[str, str]], start: str, end: str,
                   rec_ts: str, rec_id: str, before: str = "20 minutes",
                   chosen: str = "rec_id", ids_out: str = "rec_ids",
                   count_out: str | None = "rec_count",
                   maxima: Mapping[str, str] | None = None,
                   bin_seconds: int | None = None) -> DataFrame:
    """Attach to every leg the records whose ``rec_ts`` lies in
    ``[start - before, end]`` with equal keys (keys are ``(leg_col, rec_col)``
    pairs or shared names).

    Adds ``chosen`` = largest matched record id, ``ids_out`` = sorted array of
    all matched ids (empty when none), ``count_out`` = its size, and for each
    ``out: rec_col`` in ``maxima`` the largest value of ``rec_col`` over the
    matches. Legs of one id become one row (the earliest, see ``one_per_id``);
    legs with a NULL id stay as they are and get no matches.

    Plan: only the partner side is aggregated (one partial + final hash
    aggregate on the leg id), and joined back to the legs where the choice of
    one row for each id has put them: the legs are shuffled once.
    """
    maxima = dict(maxima or {})
    pairs = _pairs(keys)
    ends = legs.select(shift(start, f"-{before}").alias(_LO), F.col(end).alias(_HI))
    ranges = measure(*in_one_type((recs, [rec_ts]), (ends, [_LO, _HI])), rec_ts, _LO, _HI, bin_seconds)
    legs = one_per_id(legs, leg_id, [start, end], salt="_cr_salt")
    # interval side: the legs, narrowed to what the join needs
    iv = legs.where(F.col(leg_id).isNotNull()).select(
                     F.col(leg_id).alias("_cr_leg"), F.col("_cr_salt").alias("_cr_lsalt"),
                     *[F.col(a).alias(f"_cr_k{n}") for n, (a, _) in enumerate(pairs)],
                     shift(start, f"-{before}").alias(_LO), F.col(end).alias(_HI))
    rec_cols = {rec_id, *maxima.values()}
    pts = recs.select(*[F.col(b).alias(f"_cr_k{n}") for n, (_, b) in enumerate(pairs)],
                      F.col(rec_ts).alias(_PT), *[F.col(c) for c in sorted(rec_cols)])
    matched = binned_range_join(pts, iv, [f"_cr_k{n}" for n in range(len(pairs))],
                                _PT, _LO, _HI, ranges=ranges)
    id_type = recs.schema[rec_id].dataType
    agg = (matched.groupBy("_cr_leg", "_cr_lsalt")
           .agg(F.max(rec_id).alias(chosen),
                *[F.max(c).alias(o) for o, c in maxima.items()],
                F.array_sort(F.collect_list(rec_id)).alias(ids_out))
           )
    out = legs.join(agg, (F.col(leg_id) == F.col("_cr_leg")) & (F.col("_cr_salt") == F.col("_cr_lsalt")),
                    "left").drop("_cr_leg", "_cr_salt", "_cr_lsalt")
    out = out.withColumn(ids_out, F.coalesce(F.col(ids_out),
                                             F.array().cast(T.ArrayType(id_type))))
    if count_out:
        out = out.withColumn(count_out, F.size(ids_out))
    return out


def unmatched_records(recs: DataFrame, matched: DataFrame, *, rec_keys: Sequence[str],
                      ids_col: str, matched_keys: Sequence[str] = ()) -> DataFrame:
    """Distinct ``rec_keys`` rows of ``recs`` that no leg matched.

    ``rec_keys[0]`` is the record id; it is compared with every element of
    ``matched[ids_col]``; ``rec_keys[1:]`` are compared with ``matched_keys``.
    Set difference with NULLs equal (EXCEPT DISTINCT), planned by Catalyst as a
    null-safe anti join.
    """
    if len(matched_keys) != len(rec_keys) - 1:
        raise ValueError("matched_keys must pair with rec_keys[1:]")
    seen = matched.select(F.explode(ids_col).alias(rec_keys[0]),
                          *[F.col(m).alias(r) for m, r in zip(matched_keys, rec_keys[1:])])
    return recs.select(*rec_keys).subtract(seen)


def append_unmatched(matched: DataFrame, unmatched: DataFrame, *, rec_id: str,
                     chosen: str, ids_col: str, rename: Mapping[str, str] | None = None,
                     count_col: str | None = None) -> DataFrame:
    """Union the unmatched records onto the matched legs as rows of their own:
    leg columns NULL, ``chosen`` = the record id, ``ids_col`` = one-element
    array. ``rename`` maps further record columns onto matched-frame names."""
    rename = dict(rename or {})
    rows = unmatched.select(F.col(rec_id).alias(chosen),
                            *[F.col(k).alias(v) for k, v in rename.items()],
                            F.array(F.col(rec_id)).alias(ids_col))
    if count_col:
        rows = rows.withColumn(count_col, F.lit(1))
    return matched.unionByName(rows, allowMissingColumns=True)


def nearest_match(left: DataFrame, obs: DataFrame, *, row_key: Sequence[str], id_col: str,
                  keys: Sequence[str | tuple[str, str]], lo: str, hi: str, at: str,
                  obs_ts: str, tiebreak: str, obs_cols: Sequence[str],
                  bin_seconds: int | None = None, unkeyed_once: bool = False) -> DataFrame:
    """For each left row, the observation (equal keys, ``obs_ts`` in
    ``[lo, hi]``) nearest to ``at``.

    Order: whole-second distance, then the sign of ``at - obs_ts`` (the later
    observation wins a tie), then ``tiebreak`` ascending. Rows whose
    ``id_col`` is NULL keep *every* candidate (one row each). Rows without
    candidates stay with NULL ``obs_cols``.

    Rows that share an id become one row: of all their candidates the best is
    chosen, together with the row that it belongs to (``row_key`` breaks ties,
    NULLs last); without candidates the first row by ``row_key`` stays. With
    ``unkeyed_once`` rows without an id that are equal in all columns are one row.

    Plan: the windows' candidates are found once and written to a stage table;
    the best of each id comes from a narrow frame, and the rows themselves are
    shuffled once, by their id.
    """
    pairs = _pairs(keys)
    ks = [f"_cr_k{n}" for n in range(len(pairs))]
    carried = list(dict.fromkeys([tiebreak, *obs_cols]))
    pts = obs.select(*[F.col(b).alias(k) for k, (_, b) in zip(ks, pairs)],
                     F.col(obs_ts).alias(_PT), *[F.col(c) for c in carried])
    # what can match depends on keys and window alone: resolve these once
    ends = {_LO: lo, _HI: hi}
    window = left.select(*[F.col(a).alias(k) for k, (a, _) in zip(ks, pairs)],
                         *[F.col(c).alias(a) for a, c in ends.items()]).dropna().distinct()
    window = window.withColumns({"_cr_lo0": F.col(_LO), "_cr_hi0": F.col(_HI)})
    ranges = measure(*in_one_type((pts, [_PT]), (left, [lo, hi])), _PT, lo, hi, bin_seconds)
    cand = binned_range_join(pts, window, ks, _PT, _LO, _HI, ranges=ranges).drop(_LO, _HI)
    back = [*[(a, f"_cr_b{n}") for n, (a, _) in enumerate(pairs)], (lo, "_cr_lo0"), (hi, "_cr_hi0")]
    # read for the rows with an id and for those without, other columns each time
    cand = cut_lineage(cand.withColumnsRenamed({k: f"_cr_b{n}" for n, k in enumerate(ks)}), "candidates")
    extra = [b for _, b in back]

    unkeyed = left.where(F.col(id_col).isNull())
    if unkeyed_once:
        unkeyed = unkeyed.distinct()
    unkeyed = left_join(unkeyed, cand.select(*extra, *obs_cols), back).drop(*extra)
    keyed = left.where(F.col(id_col).isNotNull())
    at_type = common_time_type(left.schema[at].dataType, obs.schema[obs_ts].dataType)
    delta = epoch_seconds(F.col(at).cast(at_type)) - epoch_seconds(F.col(_PT).cast(at_type))
    # per row the best candidate, then per id the best row
    rows = left_join(keyed.select(id_col, at, *dict.fromkeys(
        c for c in (*row_key, *[a for a, _ in back]) if c not in (id_col, at))),
        cand.select(*extra, _PT, *carried), back)
    key = F.struct(*[x for c in row_key for x in (F.col(c).isNull().alias(f"n_{c}"),
                                                  F.col(c).alias(f"k_{c}"))])
    order = F.struct(F.col(_PT).isNull().alias("none"), F.abs(delta).alias("d"),
                     F.signum(delta).alias("s"), F.col(tiebreak).alias("t"), key.alias("k"))
    payload = F.struct(key.alias("_cr_key"), *[F.col(c).alias(c) for c in obs_cols])
    best = rows.groupBy(F.col(id_col).alias("_cr_id")).agg(F.min_by(payload, order).alias("_cr_best"))
    # the best row comes first in its id's window: as a filter, its key would be
    # one more key of the join, and the rows dealt again by the id alone
    out = (keyed.join(best, keyed[id_col] == best["_cr_id"])
           .withColumns({"_cr_other": key != F.col("_cr_best._cr_key"),
                         **{c: F.col(f"_cr_best.{c}") for c in obs_cols}}).drop("_cr_id", "_cr_best"))
    names = [c for c in out.columns if c != "_cr_other"]
    w = Window.partitionBy(id_col).orderBy("_cr_other", F.xxhash64(*names))
    out = out.withColumn("_cr_rn", F.row_number().over(w)).where("_cr_rn = 1").select(*names)
    return out.unionByName(unkeyed.select(*names))
