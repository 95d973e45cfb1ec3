"""Exact top-k search by inner product over multi-resolution segment statistics.

A segment's mean and deviation, each times the root of the segment's length,
give a short vector f with |f(q) - f(x)| <= |q - x| and |f(x)| = |x|. The lower
bound on the distance is an upper bound on the inner product. Bounds go from
few segments to many; exact products are computed for what survives.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import renamed
from .vectors import usable

LEVELS = (4, 16)      # segments, coarse to fine
QUERY_BLOCK = 1024
ROW_BLOCK = 16384
AT_ONCE = 128         # queries refined together
SCALE = 256
LONG = 1 << 63


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, times the root of their lengths."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    size = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / size
    off = x - np.repeat(mean, size, axis=1)
    var = np.add.reduceat(off * off, edges[:-1], axis=1) / size
    return np.hstack([mean, np.sqrt(var)]) * np.sqrt(np.tile(size, 2))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where these hold every sum exactly,
    else in unbounded integers, cut to the range of a long."""
    if not q.size or not x.size or np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(x).T, -LONG, LONG - 1).astype(np.int64)


def block_top(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray,
              k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score): at least every one of the k best
    candidates of each query, ties included. A candidate with the query's id is
    none. ``x_ids`` are in ascending order."""
    out = []
    stats = [(segment_statistics(q, s), segment_statistics(x, s)) for s in LEVELS]
    for lo in range(0, len(q), AT_ONCE):
        part, ids = q[lo:lo + AT_ONCE], q_ids[lo:lo + AT_ONCE]
        own = ids[:, None] == x_ids[None, :]
        alive = ~own
        least = np.full(len(part), -np.inf)
        for fq, fx in stats:
            bound = fq[lo:lo + AT_ONCE] @ fx.T
            slack = 1e-9 * (1 + np.linalg.norm(part, axis=1)[:, None]
                            * np.linalg.norm(x, axis=1)[None, :])
            bound = np.where(alive, bound + slack, -np.inf)
            if x.shape[0] > k:  # the k most promising set the mark to reach
                best = np.argpartition(-bound, k - 1, axis=1)[:, :k]
                for i, cols in enumerate(best):
                    cols = cols[alive[i, cols]]
                    if len(cols) == k:
                        least[i] = max(least[i], _exact(part[i:i + 1], x[cols]).min())
            alive &= bound >= least[:, None]
        cols = np.flatnonzero(alive.any(axis=0))
        score = _exact(part, x[cols])
        for i in range(len(part)):
            mine = np.flatnonzero(alive[i, cols])
            if len(mine) > k:  # stable: ties keep the smaller ids first
                mine = mine[np.argsort(-score[i, mine].astype(object)
                                       if score.min() == -LONG else -score[i, mine],
                                       kind="stable")[:k]]
            out.append((np.full(len(mine), lo + i), cols[mine], score[i, mine]))
    return tuple(np.concatenate([o[j] for o in out]) for j in range(3))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best rows by inner product of floor(256 * component) for every
    row whose id is divisible by ``every``: query_id, rank (from 1), vec_id,
    score. All if fewer; ties go to the smaller id.

    Rows with a null id, a null or empty vector, or null or non-finite
    components take no part. Candidates are all rows of the query's length but
    those of its own id; repeated rows are candidates each, and one query.
    Scores beyond a long are cut to its range. No rows give no rows; other
    columns are not read."""
    v = F.col(vec_col).cast("array<double>")
    # floor() is a long; a larger component is a whole number as it is
    whole = F.transform(v, lambda x: F.when(F.abs(x) >= 2.0 ** 52, x * SCALE)
                        .otherwise(F.floor(x * SCALE).cast("double")))
    rows = (vectors.where(F.col(id_col).isNotNull() & usable(v) & (F.size(v) > 0))
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v")).where(usable(F.col("v")))
            .groupBy("id", "v").agg(F.count("*").alias("copies")).withColumn("dim", F.size("v")))
    rows = cut_lineage(rows, "vectors")
    is_query = F.pmod(F.col("id"), F.lit(every)) == 0
    sizes = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / ROW_BLOCK).cast("long").alias("xs"),
        F.ceil(F.count_if(is_query) / QUERY_BLOCK).cast("long").alias("qs")).where("qs > 0")
    held = rows.join(sizes, "dim")
    zero = F.lit(0).cast("long")
    queries = held.where(is_query).select(
        "dim", F.pmod(F.xxhash64("id", "v", F.lit(1)), F.col("qs")).alias("q"),
        F.explode(F.sequence(zero, F.col("xs") - 1)).alias("x"), "id", "v")
    found = held.select(
        "dim", F.explode(F.sequence(zero, F.col("qs") - 1)).alias("q"),
        F.pmod(F.xxhash64("id", "v", F.lit(2)), F.col("xs")).alias("x"), "id", "v", "copies")

    def best(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(xs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "copies": []})
        qs, xs = qs.sort_values("id"), xs.sort_values("id")
        q_ids, x_ids = qs["id"].to_numpy(), xs["id"].to_numpy()
        i, j, score = block_top(np.stack(qs["v"].to_numpy()), q_ids,
                                np.stack(xs["v"].to_numpy()), x_ids, k)
        return pd.DataFrame({"query_id": q_ids[i], "vec_id": x_ids[j], "score": score,
                             "copies": xs["copies"].to_numpy()[j]})

    keys = ["dim", "q", "x"]
    near = queries.groupBy(*keys).cogroup(renamed(found).groupBy(*keys)).applyInPandas(
        best, "query_id long, vec_id long, score long, copies long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    copies = F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "vec_id", "score", F.explode(copies))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
