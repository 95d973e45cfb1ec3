"""Near-duplicate vectors by an exact metric range join.

On unit vectors the cosine threshold is a distance r. Pivots part each label's
vectors into cells by the nearest pivot. The triangle inequality, in its sharp
form for a plane midway between two pivots, tells which other cells can hold
anything within r of a vector; the vector visits these. Then every cell is
joined on its own, in blocks, and each vector meets all its links in its own
cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import renamed
from .graph import connected_components

COSINE = 0.93
PER_PIVOT = 2000   # vectors of a label for each of its pivots, in the mean
PIVOTS = 256       # pivots of a label at most: cells then grow, and have more blocks
CHUNK = 8192       # vectors placed by one task's group
BLOCK = 2048       # vectors on either side of one block of a cell's join


def usable(vector: Column) -> Column:
    """No null or non-finite component (null for a null vector)."""
    return F.forall(vector, lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")),
                                                 F.lit(False)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def unit(vectors: pd.Series) -> pd.Series:
    """Each vector over its norm, scaled first so that no square overflows; null
    for null, empty and zero vectors."""
    def one(v):
        top = np.abs(v).max() if v is not None and len(v) else 0.0
        return None if top == 0 else v / top / np.linalg.norm(v / top)
    return vectors.map(one, na_action=None)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _place(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """The cells of each vector: its own (home) and those that it visits."""
    if not len(rows):
        return pd.DataFrame({"label": [], "dim": [], "cell": [], "rep": [], "w": [], "home": [],
                             "v": []})
    r = np.sqrt(2 - 2 * COSINE) + 1e-9
    pivots = pivots.sort_values("rep")
    x, p = _matrix(rows["v"]), _matrix(pivots["v"])
    square = np.maximum(0, 2 - 2 * (x @ p.T))
    home = square.argmin(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[home]
    own = square[np.arange(len(x)), home][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        margin = np.where(apart > 0, (square - own) / (2 * apart), 0)
    at, cell = np.nonzero(margin <= r)
    out = rows.iloc[at][["label", "dim", "rep", "w", "v"]].reset_index(drop=True)
    return out.assign(cell=pivots["rep"].to_numpy()[cell], home=home[at] == cell)


def _reached(linked: np.ndarray) -> np.ndarray:
    """(row, column) pairs that join each component of a bipartite graph to its
    first row: a forest of stars, however many links there are."""
    rows_left = linked.any(axis=1)
    free = np.ones(linked.shape[1], bool)
    out = []
    for i in range(len(linked)):
        if not rows_left[i]:
            continue
        rows_left[i] = False
        front, seen_rows = np.array([i]), []
        while len(front):
            new = np.flatnonzero(linked[front].any(axis=0) & free)
            free[new] = False
            out.extend((i, -1, c) for c in new)
            front = np.flatnonzero(linked[:, new].any(axis=1) & rows_left) if len(new) else new
            rows_left[front] = False
            seen_rows.extend(front)
        out.extend((i, q, -1) for q in seen_rows)
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def _join(homes: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """Counts (u, n) of the home vectors' links to the other side, and edges
    (u, v) that connect what is linked here."""
    if not len(homes) or not len(others):
        return pd.DataFrame({"u": [], "v": [], "n": []})
    linked = _matrix(homes["v"]) @ _matrix(others["v"]).T >= COSINE
    a, b = homes["rep"].to_numpy(), others["rep"].to_numpy()
    linked &= a[:, None] != b[None, :]
    n = linked @ others["w"].to_numpy(np.float64)
    counts = pd.DataFrame({"u": a, "v": None, "n": n.astype(np.int64)})
    way = _reached(linked)
    ends = np.where(way[:, 1] >= 0, a[way[:, 1]], b[way[:, 2]])
    edges = pd.DataFrame({"u": a[way[:, 0]], "v": ends, "n": 0})
    out = pd.concat([counts[counts["n"] > 0], edges[edges["u"] != edges["v"]]])
    return out.astype({"u": "int64", "v": "Int64", "n": "int64"})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links`` (other rows of the
    same label at a cosine of 0.93 or more), ``component_id`` (the least id
    reached by links, itself included) and ``kept`` (it has that id itself).

    Null, empty and zero vectors, vectors with null or non-finite components,
    and rows with a null id or label link with nothing (a null id: component
    null, kept). Vectors of different lengths are never linked. Equal vectors
    of a label are one weighted class, so that copies are counted but not
    compared. No rows give no rows; other columns are not read."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          unit(F.when(usable(v), v)).alias("v"))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    rows = cut_lineage(rows.select("id", F.when(fit, F.col("label")).alias("label"),
                                   F.when(fit, F.col("v")).alias("v")), "vectors")
    kind = rows.schema["label"].dataType.simpleString()
    reps = cut_lineage(rows.where("v is not null").groupBy("label", "v").agg(
        F.min("id").alias("rep"), F.count("*").alias("w")).withColumn("dim", F.size("v")), "reps")

    group = ["label", "dim"]
    sizes = reps.groupBy(*group).agg(F.count("*").alias("size"), F.min("rep").alias("least"))
    sized = reps.join(sizes, group)
    spread = F.ceil(F.greatest(F.lit(PER_PIVOT), F.col("size") / PIVOTS)).cast("long")
    chosen = F.pmod(F.xxhash64("rep", F.lit("pivot")), spread) == 0
    pivots = sized.where(chosen | (F.col("rep") == F.col("least")))
    chunks = F.ceil(F.col("size") / CHUNK).cast("long")
    placed = sized.withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks))
    pivots = pivots.select(*group, "rep", "v",
                           F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
    keys = [*group, "chunk"]
    cells = cut_lineage(
        placed.select(*keys, "rep", "w", "v").groupBy(*keys).cogroup(renamed(pivots).groupBy(*keys))
        .applyInPandas(_place, f"label {kind}, dim int, cell long, rep long, w long, home boolean, "
                               "v array<double>"), "cells")

    cell = ["label", "dim", "cell"]
    counts = cells.groupBy(*cell).agg(
        F.ceil(F.count_if("home") / BLOCK).cast("long").alias("hs"),
        F.ceil(F.count("*") / BLOCK).cast("long").alias("os")).where("hs > 0")
    held = cells.join(counts, cell).select(
        *cell, "rep", "w", "v", "home", "hs", "os",
        F.pmod(F.xxhash64("rep", F.lit(1)), F.col("hs")).alias("h"),
        F.pmod(F.xxhash64("rep", F.lit(2)), F.col("os")).alias("o"))
    zero = F.lit(0).cast("long")
    homes = held.where("home").select(*cell, "h", F.explode(F.sequence(zero, F.col("os") - 1))
                                      .alias("o"), "rep", "w", "v")
    others = held.select(*cell, F.explode(F.sequence(zero, F.col("hs") - 1)).alias("h"), "o",
                         "rep", "w", "v")
    keys = [*cell, "h", "o"]
    met = cut_lineage(homes.groupBy(*keys).cogroup(renamed(others).groupBy(*keys)).applyInPandas(
        _join, "u long, v long, n long"), "links")

    parts = connected_components(met.where("v is not null").select("u", "v"))
    links = met.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    classes = (reps.join(links.withColumnRenamed("u", "rep"), "rep", "left")
               .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
               .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(classes, ["label", "v"], "left").withColumn(
        "component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long"))
                      .alias("n_links"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
