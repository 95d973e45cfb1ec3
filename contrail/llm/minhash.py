"""Near-duplicate documents: MinHash, banding, verification, components.

Texts with the same shingle set are one class from the start; only classes are
banded and compared. Inside a bucket no pairs are listed: every member is held
against the bucket's least class first, and after that only members of
different components are compared, since a link inside one changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import broadcast_if_small, give_back, text_parts
from .graph import connected_components

SHINGLE = 4
BANDS, ROWS = 30, 5  # a pair of similarity 0.8 shares no band once in 150,000
PERCENT = 80
AT_ONCE = 1 << 22  # characters of texts whose sets are held together
FEW = 16  # members of a bucket, or sets with a shingle, that are paired directly
#: Share of equal minima below which a candidate is dropped unread: 4.6 standard
#: deviations under the threshold. With the bands, a pair of similarity 0.8 is
#: missed about once in 64,700.
ESTIMATE = 0.65
_K = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_RANDOM = np.random.default_rng(20240229).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_A, _B = _RANDOM[0] * np.uint64(2) + np.uint64(1), _RANDOM[1]


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words, ASCII case
    and white space alone being folded; of the whole where there are fewer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    x = h[:len(h) - size + 1].copy()
    for i in range(1, size):
        x = x * _K + h[i:len(h) - size + 1 + i]
    x = (x + np.uint64(size)) * _MIX
    return np.unique((x ^ (x >> np.uint64(32))) * _K)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash a * x + b, its high 32 bits."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        values = shingles[i:i + 512, None] * _A
        values += _B
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, n, set_id, sig) per row; set_id and sig are null without words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["t"]:
                s = shingle_set(text, shingle)
                rows.append((len(s), set_id(s), minima(s).tobytes()) if len(s) else (0, None, None))
            yield pd.concat([b[["id"]], pd.DataFrame(rows, columns=["n", "set_id", "sig"],
                                                     index=b.index)], axis=1)
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")) \
        .mapInPandas(run, "id long, n long, set_id binary, sig binary")


def _candidates(docs: DataFrame, reps: DataFrame, asked: DataFrame, id_col: str,
                text_col: str, shingle: int) -> DataFrame:
    """(key, rep, n, sig, shingles) of the classes in question, their full sets
    being made anew; ``key`` names a row."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo, hi in text_parts([len(t or "") for t in b["t"]], AT_ONCE):
                found = [shingle_set(t, shingle) for t in b["t"].iloc[lo:hi]]
                yield pd.DataFrame({"rep": b["rep"].iloc[lo:hi].to_numpy(), "set_id": [set_id(s) for s in found],
                                    "shingles": [s.view(np.int64) for s in found]})
        give_back()

    asked = broadcast_if_small(cut_lineage(asked, "asked"))
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("t"))
    made = texts.join(asked, "rep").mapInPandas(sets, "rep long, set_id binary, shingles array<long>")
    # by set as well: rows that share an id can differ in text
    made = (made.join(reps.join(asked, "rep"), ["rep", "set_id"]).dropDuplicates(["rep", "set_id"])
            .withColumn("key", F.monotonically_increasing_id()))
    return cut_lineage(made.select("key", "rep", "n", "sig", "shingles"), "sets")


def _rare_shingles(sets: DataFrame, crowded: DataFrame) -> DataFrame:
    """(key, rep, n, h): the shingles that at most ``FEW`` of the sets in crowded
    buckets have, in each of these."""
    rows = sets.join(crowded, "key", "left_semi").select("key", "rep", "n", F.explode("shingles").alias("h"))
    few = rows.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") <= FEW).select("h")
    return cut_lineage(rows.join(few, "h"), "rare")


def _reachable(common, n, other):
    """Whether a set that shares at most ``common`` of its ``n`` shingles can
    meet the threshold with a set of size ``other``."""
    return common * 100 >= (n + other - common) * PERCENT


def _estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose signatures agree well enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            same = [np.mean(np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4")) >= ESTIMATE
                    for x, y in zip(b["sa"], b["sb"], strict=True)]
            yield b.loc[np.array(same, dtype=bool), ["a", "b"]]

    a = sets.select(F.col("rep").alias("a"), F.col("sig").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    return cut_lineage(pairs.join(b, "b").join(a, "a").mapInPandas(run, "a long, b long"), "estimated")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets meet the threshold."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            linked = []
            for x, y in zip(b["x"], b["y"], strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield b.loc[np.array(linked, dtype=bool), ["a", "b"]].rename(
                columns={"a": "u", "b": "v"})

    x = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return cut_lineage(pairs.join(y, "b").join(x, "a").mapInPandas(run, "u long, v long"), "links")


def _possible(x: str, y: str) -> Column:
    """Whether the sets' sizes and shareable shingles alone allow the threshold."""
    return _reachable(F.least(f"{x}common", f"{y}common"), F.col(f"{x}n"), F.col(f"{y}n"))


def _open(alive: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of buckets with several components, and those of them that
    are not in their bucket's largest one (``main``)."""
    placed = alive.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", "n", "common", F.coalesce("component", "rep").alias("c"))
    main = (placed.groupBy("bucket", "c").agg(F.count("*").alias("k")).groupBy("bucket")
            .agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.count("*").alias("parts"))
            .where("parts > 1").select("bucket", "main"))
    open_ = cut_lineage(placed.join(main, "bucket"), "open")
    apart = open_.where("c <> main").select(
        "bucket", "main", F.col("rep").alias("r"), F.col("n").alias("r_n"),
        F.col("common").alias("r_common"), F.col("c").alias("d"))
    return open_, apart


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    return connected_components(parts.select(F.col("node").alias("u"),
                                             F.col("component").alias("v")).union(links))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id``
    (the least id that it reaches by links, itself included) and ``kept`` (it
    has that id itself).

    Documents are linked where 100 * intersection >= 80 * union of their sets
    of ``shingle``-word shingles. Texts without words (null, empty, blank) are linked with
    nothing. Rows with a null id take no part: their component is null and they
    are kept. Repeated rows share their id and so their answer. No rows give no
    rows; other columns of ``docs`` are not read."""
    rows = cut_lineage(signatures(docs, id_col, text_col, shingle), "signatures")
    reps = cut_lineage(rows.where("n > 0 and id is not null").groupBy("set_id").agg(
        F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")),
        "classes")
    width = 4 * ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                        lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))
    banded = reps.select("rep", F.explode(bands).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("top"))
    members = cut_lineage(banded.join(shared.where("low <> top").select("bucket"), "bucket"), "buckets")
    sets = _candidates(docs, reps, members.select("rep").distinct(), id_col, text_col,
                       shingle)

    sized = members.join(sets.select("key", "rep", "n"), "rep")
    size = sized.groupBy("bucket").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    sized = cut_lineage(sized.join(size, "bucket"), "sized")
    # In a crowded bucket two sets share a rare shingle, and are paired for
    # that, or share none: then their frequent shingles alone must do. Most
    # sets cannot do it, whatever the partner, and go; the set with the most
    # frequent ones is in the middle of the others and leads.
    crowd = F.col("k") > FEW
    rare = _rare_shingles(sets, sized.where(crowd).select("key").distinct())
    own = rare.groupBy("key").agg(F.count("*").alias("rare"))
    reach = (sized.where(~crowd).withColumn("common", F.col("n"))
             .unionByName(sized.where(crowd).join(own, "key", "left").withColumn(
                 "common", F.col("n") - F.coalesce("rare", F.lit(0))).drop("rare")))
    alive = reach.where(_reachable(F.col("common"), F.col("n"), F.greatest("common", "least")))
    middle = F.struct(F.when(crowd, -F.col("common")).otherwise(F.lit(0).cast("long")).alias("o"),
                      F.col("rep").alias("lead"), F.col("n").alias("l_n"),
                      F.col("common").alias("l_common"))
    lead = alive.groupBy("bucket").agg(F.min(middle).alias("l"), F.count("*").alias("m"))
    alive = cut_lineage(alive.join(lead.where("m > 1").select("bucket", "l.lead", "l.l_n", "l.l_common"),
                                   "bucket").drop("key", "k", "least"), "alive")

    x = rare.select("h", F.col("rep").alias("a"), F.col("n").alias("a_n"), F.col("n").alias("a_common"))
    y = rare.select("h", F.col("rep").alias("b"), F.col("n").alias("b_n"), F.col("n").alias("b_common"))
    kin = x.join(y, "h").where("a < b").where(_possible("a_", "b_")).select("a", "b")
    tried = cut_lineage(alive.where("rep <> lead").where(_possible("", "l_"))
                        .select(F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b"))
                        .union(kin).distinct(), "candidates")
    parts = connected_components(_confirmed(_estimated(tried, sets), sets))

    # the same with the middle of the whole component that has most of a bucket
    open_, apart = _open(alive, parts)
    centres = (alive.select("rep", "n", "common").distinct()
               .join(parts.withColumnRenamed("node", "rep"), "rep").groupBy("component")
               .agg(F.min(F.struct((-F.col("common")).alias("o"), F.col("rep").alias("lead"),
                                   F.col("n").alias("l_n"), F.col("common").alias("l_common"))).alias("l"))
               .select(F.col("component").alias("main"), "l.lead", "l.l_n", "l.l_common"))
    middles = (apart.join(centres, "main").where(_possible("r_", "l_"))
               .select(F.least("lead", "r").alias("a"), F.greatest("lead", "r").alias("b")).distinct()
               .join(tried, ["a", "b"], "left_anti"))
    middles = cut_lineage(middles, "candidates")
    parts = _joined(parts, _confirmed(_estimated(middles, sets), sets))

    open_, apart = _open(alive, parts)
    tried = tried.union(middles)
    # a pair meets in the first of its shared buckets only
    known = sets.select("rep", bands.alias("bands"))
    open_ = open_.join(known, "rep")
    apart = apart.drop("main").join(known.select(F.col("rep").alias("r"), F.col("bands").alias("r_bands")), "r")
    met = (open_.join(apart, "bucket").where("c <> d").where(_possible("", "r_"))
           .where(F.get(F.array_intersect("bands", "r_bands"), F.lit(0)) == F.col("bucket"))
           .select(F.least("rep", "r").alias("a"), F.greatest("rep", "r").alias("b")).distinct())
    rest = cut_lineage(met.join(tried, ["a", "b"], "left_anti"), "candidates")
    more = _confirmed(_estimated(rest, sets), sets)
    parts = _joined(parts, more)

    classes = (reps.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
               .select("set_id", F.coalesce("component", "rep").alias("component_id")))
    found = rows.select("id", "n", F.when(F.col("id").isNotNull(), F.col("set_id")).alias("set_id"))
    found = found.join(classes, "set_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
