"""Mixing sources to target weights by temperature.

Source token shares p are raised to an exponent and normalised. The exponent is
bisected until the weights meet a target entropy or a limit on repetition. The
weights are then realised: each source's budget of tokens is filled by whole
passes over the source and a last part of one, every pass in its own random
order of blocks.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK_TOKENS = 200_000
MAX_BLOCKS = 8192  # of a source; its blocks are larger beyond that
MAX_REPEAT = 2.0
ENTROPY = 0.98  # share of the entropy of equal weights
STEPS = 60


def words(text_col: str = "text") -> Column:
    """White-space separated words: the default measure of a text's tokens."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"\s+", " "))
    return F.when(trimmed == "", 0).otherwise(
        F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "))) + 1).cast("long")


def temper(tokens: list[int], exponent: float) -> list[float]:
    """Shares to the power ``exponent``, normalised; a source without tokens has
    no weight."""
    whole = sum(tokens)
    if not whole:
        return [0.0] * len(tokens)
    raw = [(t / whole) ** exponent if t else 0.0 for t in tokens]
    return [x / sum(raw) for x in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def solve(tokens: list[int], target_entropy: float | None, max_repeat: float) -> float:
    """The largest exponent whose weights have the target entropy, raised as
    far as the repetition limit asks: a source then has at most ``max_repeat``
    times as many passes as the source with the fewest. Entropy falls and
    repetition falls as the exponent grows from 0 to 1, so both are bisected."""
    some = [t for t in tokens if t]
    if len(some) < 2:
        return 1.0

    def bisect(ok) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(STEPS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if ok(mid) else (lo, mid)
        return lo

    def repeats(a: float) -> float:
        passes = [w / t for w, t in zip(temper(some, a), some, strict=True)]
        return max(passes) / min(passes)

    goal = (target_entropy if target_entropy is not None else ENTROPY) * math.log(len(some))
    exponent = 1.0 if entropy(temper(some, 1.0)) >= goal else \
        bisect(lambda a: entropy(temper(some, a)) >= goal)
    if repeats(exponent) > max_repeat:
        exponent = 1.0 if max_repeat <= 1 else 1 - bisect(lambda a: repeats(1 - a) <= max_repeat)
    return exponent


def budgets(tokens: list[int], exponent: float, total: int | None) -> list[int]:
    """Tokens for each source. Without a ``total`` it is the least at which every
    source is used in full at least once, so that no document is left out."""
    weights = temper(tokens, exponent)
    if total is None:
        passes = [w / t for w, t in zip(weights, tokens, strict=True) if t]
        return [max(t, math.floor(w / min(passes) + 0.5)) if t else 0
                for w, t in zip(weights, tokens, strict=True)]
    return [int(Fraction(w) * total) for w in weights]


def _hash(seed: int, *cols) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def mix(docs: DataFrame, tokens: Column | None = None, total: int | None = None,
        target_entropy: float | None = None, max_repeat: float = MAX_REPEAT, seed: int = 7,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` mixed: every row as often as its source's weight asks, with
    ``mix_copy`` (from 0), ``mix_weight`` of its source, ``mix_tokens`` and
    ``mix_order``, its place in the mixture: pass, place and number of its block
    in that pass's permutation, place in the block. ``ordered`` puts the rows
    there.

    A source's last, partial pass takes blocks in a random order while they
    fit, and of the block in which the budget ends the rows that fit in hash
    order: the pass is short of its budget by less than one text. Rows of a null
    source are a source of their own; texts without tokens come along with
    every whole pass; rows with equal id and tokens share their place. No rows
    give no rows. Columns of ``docs`` named mix_copy, mix_weight, mix_tokens or
    mix_order are replaced.

    The driver holds one row per source: its weight and where its last pass
    ends. Deciding about a row then needs no shuffle of texts."""
    spark = docs.sparkSession
    docs = docs.drop("mix_copy", "mix_weight", "mix_tokens", "mix_order")
    kind = docs.schema[source_col].dataType.simpleString()
    id_kind = docs.schema[id_col].dataType.simpleString()
    measured = docs.withColumn("mix_tokens", words() if tokens is None else tokens.cast("long"))
    narrow = cut_lineage(measured.select(F.col(source_col).alias("s"), F.col(id_col).alias("id"),
                                         F.coalesce("mix_tokens", F.lit(0)).alias("t")), "mix")
    found = narrow.groupBy("s").agg(F.sum("t").alias("t")).orderBy("s").collect()
    held = [r["t"] for r in found]
    exponent = solve(held, target_entropy, max_repeat)
    weights, budget = temper(held, exponent), budgets(held, exponent, total)
    plan = [(r["s"], w, b // t if t else 1, b % t if t else 0,
             min(MAX_BLOCKS, -(-t // BLOCK_TOKENS) or 1))
            for r, t, w, b in zip(found, held, weights, budget, strict=True)]

    def by_source(frame: DataFrame, source: str, rows: list, schema: str) -> DataFrame:
        small = F.broadcast(spark.createDataFrame(rows, f"key {kind}, {schema}"))  # row per source
        return frame.join(small, frame[source].eqNullSafe(small["key"]), "left").drop("key")

    plan_cols = "mix_weight double, passes long, rest long, blocks long"
    block = F.pmod(_hash(seed, "id"), F.col("blocks"))
    place = F.struct(_hash(seed + 1, "passes", "block").alias("h"), F.col("block").alias("b"))
    rows = by_source(narrow, "s", plan, plan_cols).withColumn("block", block)
    before = Window.partitionBy("s").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ends = (rows.where("rest > 0").groupBy("s", "block", "rest", "passes").agg(F.sum("t").alias("bt"))
            .withColumn("place", place)
            .withColumn("before", F.coalesce(F.sum("bt").over(before), F.lit(0)))
            .where("before <= rest and before + bt > rest")
            .select("s", "place", (F.col("rest") - F.col("before")).alias("left")).collect())
    ends = [(r["s"], r["place"], r["left"]) for r in ends]

    # the one block of a source in which its budget ends is cut row by row
    end_cols = "end struct<h: long, b: long>, left long"
    row_place = F.struct(_hash(seed + 2, "id", "t").alias("h"), "id", "t")
    upto = Window.partitionBy("s").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    edge = by_source(rows, "s", ends, end_cols).where("block = end.b")
    cuts = (edge.groupBy("s", "id", "t", "left").agg((F.count("*") * F.col("t")).alias("all"))
            .withColumn("row", row_place).withColumn("sum", F.sum("all").over(upto))
            .where("sum <= left").groupBy("s").agg(F.max("row").alias("cut")).collect())
    cut = {r["s"]: r["cut"] for r in cuts}

    edges = {e[0]: e[1] for e in ends}
    full = [(*p, edges.get(p[0]), cut.get(p[0])) for p in plan]
    keyed = measured.select(F.struct(*docs.columns).alias("row"), F.col(source_col).alias("s"),
                            F.col(id_col).alias("id"), F.col("mix_tokens"),
                            F.coalesce("mix_tokens", F.lit(0)).alias("t"))
    out = by_source(keyed, "s", full, f"{plan_cols}, end struct<h: long, b: long>, "
                    f"cut struct<h: long, id: {id_kind}, t: long>").withColumn("block", block)
    extra = (place < F.col("end")) | ((F.col("block") == F.col("end.b"))
                                      & (row_place <= F.col("cut")))
    n = F.col("passes") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    out = out.withColumn("n", n.cast("int")).where("n > 0").withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    # the last, partial pass is the pass number ``passes``: the same permutation
    own = F.struct(F.col("mix_copy").alias("pass"), _hash(seed + 1, F.col("mix_copy").cast("long"), "block")
                   .alias("block_place"), F.col("block"), _hash(seed + 2, "id", "t").alias("row_place"))
    return out.select("row.*", "mix_copy", "mix_weight", "mix_tokens", own.alias("mix_order"))


def ordered(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` in the order of the mixture, over partitions by range:
    pass by pass, in each pass the blocks of all sources in a random order."""
    return mixed.repartitionByRange("mix_order").sortWithinPartitions("mix_order")
