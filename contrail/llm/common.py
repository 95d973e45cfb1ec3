"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("documents", "embeddings", "labels")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True for the fold that labels are not learned from; a null id is never
    held out."""
    return F.coalesce(id_crc_mod(id_col, modulus) == remainder, F.lit(False))


def text_slices(text: str, size: int = 1 << 18) -> Iterator[str]:
    """``text`` cut after spaces or line ends into slices of about ``size``
    characters (a single longer word stays whole)."""
    if len(text) <= size:
        yield text
        return
    at, n = 0, len(text)
    while at < n:
        end = at + size
        if end >= n:
            yield text[at:]
            return
        cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
        if cut < at:
            ahead = [x for x in (text.find(" ", end), text.find("\n", end)) if x >= 0]
            cut = min(ahead) if ahead else n - 1
        yield text[at:cut + 1]
        at = cut + 1


def byte_level_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable Latin-1 stands for
    itself, the other bytes are numbered from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def text_parts(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of rows whose texts have about ``most`` characters together; a
    longer text is alone."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def give_back() -> None:
    """Hand the memory that this Python worker no longer uses back to the system:
    workers wait for the next stage, and what they hold counts there."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def prefix_offsets(totals: DataFrame, key: str, value: str, out: str,
                   fan: int = 1024) -> DataFrame:
    """Exclusive prefix sums of ``value`` in the order of the integer ``key``
    (one row per key), in two levels: inside blocks of ``fan`` keys, then over
    the block totals, so that no task sorts more than keys / fan rows."""
    block = F.floor(F.col(key) / fan)
    t = totals.select(key, value, block.alias("_block"))
    before = Window.partitionBy("_block").orderBy(key).rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = (t.groupBy("_block").agg(F.sum(value).alias("_total"))
              .select("_block", F.coalesce(F.sum("_total").over(
                  Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)).alias("_base")))
    return (t.withColumn("_in", F.coalesce(F.sum(value).over(before), F.lit(0)))
            .join(blocks, "_block")
            .select(key, (F.col("_in") + F.col("_base")).alias(out)))


def document_ranks(ids: np.ndarray, th: np.ndarray) -> np.ndarray:
    """Rank of each document by id and text hash; equal rows are one document."""
    rank, by = np.empty(len(ids), np.int64), np.lexsort((th, ids))
    rank[by] = np.cumsum(np.append(0, (np.diff(ids[by]) != 0) | (np.diff(th[by]) != 0))[:len(ids)])
    return rank


def joined_spans(owner: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Overlapping or touching spans joined: (owner, start, stop), ascending."""
    if not len(owner):
        return owner, start, stop
    by = np.lexsort((start, owner))
    owner, start, stop = owner[by], start[by], stop[by]
    reach = np.maximum.accumulate((owner << 32) + stop)
    new = np.append(True, (owner[1:] << 32) + start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return owner[at], start[at], (reach[np.append(at[1:], len(owner)) - 1]) - (owner[at] << 32)


def first_of_batch(key1: np.ndarray, key2: np.ndarray, place: np.ndarray):
    """(order, new, again) of occurrences in a batch: sorted by key and place, the
    first of each key, and those at later places, which repeat it for certain.
    Others at the first place are the same occurrence in an equal row."""
    order = np.lexsort((place, key2, key1))
    key1, key2, place = key1[order], key2[order], place[order]
    new = np.append(True, (key1[1:] != key1[:-1]) | (key2[1:] != key2[:-1]))[:len(order)]
    first = np.flatnonzero(new)
    return order, new, place > np.repeat(place[first], np.diff(np.append(first, len(order))))


def renamed(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, for a cogroup of two
    frames that come from one."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (narrow, and cheap to count) marked for broadcast if it has at most
    ``rows`` rows; beyond that the join shuffles as usual."""
    return F.broadcast(df) if df.count() <= rows else df
