"""Duplicate substrings by suffix arrays over the whole corpus.

The bytes of a text from every place on are suffixes. They are dealt by a
landmark: of the k-grams in the first ``length`` bytes of a suffix the one with
the least hash, so that suffixes which begin alike have the same landmark
wherever they stand. Neighbouring suffixes with one landmark travel as one
segment; equal segments are one, with the first of their places. The segments
of landmarks that several texts hold meet in buckets. In each bucket a suffix
array is built by two-stage sorting, and adjacent common prefixes show which
suffixes begin alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import document_ranks, first_of_batch, joined_spans

LENGTH = 100          # bytes of a string that counts as a repeat
GRAM = 16             # bytes of a landmark
SLICE = 1 << 21       # bytes that are searched for landmarks together
FREQUENT = 1 << 16    # a landmark with this share of all is chosen last
BUCKET = 1 << 20      # bytes of segments sorted together, in the mean
CROWD = 20_000        # segments of one landmark, beyond which its strings travel singly
DOCS = 512            # documents whose segments are cut together
_PLACE = 23           # bits of a place in a slice (a slice and what it overlaps)
_MIX = np.random.default_rng(16).integers(1, 1 << 63, 3, dtype=np.uint64) | np.uint64(1)


class Frequent:
    """The hashes that are chosen last, looked up through a small bitmap."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.marked = np.zeros(1 << 20, bool)
        self.marked[self.hashes >> np.uint64(44)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.marked[h >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[at] == h[maybe]]


def gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every place on."""
    n = len(data) - GRAM + 1
    words = np.ndarray((n + 8,), "<u8", buffer=data, strides=(1,))
    h = np.zeros(n, np.uint64)
    for j, odd in zip((0, 8), _MIX, strict=False):
        w = words[j:j + n]
        h += (w ^ (w >> np.uint64(29))) * odd
    h ^= h >> np.uint64(32)
    h *= _MIX[2]
    return h ^ (h >> np.uint64(29))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` neighbours from every place on."""
    blocks = np.pad(x, (0, -len(x) % width), constant_values=np.iinfo(x.dtype).max).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def landmarks(data: bytes, sizes: np.ndarray, frequent: Frequent | None,
              length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last suffix of each segment of the pieces that make up
    ``data`` (at most 2**23 bytes). A segment's suffixes have one landmark: the
    least hash, then the first place, of the k-grams in their first ``length``
    bytes."""
    if len(data) < length:
        return (np.zeros(0, np.uint64), *np.zeros((2, 0), np.int64))
    h = gram_hashes(data)
    low = np.uint64((1 << _PLACE) - 1)
    rank = h >> np.uint64(1)
    if frequent is not None and len(frequent.hashes):
        rank[frequent(h)] |= np.uint64(1 << 63)
    rank = (rank & ~low) | np.arange(len(h), dtype=np.uint64)
    at = (_least(rank, length - GRAM + 1) & low).astype(np.int64)
    ends = np.cumsum(sizes)
    inside = np.zeros(len(at) + 1, np.int64)  # suffixes that do not run into the next piece
    long = sizes >= length
    np.add.at(inside, (ends - sizes)[long], 1)
    np.add.at(inside, (ends - length + 1)[long], -1)
    inside = np.cumsum(inside[:-1]) > 0
    first = inside.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    # pieces that follow each other without a gap have suffixes between them that are not inside
    first[(ends - sizes)[long]] = True
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    start, stop = np.flatnonzero(first), np.flatnonzero(last)
    return h[at[start]], start, stop


def _slices(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """(text, from, to) of pieces of about ``SLICE`` bytes together; the pieces
    of one long text overlap, so that every suffix is in one of them."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for lo in range(0, max(len(text) - length + 1, 0), SLICE):
            piece = (k, lo, min(len(text), lo + SLICE + length - 1))
            if held and size + piece[2] - lo > SLICE + length:
                yield held
                held, size = [], 0
            held.append(piece)
            size += piece[2] - lo
    if held:
        yield held


def _found(texts: list[bytes], frequent: Frequent | None, length: int, with_hash: bool):
    """Per segment of the texts: landmark, content hash (with ``with_hash``),
    text, first byte, size."""
    out = []
    for pieces in _slices(texts, length):
        data = b"".join([texts[k][lo:hi] for k, lo, hi in pieces])
        text, lo, hi = np.array(pieces, np.int64).T
        h, start, stop = landmarks(data, hi - lo, frequent, length)
        ends = np.cumsum(hi - lo)
        own = np.searchsorted(ends, start, side="right")
        stop = stop + length
        g = np.zeros(0, np.uint64)
        if with_hash:
            g = np.fromiter(map(xxhash.xxh3_64_intdigest, (data[x:y] for x, y in zip(
                start.tolist(), stop.tolist(), strict=True))), np.uint64, len(start))
        out.append((h, g, text[own], start - (ends - hi)[own], stop - start))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def frequent_landmarks(texts: DataFrame, length: int = LENGTH) -> np.ndarray:
    """Landmarks that make up at least half of one in ``FREQUENT`` of all: at
    most 2 * ``FREQUENT`` hashes. A batch leaves out those with less than that
    share in it, or a single place: they are counted too low. Which landmarks are
    frequent changes how suffixes are dealt, not what is found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, _, text, _, _ = _found(batch.column("t").to_pylist(), None, length, False)
            every, n = np.unique(h, return_counts=True)
            some = (n > 1) & (n * 2 * FREQUENT >= len(h))
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(np.append(every[some].view(np.int64), 0)),
                "n": pa.array(np.append(n[some], 0)),
                "every": pa.array(np.append(np.zeros(some.sum(), np.int64), len(h)))})

    found = texts.select("t").mapInArrow(run, "h long, n long, every long").groupBy("h").agg(
        F.sum("n").alias("n"), F.sum("every").alias("every"))
    found = cut_lineage(found, "frequent")
    every = found.agg(F.sum("every")).first()[0] or 0
    rows = found.where((F.col("n") > 1) & (F.col("n") * 2 * FREQUENT >= every)).select("h").toArrow()
    return rows.column("h").to_numpy().view(np.uint64)


def _segments(texts: DataFrame, frequent: np.ndarray, length: int) -> DataFrame:
    """(h, g, id, th, at, n) of the segments. Of equal segments in a batch only
    the first goes on; the others are repeats for certain and come joined, with
    a null g."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = Frequent(sent.value)
        for batch in batches:
            ids, th = (batch.column(c).to_numpy() for c in ("id", "th"))
            h, g, text, at, n = _found(batch.column("t").to_pylist(), rare, length, True)
            by, new, again = first_of_batch(h, g, (document_ranks(ids, th)[text] << 32) + at)
            h, g, text, at, n = (x[by] for x in (h, g, text, at, n))
            own, start, stop = joined_spans(text[again], at[again], at[again] + n[again])
            k = len(own)
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(np.append(h[new].view(np.int64), (own * 40503 + start) * 2654435761)),
                "g": pa.array(np.append(g[new].view(np.int64), np.zeros(k, np.int64)),
                              mask=np.append(np.zeros(new.sum(), bool), np.ones(k, bool))),
                "id": pa.array(ids[np.append(text[new], own)]),
                "th": pa.array(th[np.append(text[new], own)]),
                "at": pa.array(np.append(at[new], start).astype(np.int32)),
                "n": pa.array(np.append(n[new], stop - start).astype(np.int32))})

    return texts.select("id", "th", "t").mapInArrow(run, "h long, g long, id long, th int, at int, n int")


def _words(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every place the next eight symbols up to an end mark as one number,
    and the symbols before the mark."""
    marks = np.flatnonzero(s == 0)
    left = marks[np.searchsorted(marks, np.arange(len(s)))] - np.arange(len(s))
    padded = np.concatenate([s, np.zeros(7, np.uint8)])
    w = np.ndarray((len(s),), ">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    cut = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
    w = np.where(cut == 64, 0, w >> np.minimum(cut, np.uint64(63)) << np.minimum(cut, np.uint64(63)))
    return w.astype(np.uint64), left


def _sorted_directly(places: np.ndarray, w: np.ndarray, left: np.ndarray,
                     depth: int | None) -> np.ndarray:
    """``places`` in the order of their suffixes, eight symbols at a time, by
    their first ``depth`` symbols at least; those that are alike so far or up to
    their end marks stay in the order of places."""
    order = places[np.argsort(w[places], kind="stable")]
    group = np.cumsum(np.append(0, w[order[1:]] != w[order[:-1]])) if len(order) else order
    open_, at = np.arange(len(order)), 0
    while depth is None or at + 8 < depth:
        size = np.bincount(group, minlength=1)
        go = (size[group] > 1) & (left[order[open_] + at] >= 8)
        open_, group, at = open_[go], group[go], at + 8
        if not len(open_):
            break
        key = w[order[open_] + at]
        first = np.flatnonzero(np.append(True, np.diff(group) != 0))
        size = np.diff(np.append(first, len(group)))
        # groups that go on alike need no sorting
        mixed = np.repeat(np.logical_or.reduceat(key != np.repeat(key[first], size), first), size)
        part = np.flatnonzero(mixed)
        by = part[np.lexsort((key[part], group[part]))]
        order[open_[part]], key[part] = order[open_[by]], key[by]
        group = np.cumsum(np.append(0, (np.diff(group) != 0) | (key[1:] != key[:-1])))
    return order


def suffix_array(s: np.ndarray, least: int = 1, depth: int | None = None) -> np.ndarray:
    """The suffixes of ``s`` (uint8, 0 an end mark, the last symbol one) that
    have ``least`` symbols before the mark, in order; with ``depth`` in the order
    of their first ``depth`` symbols at least. Marks are less than all else, the
    earlier less than the later.

    Two stages: suffixes smaller than their successor are sorted directly. The
    others are induced: scanning the suffixes in order, bucket by bucket of the
    first symbol, the predecessor of each goes to the next free place of its own
    bucket if it is larger. Of the shorter suffixes those take part that a longer
    one is induced from."""
    n = len(s)
    up = np.sign(np.diff(s.astype(np.int16)))
    decided = np.append(np.where(up != 0, np.arange(n - 1), n - 1), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    direct = np.append(up > 0, True)[decided] & (s > 0)
    w, left = _words(s)
    if least > 1:
        wanted = left >= least
        source = np.minimum.accumulate(np.where(direct | (s == 0), np.arange(n), n - 1)[::-1])[::-1]
        wanted[source[wanted]] = True
        direct &= wanted
    direct = _sorted_directly(np.flatnonzero(direct), w, left, depth)
    symbols = np.unique(s)
    bounds = np.searchsorted(s[direct], symbols), np.searchsorted(s[direct], symbols, side="right")
    induced: dict[int, list[np.ndarray]] = {int(c): [] for c in symbols}
    out = []
    for c, lo, hi in zip(symbols.tolist(), *bounds, strict=True):
        front = np.concatenate(induced.pop(c)) if induced[c] else np.zeros(0, np.int64)
        parts = [np.flatnonzero(s == 0)] if c == 0 else []
        while len(front):  # predecessors with the same symbol are in this bucket too
            parts.append(front)
            front = front[front > 0] - 1
            front = front[s[front] == c] if c else front[:0]
        bucket = np.concatenate([*parts, direct[lo:hi]])
        before = bucket[bucket > 0] - 1
        before = before[s[before] > c]
        first = s[before]
        before = before[np.argsort(first, kind="stable")]
        for d, k in zip(*np.unique(first, return_counts=True), strict=True):
            induced[int(d)].append(before[:k])
            before = before[k:]
        if c:
            out.append(bucket)
    out = np.concatenate(out) if out else np.zeros(0, np.int64)
    return out[left[out] >= least]


def common_prefixes(order: np.ndarray, s: np.ndarray, most: int) -> np.ndarray:
    """Symbols that each suffix has in common with the one before it in
    ``order`` (0 for the first), counted up to ``most``."""
    w, left = _words(s)
    out = np.zeros(len(order), np.int64)
    on, depth = np.arange(1, len(order)), 0
    while len(on) and depth < most:
        a, b = order[on - 1] + depth, order[on] + depth
        differ = w[a] ^ w[b]
        same = sum((differ >> np.uint64(64 - 8 * j) == 0).astype(np.int64) for j in range(1, 8)) + (differ == 0)
        out[on] += np.minimum(same, np.minimum(left[a], left[b]))
        go = (same == 8) & (left[a] >= 8) & (left[b] >= 8)
        on, depth = on[go], depth + 8
    return np.minimum(out, most)


def repeats(texts: list[bytes], place: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """(text, first byte) of the strings of ``length`` bytes in ``texts`` (UTF-8)
    that stand at an earlier place too; ``place`` is that of each text's first
    byte, and places go on byte by byte."""
    s = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)  # UTF-8 has no 0xff: marks
    order = suffix_array(s, length, length)
    alike = common_prefixes(order, s, length) >= length
    start = np.cumsum([0, *(len(t) + 1 for t in texts)])
    own = np.searchsorted(start, order, side="right") - 1
    places = place[own] + order - start[own]
    run = np.cumsum(~alike) - 1
    first = np.minimum.reduceat(places, np.flatnonzero(~alike)) if len(order) else places
    again = places > first[run] if len(order) else alike
    return np.stack([own[again], (order - start[own])[again]], axis=1)


def _sort_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    ids, th, at = (rows[c].to_numpy() for c in ("id", "th", "at"))
    found = repeats(rows["segment"].tolist(), (document_ranks(ids, th) << 32) + at)
    own, start = found[:, 0], at[found[:, 0]] + found[:, 1]
    own, start, stop = joined_spans(own, start, start + LENGTH)
    return pd.DataFrame({"id": ids[own], "th": th[own], "at": start, "n": stop - start})


def _repeated(texts: DataFrame, length: int) -> DataFrame:
    """(id, th, at, n): spans of bytes that repeat earlier ones."""
    spark = texts.sparkSession
    rows = _segments(texts, frequent_landmarks(texts, length), length)
    place = F.struct("id", "th", "at")
    same, alike = Window.partitionBy("h", "g"), Window.partitionBy("h")
    rows = rows.repartition("h").withColumn("first", F.min(place).over(same))
    rows = rows.withColumn("again", F.col("g").isNull() | (F.col("first") != place))
    lead = F.when(~F.col("again"), F.col("g"))
    rows = (rows.withColumn("least", F.min(lead).over(alike)).withColumn("most", F.max(lead).over(alike))
            .withColumn("classes", F.count(lead).over(alike))
            .where("again or least <> most")
            .select("id", "th", "at", "n", F.when(~F.col("again"), F.col("h")).alias("h"), "classes"))
    found = cut_lineage(rows, "segments")
    sorted_ = found.where("h is not null")
    size = sorted_.agg(F.sum("n")).first()[0] or 0
    again = found.where("h is null").select("id", "th", "at", "n")
    if not size:
        return again

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, DOCS):
                part = batch.slice(lo, DOCS)
                texts, held = part.column("t").to_pylist(), part.column("held")
                own = np.repeat(np.arange(len(texts)), held.value_lengths().to_numpy())
                h, at, n, crowd = (held.flatten().field(c) for c in ("h", "at", "n", "crowd"))
                segments = [texts[i][x:x + y] for i, x, y in zip(
                    own.tolist(), at.to_pylist(), n.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "h": h, "id": part.column("id").take(pa.array(own)),
                    "th": part.column("th").take(pa.array(own)), "at": at,
                    "segment": pa.array(segments, pa.binary()), "crowd": crowd})

    held = sorted_.groupBy("id", "th").agg(F.collect_set(F.struct(
        "h", "at", "n", (F.col("classes") > CROWD).alias("crowd"))).alias("held"))
    segments = texts.join(held, ["id", "th"]).select("id", "th", "t", "held").mapInArrow(
        cut, "h long, id long, th int, at int, segment binary, crowd boolean")
    buckets = -(-size // BUCKET)
    spans = "id long, th int, at int, n int"
    out = again.unionByName(
        segments.where("not crowd").withColumn("bucket", F.pmod("h", F.lit(buckets)))
        .groupBy("bucket").applyInPandas(_sort_bucket, spans))
    if sorted_.where(F.col("classes") > CROWD).isEmpty():
        return out
    # the strings of a crowded landmark meet one by one, by their bytes
    one = F.explode(F.sequence(F.lit(0), F.octet_length("segment") - length))
    single = segments.where("crowd").select("id", "th", "at", "segment", one.alias("j")).select(
        "id", "th", (F.col("at") + F.col("j")).alias("at"),
        F.substring("segment", F.col("j") + 1, F.lit(length)).alias("bytes"))
    single = cut_lineage(single.select("id", "th", "at", F.unhex(F.sha2("bytes", 256)).alias("s")), "single")
    first = single.groupBy("s").agg(F.min(place).alias("first"), F.count("*").alias("k")).where("k > 1")
    return out.unionByName(single.join(first, "s").where(place != F.col("first"))
                           .select("id", "th", "at", F.lit(length).alias("n")))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes`` of its text in UTF-8,
    the removed ``spans`` (start, end; the longest runs of removed bytes) and the
    bytes ``kept``. Removed are the bytes of every string of ``length`` bytes
    that also starts earlier: in a text with a smaller id, or earlier in the same.

    Null texts are empty; empty and short ones stay as they are. Rows with a
    null id match nothing. Of rows with equal ids and different texts the one
    with the smaller hash comes first; rows equal in id and text are one
    document, with the same answer each. No rows give no rows; other columns
    are not read."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"))
    twice = not rows.groupBy("id").count().where("count > 1 and id is not null").isEmpty()
    rows = rows.select("id", (F.hash("t") if twice else F.lit(0)).alias("th"), "t")
    known = rows.where(F.col("id").isNotNull())
    held = _repeated(known, length).groupBy("id", "th").agg(F.collect_set(F.struct("at", "n")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for text, found in zip(batch.column("t"), batch.column("spans"), strict=True):
                text, gone = text.as_py(), []
                if found.is_valid:
                    at, n = (found.values.field(c).to_numpy() for c in ("at", "n"))
                    at = at.astype(np.int64)
                    _, start, stop = joined_spans(np.zeros(len(at), np.int64), at, at + n)
                    gone = list(zip(start.tolist(), stop.tolist(), strict=True))
                    edges = [0, *(x for s in gone for x in s), len(text)]
                    text = b"".join([text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
                spans.append([{"start": x, "end": y} for x, y in gone])
                kept.append(text)
            size = pa.array([len(t) for t in batch.column("t").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "n_bytes": size,
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary())})

    unknown = rows.where(F.col("id").isNull()).select("id", "t", F.lit(None).alias("spans"))
    out = known.join(held, ["id", "th"], "left").select("id", "t", "spans").unionByName(unknown)
    return out.mapInArrow(
        cut, "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary") \
        .withColumnRenamed("id", id_col)
