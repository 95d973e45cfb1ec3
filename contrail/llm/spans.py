"""Substring duplicates by sliding sentence spans.

Every run of several consecutive sentences is hashed, the hashes meet in one
join over the whole corpus, and the sentences that a repeat covers go; the
first occurrence of a run stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import document_ranks, first_of_batch, joined_spans

SENTENCES = 3   # a run has this many sentences at least
WORDS = 12      # and this many words at least, so that chance does not repeat it
ENOUGH = 18     # words of a run of fewer sentences, or with parts of a cut sentence
LONGEST = 16    # a sentence of more words is cut
WINDOW = 8      # words of a long sentence among which one cut at least is found
# scripts without spaces: two of their characters count as a word
_BARE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf" \
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_BARE}]")
_WORD = re.compile(r"\S+")
_UNIT = re.compile(rf"[{_BARE}]|[^\s{_BARE}]+")
# the marks of other scripts end a sentence without white space too
_END = re.compile("(?:[.!?]+(?=\\s)|[\u3002\uff01\uff1f\uff0e\uff61\u2026\u061f\u06d4\u0964\u0965\u0589\u1362"
                  "\u1367\u104a\u104b\u17d4\u17d5\u0f0d\u0f0e]+[\u300d\u300f\u201d\u2019\uff09]*|\n)\\s*")
_K = np.uint64(0x9E3779B97F4A7C15)


def _weights(words: list[str]) -> list[int]:
    return [1 if _UNSPACED.match(w) else 2 for w in words]


def _weight(text: str, bare: bool) -> int:
    """Twice the number of words."""
    return sum(_weights(_UNIT.findall(text))) if bare else 2 * len(text.split())


def _lasts(weights: list[int], most: int) -> list[int]:
    """Per word, where the longest row of words of ``most`` weight from it ends."""
    out, end, held = [], 0, 0
    for w in weights:
        while end < len(weights) and held + weights[end] <= most:
            held += weights[end]
            end += 1
        out.append(end)
        held -= w
    return out


def _cuts(text: str, long: list[tuple[int, int]], bare: bool) -> list[list[int]]:
    """Where the long sentences of a text are cut: before the words that have
    the one least hash, of themselves and the word before, among ``WINDOW``
    words in a row. The same words are so cut alike wherever they stand. Where
    hashes tie over more than ``LONGEST`` words, the last of the least ones
    there is taken."""
    starts, words, sizes = [], [], []
    for a, b in long:
        part = text[a:b]
        own = part.split()
        if not bare and part.startswith(" ".join(own)):
            starts += accumulate((len(w) + 1 for w in own[:-1]), initial=a)
        else:
            starts += [m.start() for m in (_UNIT if bare else _WORD).finditer(text, a, b)]
        words += _UNIT.findall(part.lower()) if bare else part.lower().split()
        sizes.append(len(starts))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    score = h[:-1] * _K + h[1:]  # score[i] stands between words i and i + 1
    score = (score ^ (score >> np.uint64(32))) * _K
    places = [[] for _ in long]
    if not bare:
        owner = np.repeat(np.arange(len(long)), np.diff([0, *sizes]))
        rows = np.lib.stride_tricks.sliding_window_view(score, WINDOW)
        least = rows.argmin(axis=1)
        one = (least == WINDOW - 1 - rows[:, ::-1].argmin(axis=1)) & (owner[WINDOW:] == owner[:-WINDOW])
        for p in np.unique((np.arange(len(rows)) + least)[one] + 1).tolist():
            places[owner[p]].append(p)
    weights = _weights(words) if bare else [2] * len(words)
    upto = list(accumulate(weights, initial=0))
    first, out = 0, []
    for k, end in enumerate(sizes):
        if bare:
            found = set()
            for i, e in enumerate(_lasts(weights[first:end], 2 * WINDOW), first):
                if e + first >= end:
                    break
                row = score[i:e + first].tolist()
                if row.count(least := min(row)) == 1:
                    found.add(i + row.index(least) + 1)
            places[k] = sorted(found)
        cuts, last = [], first
        for p in [*places[k], end]:
            while p - last > LONGEST and upto[p] - upto[last] > 2 * LONGEST:
                # where the longest row of words of that weight ends
                top = bisect_right(upto, upto[last] + 2 * LONGEST, last, p) - 1
                last = min(range(last + 1, top + 1), key=lambda j: (score[j - 1], -j))
                cuts.append(last)
            if p < end:
                cuts.append(p)
            last = p
        out.append([starts[p] for p in cuts])
        first = end
    return out


def _pieces(text: str | None, bare: bool) -> list[tuple[int, int, bool, bool]]:
    """(start, end, whether part of a cut sentence, whether a sentence starts
    there); see ``sentences``."""
    ends = [m.end() for m in _END.finditer(text or "")]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    whole = list(pairwise([0, *ends]))
    # shorter ones cannot hold that many words
    long = [(a, b) for a, b in whole
            if b - a > 2 * LONGEST and _weight(text[a:b], bare) > 2 * LONGEST]
    if not long:
        return [(a, b, False, True) for a, b in whole]
    cuts = dict(zip(long, _cuts(text, long, bare), strict=True))
    return [(x, y, (a, b) in cuts, x == a) for a, b in whole
            for x, y in pairwise([a, *cuts.get((a, b), ()), b])]


def _bare(text: str | None) -> bool:
    return bool(text) and not text.isascii() and _UNSPACED.search(text) is not None


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the sentences, which together make up the text. A
    sentence ends after . ! ? and white space, after the full stops of other
    scripts, or at a line's end; one of more than ``LONGEST`` words is cut at
    places that its words determine."""
    return [(a, b) for a, b, _, _ in _pieces(text, _bare(text))]


def runs(text: str | None) -> tuple[list[tuple[int, int]], list[bytes]]:
    """(first sentence, sentence after the last) and 128-bit hash of the shortest run
    from each sentence on that has ``SENTENCES`` and ``WORDS`` (``ENOUGH`` words
    if a cut sentence is part of it), and of the shortest of fewer sentences
    that has ``ENOUGH`` words; and of the shortest with a part of a cut sentence
    that ends where a sentence does. Case and white space are folded.

    Of a passage of 50 words that two texts share, at most 16 at either end can
    be cut differently; the 18 between are a run in both."""
    bare = _bare(text)
    pieces = _pieces(text, bare)
    if len(pieces) < 2:
        return [], []
    joined = [" ".join(text[a:b].lower().split()) for a, b, _, _ in pieces]
    sizes = [_weight(x, True) if bare else 2 * (x.count(" ") + 1) if x else 0 for x in joined]
    n = len(pieces)
    at, size = np.arange(n), np.cumsum([0, *sizes])
    parts = np.cumsum([0, *(cut for _, _, cut, _ in pieces)])

    def until(words):
        return np.searchsorted(size, size[:-1] + 2 * words)

    enough = until(ENOUGH)
    full = np.maximum(until(WORDS), at + SENTENCES)
    held_cut = parts[np.minimum(full, n)] > parts[:-1]
    full = np.where(held_cut, np.maximum(enough, at + SENTENCES), full)
    fewer = (enough - at < SENTENCES) & (enough <= n)
    # a run is left out where the shorter ones from its first two sentences cover it
    covered = fewer & np.append(fewer[1:], False) & (full == np.append(enough[1:], n + 1))
    found = {*zip(at[fewer].tolist(), enough[fewer].tolist(), strict=True)}
    whole = (full <= n) & ~covered
    found.update(zip(at[whole].tolist(), full[whole].tolist(), strict=True))
    # runs from cut sentences on must reach the end of each sentence
    last = np.array([e + 1 for e in range(n) if not pieces[e][2] or e + 1 == n
                     or not pieces[e + 1][2] or pieces[e + 1][3]], np.int64)
    first = np.searchsorted(size, size[last] - 2 * ENOUGH, side="right") - 1
    tail = first >= 0
    tail[tail] = parts[last[tail]] > parts[first[tail]]
    found.update(zip(first[tail].tolist(), last[tail].tolist(), strict=True))
    found = sorted(found)
    return found, [xxhash.xxh3_128_digest("\x1f".join(joined[i:e])) for i, e in found]


def repeated(docs: DataFrame) -> DataFrame:
    """(id, th, at, n): the runs of sentences whose first occurrence, by id, text
    hash and place, is elsewhere.

    Of equal runs in a batch only the first is shuffled; the others are repeats
    for certain and come joined, with a null h2. One window over the hashes then
    finds the first place of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = (b.column(c).to_numpy() for c in ("id", "th"))
            found = [runs(t) for t in b.column("t").to_pylist()]
            text = np.repeat(np.arange(len(ids)), [len(x) for x, _ in found])
            ends = np.array([x for rows, _ in found for x in rows], np.int64).reshape(-1, 2)
            h = np.frombuffer(b"".join(x for _, rows in found for x in rows), "<i8").reshape(-1, 2)
            by, new, again = first_of_batch(h[:, 0], h[:, 1], (document_ranks(ids, th)[text] << 32) + ends[:, 0])
            text, ends, h = text[by], ends[by], h[by]
            own, start, stop = joined_spans(text[again], ends[again, 0], ends[again, 1])
            rows = np.append(text[new], own)
            yield pa.RecordBatch.from_pydict({
                "h1": pa.array(np.append(h[new, 0], (own * 40503 + start) * 2654435761)),
                "h2": pa.array(np.append(h[new, 1], own),
                               mask=np.append(np.zeros(new.sum(), bool), np.ones(len(own), bool))),
                "id": pa.array(ids[rows]), "th": pa.array(th[rows]),
                "at": pa.array(np.append(ends[new, 0], start).astype(np.int32)),
                "n": pa.array(np.append(ends[new, 1] - ends[new, 0], stop - start).astype(np.int32))})

    spans = docs.where("id is not null and t is not null").mapInArrow(
        run, "h1 long, h2 long, id long, th int, at int, n int")
    place = F.struct("id", "th", "at")
    first = F.min(place).over(Window.partitionBy("h1", "h2"))
    return (spans.repartition("h1", "h2").withColumn("first", first)
            .where(F.col("h2").isNull() | (F.col("first") != place)).select("id", "th", "at", "n"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_sentences``, ``n_removed`` and
    the ``text`` without the sentences that a non-first repeated run covers.

    A repeat inside one text counts as well. Texts without a run (of three
    sentences and ``WORDS``, or of ``ENOUGH`` words in two pieces or more) stay
    as they are, like null and empty ones (null stays null). Rows with a null id take no part. Rows equal
    in id and text are one document, with the same answer each. No rows give no
    rows; other columns are not read."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, found in zip(b["t"], b["runs"], strict=True):
                parts = sentences(text)
                gone = {j for x in found for j in range(x["at"], x["at"] + x["n"])} \
                    if found is not None else set()
                if gone:
                    text = "".join(text[s:e] for j, (s, e) in enumerate(parts) if j not in gone)
                rows.append((len(parts), len(gone), text))
            yield pd.concat([b[["id"]], pd.DataFrame(
                rows, columns=["n_sentences", "n_removed", "text"], index=b.index)], axis=1)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.hash(text_col).alias("th"),
                        F.col(text_col).alias("t"))
    # a set: it is bounded by the document's own sentences however often rows repeat
    found = repeated(texts).groupBy("id", "th").agg(F.collect_set(F.struct("at", "n")).alias("runs"))
    out = texts.join(found, ["id", "th"], "left").select("id", "t", "runs")
    return out.mapInPandas(cut, "id long, n_sentences long, n_removed long, text string") \
        .withColumnRenamed("id", id_col)
