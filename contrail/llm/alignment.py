"""Alignment of two tokenizers by byte offsets, over exact-text classes.

Texts are shuffled by their full text, so that each distinct text is tokenized
and aligned once, with the number of its documents as weight. The documents
that hold each linked id pair are then counted, the counts go back to the
texts, and the texts' measures are joined to the documents.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import cut_lineage
from .common import byte_level_alphabet, give_back, text_parts

AT_ONCE = 1 << 22     # characters of the texts that are aligned together
CHUNK = 1 << 16       # bytes of the words that are tokenized in one string
LONG_WORD = 512       # bytes; longer words are tokenized by themselves
# Fixed value: how byte-level vocabularies of this kind split texts
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
HEAD_PAIRS = 1 << 21  # id pairs, the most frequent ones, that are broadcast
_OWNER = 40           # bits of an id pair's code
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
# Bytes that begin a character which is surely neither white space nor a mark
_BEGINS = np.zeros(256, bool)
_BEGINS[[*range(0x21, 0x7F), *range(0xC3, 0xCC), *range(0xCE, 0xE1), *range(0xE4, 0xF5)]] = True


class ByteTokenizer:
    """Side A: a byte-level vocabulary; ``entries`` are its ids' bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_level_alphabet()
        found = {i: bytes(map(to_byte.__getitem__, s)) for s, i in spec["model"]["vocab"].items()}
        found |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.entries = [found.get(i, b"") for i in range(max(found) + 1)]
        # the same vocabulary in a second library, several times faster on short
        # words and quadratic in a word's length; it must agree on a few probes
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {e: i for i, e in enumerate(self.entries) if e and i not in special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        probes = ["The cat's 12,345 x\n\n  y...", "été 日本\u3000don't\t<|endoftext|>", "unbelievable aaaa"]
        if not spec["model"]["merges"] or self.short(probes) != self(probes):
            self.fast = None

    def short(self, texts: list[str]) -> list[list[int]]:
        """The same for texts without very long words."""
        if self.fast is None:
            return self(texts)
        return [self.fast.encode_ordinary(" " + t) for t in texts]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        coded = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [c.ids for c in coded]


class PieceTokenizer:
    """Side B: pieces with byte fallback; the model itself puts a space first."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) \
            else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass
class Aligned:
    """Texts aligned together: per text its measures and groups, and in order the
    codes of its links (A id * size of B + B id), from ``bounds[i]`` to
    ``bounds[i + 1]``."""

    measures: np.ndarray  # (texts, MEASURES)
    groups: list[str]
    codes: np.ndarray
    bounds: np.ndarray


def _order(group_a: np.ndarray, group_b: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens when each group's A tokens come before its B tokens."""
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    return (np.arange(len(group_a)) + (np.cumsum(in_b) - in_b)[group_a],
            np.arange(len(group_b)) + np.cumsum(in_a)[group_b])


def _upto(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def _taken(bounds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Indices of everything between the bounds of each of ``rows``, in order."""
    size = np.diff(bounds)[rows]
    return np.arange(size.sum()) + np.repeat(bounds[rows] - (np.cumsum(size) - size), size)


class Aligner:
    """Tokenizes whole strings and aligns them."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self.entries = self.a.entries, self.b.entries
        self.sizes = [np.array([len(x) for x in e]) for e in self.entries]
        n_a, n_b = map(len, self.entries)
        # an id as text, with what may follow it
        self.written = [f"{i}{end}" for i in range(n_a) for end in ",|"] \
            + [f"{i}{end}" for i in range(n_b) for end in (",", ";", "")]

    def __call__(self, texts: list[str]) -> Aligned:
        """``texts`` are neither null nor empty; one whose tokens' bytes are not a
        space and the text has no tokens."""
        ids = list(zip(self.a(texts), self.b(texts), strict=True))
        ids = [x if all(self._joined(i, e) == (" " + t).encode() for i, e in zip(x, self.entries, strict=True))
               else ([], []) for t, x in zip(texts, ids, strict=True)]
        a, b = (np.fromiter(chain.from_iterable(x[s] for x in ids), np.int64) for s in (0, 1))
        n_a = np.array([len(x[0]) for x in ids], np.int64)
        return self.between(a, b, np.append(0, np.cumsum(self.sizes[0][a]))[np.cumsum(n_a)])

    @staticmethod
    def _joined(ids: list[int], entries: list[bytes]) -> bytes:
        return b"".join(map(entries.__getitem__, ids))

    def words(self, words: list[bytes]) -> Aligned:
        """The same of words (as ``cut_words`` finds them, their space included).
        They are tokenized many in a string, where each is treated as by itself;
        strings that are not given back, or in which a token crosses words, are
        done again word by word."""
        size = np.array([len(w) for w in words], np.int64)
        ends, long = np.cumsum(size), size > LONG_WORD
        # behind a space a word would begin elsewhere; long words are alone
        cut = long | np.append(long[1:], True) | np.array([w[-1:] == b" " for w in words], bool)
        cut |= np.append(ends[:-1] // CHUNK != ends[1:] // CHUNK, True)
        edges = [0, *(np.flatnonzero(cut) + 1).tolist()]
        parts = [b"".join(words[x:y]) for x, y in zip(edges[:-1], edges[1:], strict=True)]
        texts = [p[1:].decode() for p in parts]
        alone = long[np.array(edges[:-1])].tolist()
        short = iter(self.a.short([t for t, x in zip(texts, alone, strict=True) if not x]))
        other = iter(self.a([t for t, x in zip(texts, alone, strict=True) if x]))
        a, b = [next(other if x else short) for x in alone], self.b(texts)
        if all(self._joined(i, e) == p for ids, e in zip((a, b), self.entries, strict=True)
               for i, p in zip(ids, parts, strict=True)):
            a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
            if all(np.isin(ends, np.cumsum(size[ids])).all() for ids, size in zip((a, b), self.sizes, strict=True)):
                return self.between(a, b, ends)
        return self([w[1:].decode() for w in words])

    def between(self, a: np.ndarray, b: np.ndarray, last: np.ndarray) -> Aligned:
        """Aligns ids of texts that end at the bytes ``last``, as tokens of both do."""
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        is_a, is_b = np.zeros((2, int(last[-1] if len(last) else 0) + 1), bool)
        is_a[end_a], is_b[end_b] = True, True
        # each stretch between neighbouring ends is the overlap of one pair
        ends, both = np.flatnonzero(is_a | is_b), np.flatnonzero(is_a & is_b)
        before_a, before_b = (np.cumsum(x) - x for x in (is_a, is_b))
        joint = np.cumsum(is_a & is_b) - (is_a & is_b)
        measures = np.stack([np.diff(np.searchsorted(x, last, side="right"), prepend=0)
                             for x in (end_a, end_b, both, ends)], axis=1)
        n_both = measures[:, 0] + measures[:, 1]
        return Aligned(measures, self._groups(a, b, joint[end_a], joint[end_b], _upto(n_both), len(both)),
                       a[before_a[ends]] * len(self.entries[1]) + b[before_b[ends]], _upto(measures[:, 3]))

    def _groups(self, a, b, group_a, group_b, bounds, n_groups) -> list[str]:
        place_a, place_b = _order(group_a, group_b, n_groups)
        words = np.empty(len(a) + len(b), np.int64)
        words[place_a] = 2 * a + np.append(np.diff(group_a) > 0, True)[:len(a)]
        end_b = np.append(np.diff(group_b) > 0, True)[:len(b)].astype(np.int64)
        end_b[np.isin(place_b, bounds - 1)] = 2
        words[place_b] = 2 * len(self.entries[0]) + 3 * b + end_b
        get, words = self.written.__getitem__, words.tolist()
        return ["".join(map(get, words[x:y])) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def cut_words(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where words begin in texts that begin at ``starts``: at a single space
    before a character that is no white space. Neither tokenizer joins what
    stands on both sides of such a place: A splits there, and no piece of B has
    a space behind another character."""
    begins = np.zeros(len(data), bool)
    begins[1:-1] = (data[1:-1] == 0x20) & (data[:-2] != 0x20) & _BEGINS[data[2:]]
    begins[starts] = True
    return np.flatnonzero(begins)


class WordAligner:
    """Aligns texts word by word. Both tokenizers treat a word alike wherever it
    stands, and words repeat far more than they differ: Arrow numbers the
    distinct words of the texts, each is tokenized and aligned once, and a text
    is put together from its words. Made once in a task; it keeps no texts."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.align = Aligner(path_a, path_b)
        pieces = (b.lstrip(b" ") for b in self.align.entries[1])
        self.by_word = not any(b" " in p for p in pieces)

    def __call__(self, texts: list[str]) -> Aligned:
        if not self.by_word:
            return self.align(texts)
        raw, n = [b" " + t.encode() for t in texts], len(texts)
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = _upto(np.array([len(r) for r in raw]))[:-1]
        cuts = cut_words(data, starts)
        coded = pa.Array.from_buffers(pa.binary(), len(cuts), [
            None, pa.py_buffer(np.append(cuts, len(data)).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        found = self.align.words(coded.dictionary.to_pylist())
        word = coded.indices.to_numpy()
        first = np.searchsorted(cuts, starts)
        owner = np.repeat(np.arange(n), np.diff(np.append(first, len(cuts))))
        measures = found.measures[word]
        # a word that its tokens do not give back: the text decides as a whole
        odd = np.unique(owner[measures[:, 0] == 0])
        sums = np.add.reduceat(measures, first, axis=0) if n else measures
        bounds = np.append(first, len(cuts)).tolist()
        strings = list(map(found.groups.__getitem__, word.tolist()))
        groups = [";".join(strings[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        codes = found.codes[_taken(found.bounds, word)]
        if not len(odd):
            return Aligned(sums, groups, codes, _upto(sums[:, 3]))
        owner = np.repeat(np.arange(n), sums[:, 3])
        whole = self.align([texts[i] for i in odd])
        sums[odd] = whole.measures
        for i, g in zip(odd.tolist(), whole.groups, strict=True):
            groups[i] = g
        kept = ~np.isin(owner, odd)
        owner = np.append(owner[kept], np.repeat(odd, whole.measures[:, 3]))
        by = np.argsort(owner, kind="stable")
        return Aligned(sums, groups, np.append(codes[kept], whole.codes)[by], _upto(sums[:, 3]))


def _counted(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of each text, ascending, their occurrences, and bounds."""
    owner = np.repeat(np.arange(len(found.groups)), np.diff(found.bounds))
    keys = np.sort((owner << _OWNER) | found.codes)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    times, keys = np.diff(np.append(first, len(keys))), keys[first]
    return keys & ((1 << _OWNER) - 1), times, np.searchsorted(keys >> _OWNER, np.arange(len(found.groups) + 1))


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values between each two bounds as binary."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def aligned_texts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text",
                  with_groups: bool = False) -> DataFrame:
    """One row per distinct text that is not empty: ``key`` (its SHA-256),
    ``weight`` (its rows), the four counts, ``groups_sha256`` ('' without
    tokens), with ``with_groups`` the ``groups`` themselves, and its distinct
    linked pairs: differences of ascending codes and occurrences, as
    little-endian 64- and 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = WordAligner(path_a, path_b)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for lo, hi in text_parts(list(map(len, texts)), AT_ONCE):
                found = align(texts[lo:hi])
                codes, times, bounds = _counted(found)
                step = np.diff(codes, prepend=0)
                step[bounds[:-1][bounds[:-1] < len(codes)]] = codes[bounds[:-1][bounds[:-1] < len(codes)]]
                rows = {c: batch.column(c).slice(lo, hi - lo) for c in ("key", "weight")}
                rows |= {c: pa.array(np.ascontiguousarray(found.measures[:, j])) for j, c in enumerate(MEASURES)}
                rows["groups_sha256"] = pa.array(
                    [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups])
                if with_groups:
                    rows["groups"] = pa.array(found.groups)
                rows["codes"] = _blobs(step.astype("<i8"), bounds)
                rows["occurrences"] = _blobs(times.astype("<i4"), bounds)
                yield pa.RecordBatch.from_pydict(rows)
        give_back()

    texts = (docs.select(F.col(text_col).alias("t")).where("t <> ''")
             .groupBy("t").agg(F.count("*").alias("weight"))
             .select(F.unhex(F.sha2("t", 256)).alias("key"), "weight", "t"))
    kinds = ", ".join(f"{c} long" for c in ("weight", *MEASURES))
    return texts.mapInArrow(run, f"key binary, {kinds}, groups_sha256 string, "
                            f"{'groups string, ' if with_groups else ''}codes binary, occurrences binary")


def _codes(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    held = [np.cumsum(np.frombuffer(x, "<i8")) for x in column.to_pylist()]
    return held, np.array([len(x) for x in held], np.int64)


def pair_counts(texts: DataFrame, size_b: int) -> DataFrame:
    """(code, a, b, count, best): the number of documents that hold each linked
    pair, and whether no pair of the same A id has more. Each batch adds up its
    texts before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = _codes(batch.column("codes"))
            if n.sum():
                codes, at = np.unique(np.concatenate(held), return_inverse=True)
                sums = np.zeros(len(codes), np.int64)
                np.add.at(sums, at, np.repeat(batch.column("weight").to_numpy(), n))
                yield pa.RecordBatch.from_pydict({"code": pa.array(codes), "n": pa.array(sums)})

    counts = (texts.select("codes", "weight").mapInArrow(run, "code long, n long")
              .groupBy("code").agg(F.sum("n").alias("count"))
              .select("code", F.expr(f"code div {size_b}").alias("a"),
                      F.expr(f"code % {size_b}").alias("b"), "count"))
    of_a = Window.partitionBy("a")  # as many rows as the other vocabulary has ids at most
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def _head(counts: DataFrame, rows: int) -> tuple[int, int]:
    """The least power of two that at most ``rows`` pairs have as count or more,
    and how many pairs have less."""
    power = F.length(F.bin("count")) - 1
    sizes = sorted(((r["p"], r["n"]) for r in counts.groupBy(power.alias("p"))
                    .agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held, total = (sizes[0][0] + 1 if sizes else 0), 0, sum(n for _, n in sizes)
    for p, n in sizes:
        if held + n > rows:
            break
        least, held = p, held + n
    return 1 << least, total - held


def text_measures(texts: DataFrame, counts: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(key, n_best, count_sum) of every text that has links.

    At most ``head_pairs`` of the most frequent pairs are broadcast; links to
    rarer pairs meet their counts in a shuffle, which none of them can skew."""
    least, rest = _head(counts, head_pairs)
    head = counts.where(F.col("count") >= least).select("code", "count", "best").toArrow().sort_by("code")
    sent = texts.sparkSession.sparkContext.broadcast(
        tuple(head.column(c).to_numpy() for c in ("code", "count", "best")))

    def known(batch: pa.RecordBatch):
        codes, counted, best = sent.value
        held, n = _codes(batch.column("codes"))
        code = np.concatenate([*held, np.zeros(0, np.int64)])
        times = np.frombuffer(b"".join(batch.column("occurrences").to_pylist()), "<i4").astype(np.int64)
        at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
        hit = codes[at] == code if len(codes) else np.zeros(len(code), bool)
        return np.repeat(np.arange(len(held)), n), code, times, at, hit, counted, best

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, _, times, at, hit, counted, best = known(batch)
            sums = np.zeros((2, batch.num_rows), np.int64)
            if len(counted):
                np.add.at(sums[0], owner, times * (hit & best[at]))
                np.add.at(sums[1], owner, times * np.where(hit, counted[at], 0))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "n_best": pa.array(sums[0]),
                                              "count_sum": pa.array(sums[1])})

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, code, times, _, hit, _, _ = known(batch)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key").take(pa.array(owner[~hit])),
                                              "code": pa.array(code[~hit]), "times": pa.array(times[~hit])})

    links = texts.select("key", "codes", "occurrences")
    out = links.mapInArrow(near, "key binary, n_best long, count_sum long")
    if not rest:
        return out
    rare = counts.where(F.col("count") < least).select("code", "count", "best")
    more = links.mapInArrow(far, "key binary, code long, times long").join(rare, "code")
    more = more.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return out.unionByName(more).groupBy("key").agg(F.sum("n_best").alias("n_best"),
                                                    F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                    text_col: str = "text", head_pairs: int = HEAD_PAIRS,
                    with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_a`` and ``n_b`` (tokens),
    ``n_groups`` (stretches between offsets where tokens of both end),
    ``n_links`` (pairs of tokens whose bytes overlap), ``n_best`` (links whose
    pair is held by as many documents as any pair of its A id), ``count_sum``
    (documents of a link's pair, added over the links) and ``groups_sha256``;
    with ``with_groups`` the ``groups``, such as ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and those that a tokenizer does not give back byte by
    byte, have zeros and ''. Repeated rows are documents each, and a null id
    stays null. No rows give no rows; other columns are not read."""
    texts = cut_lineage(aligned_texts(docs, path_a, path_b, text_col, with_groups), "aligned")
    counts = cut_lineage(pair_counts(texts, len(PieceTokenizer(path_b).entries)), "pairs")
    sums = text_measures(texts, counts, head_pairs)
    words = ["groups_sha256", *(["groups"] if with_groups else [])]
    found = texts.select("key", *MEASURES, *words).join(sums, "key", "left")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text_col, 256)).alias("key"))
    zero = F.lit(0).cast("long")
    return rows.join(found, "key", "left").select(
        F.col("id").alias(id_col),
        *[F.coalesce(c, zero).alias(c) for c in (*MEASURES, "n_best", "count_sum")],
        *[F.coalesce(c, F.lit("")).alias(c) for c in words])
