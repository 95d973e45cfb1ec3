"""Packing: concatenate and cut.

Pass one tokenizes every text once and writes the ids with each row's running
token count inside its partition. The partitions' totals, summed in order, give
global offsets. Pass two cuts the one long stream into fixed windows; a
document that crosses a window's border gets one boundary record per window.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import cut_lineage
from .common import byte_level_alphabet, give_back, prefix_offsets, text_parts

SEQUENCE = 4096
AT_ONCE = 4 << 20  # characters of texts that are split into words together
KEPT = 100_000     # parts of words whose ids a task keeps, about 20 MB
LONG_PART = 64     # characters; ids of longer parts are not kept
# Kinds of bytes: 1 letters, 2 digits, 3 punctuation; 0 for all that plain rules do
# not cover (other scripts, controls, what begins a contraction or a special token)
_KIND = np.zeros(256, np.int8)
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x61:0x7B] = 1
_KIND[[0x27, 0x3C]] = 0
_KIND[0x80:0xC0] = 1            # letters from U+00C0 to U+017F: what follows the first byte
_KIND[[0xC3, 0xC4, 0xC5]] = 1   # and the first byte
# No letters there, and one whose lower case is two characters
_NO_LETTERS = (0xC397, 0xC3B7, 0xC4B0)


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are ordinary text
    return tokenizer


def _taken(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices first, first + 1, ... of each run of ``size``, one after the other."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


class WordIds:
    """Ids of texts by a tokenizer that drops white space, ignores case and splits
    letters, single digits and punctuation from each other. Words repeat far more
    than they differ, and their parts more still: Arrow splits texts and numbers
    the distinct words, then these words' distinct parts. Parts go to the
    tokenizer's model, and the ids of all words are taken by number. Words that
    plain rules do not cover are encoded one by one, and so are all words of a
    tokenizer that does otherwise with a few probes. Made once in a task."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.known: dict[bytes, bytes] = {}
        self.alphabet = {b: c for c, b in byte_level_alphabet().items()}
        self.by_part = True
        probes = pa.array(["the", "them.", "12,3a", "c3p0...!?1", "étés,x", "(a-b)", "$9"])
        plain = self.words(probes)[0].tolist()
        self.by_part = plain == np.concatenate(self._encode(probes.to_pylist())).tolist()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _part_ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of distinct parts, from the model: of normalizer and splitter they
        need lower case and the byte-level alphabet."""
        merge, out = self.tokenizer.model.tokenize, []
        if len(self.known) > KEPT:
            self.known = {}
        for part in parts:
            ids = self.known.get(part)
            if ids is None:
                text = part.decode().lower()
                if not text.isascii():
                    text = "".join(map(self.alphabet.__getitem__, text.encode()))
                ids = array("I", [x.id for x in merge(text)]).tobytes()
                if len(part) <= LONG_PART:
                    self.known[part] = ids
            out.append(ids)
        return out

    def _by_part(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of plain words that lie in ``data``
        one after the other."""
        kind = _KIND[data]
        starts = (kind == 2) | np.append(True, kind[1:] != kind[:-1])
        starts[first] = True
        at = np.flatnonzero(starts)
        coded = pa.Array.from_buffers(pa.binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        ids = self._part_ids(coded.dictionary.to_pylist())
        own = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        part = coded.indices.to_numpy()
        flat = np.frombuffer(b"".join(ids), np.uint32)[_taken((np.cumsum(own) - own)[part], own[part])]
        return flat, np.add.reduceat(own[part], np.searchsorted(at, first))

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, number) of the ids of distinct words."""
        raw = words.cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        size = np.diff(offsets)
        odd = _KIND[data] == 0
        pair = (data[:-1].astype(np.int32) << 8) | data[1:]
        odd[:-1] |= np.isin(pair, _NO_LETTERS)
        strange = np.append(0, np.cumsum(odd))
        plain = (size > 0) & (strange[offsets[1:]] == strange[offsets[:-1]]) & self.by_part
        number, ids = np.zeros(len(words), np.int64), []
        if plain.any():
            own = size[plain]
            found, number[plain] = self._by_part(data[_taken(offsets[:-1][plain], own)], np.cumsum(own) - own)
            ids.append(found)
        rest = np.flatnonzero(~plain & (size > 0))
        single = self._encode(words.take(pa.array(rest)).to_pylist())
        number[rest] = [len(x) for x in single]
        order = np.append(np.flatnonzero(plain), rest)
        first = np.zeros(len(words), np.int64)
        first[order] = np.cumsum(number[order]) - number[order]
        return np.concatenate([*ids, *single, np.zeros(0, np.uint32)]), first, number

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's end."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        coded = split.flatten().dictionary_encode()
        if not len(coded):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        flat, first, number = self.words(coded.dictionary)
        place = coded.indices.to_numpy()
        size = number[place]
        return flat[_taken(first[place], size)], np.append(0, np.cumsum(size))[ends]

    def __call__(self, text: str) -> bytes:
        return self.batch(pa.array([text]))[0].astype("<u4").tobytes()


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n`` ids as little-endian unsigned
    32-bit ``ids`` (the end id last; a null or empty text has that id alone),
    and where they start in the stream of partition ``part``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = WordIds(tokenizer_path)
        end = np.array([end_id], "<u4")
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = b.column("t").fill_null("")
            for lo, hi in text_parts(pc.binary_length(texts).to_pylist(), AT_ONCE):
                ids, upto = code.batch(texts.slice(lo, hi - lo))
                ids = np.insert(ids.astype("<u4", copy=False), upto, end)  # behind each text
                ends = upto + np.arange(1, len(upto) + 1)
                n = np.diff(ends, prepend=0)
                raw = pa.Array.from_buffers(pa.binary(), len(n), [
                    None, pa.py_buffer((np.append(0, ends) * 4).astype(np.int32)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_pydict({
                    "id": b.column("id").slice(lo, hi - lo), "part": pa.array(np.full(len(n), part, np.int32)),
                    "in_part": pa.array(ends - n + at), "n": pa.array(n), "ids": raw})
                at += int(ends[-1])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"id {kind}, part int, in_part long, n long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack all texts into sequences of ``sequence`` ids; only the last one can
    be shorter. One row per piece: the document's id, ``start`` (its ids before
    the piece), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset`` there, and with ``with_ids`` the ids themselves.

    Null and empty texts are packed as their end id alone, repeated rows each
    on their own, a null id stays null; an empty table gives no rows. Other
    columns of ``docs``, whatever their names, are not read."""
    coded = cut_lineage(tokenize(docs, tokenizer_path, end_id, id_col, text_col), "ids")
    offsets = prefix_offsets(coded.groupBy("part").agg(F.sum("n").alias("total")),
                             "part", "total", "base")
    # one small row per task of pass one, so it may be broadcast and no ids are shuffled
    rows = coded.join(F.broadcast(offsets), "part").withColumn("at", F.col("base") + F.col("in_part"))

    def piece(s):
        lo = F.greatest(F.col("at"), s * sequence)
        hi = F.least(F.col("at") + F.col("n"), (s + 1) * sequence)
        own = F.substring(F.col("ids"), ((lo - F.col("at")) * 4 + 1).cast("int"),
                          ((hi - lo) * 4).cast("int"))
        cols = [(lo - F.col("at")).alias("start"), (hi - lo).alias("length"),
                F.crc32(own).alias("ids_crc32"), s.alias("sequence_id"),
                (lo - s * sequence).alias("offset")]
        return F.struct(*cols, *([own.alias("ids")] if with_ids else []))

    first = F.floor(F.col("at") / sequence)
    last = F.floor((F.col("at") + F.col("n") - 1) / sequence)
    # the pieces are made inside the array: exploding copies no whole document
    made = rows.select("id", F.col("n").alias("doc_tokens"),
                       F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    return made.select(F.col("id").alias(id_col), "p.start", "p.length", "p.ids_crc32",
                       "doc_tokens", "p.sequence_id", "p.offset",
                       *(["p.ids"] if with_ids else []))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences of ``pack(..., with_ids=True)``: one row per
    ``sequence_id`` with its ids. A group holds one window, never more."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
        .alias("ids"))
