"""Language identification by language-bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: every slot holds a bit per
language, and the AND of a gram's slots is the mask of all languages that
contain it. Per-language popcounts over a text's grams, corrected for the
filter's false positives, decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import give_back, held_out, text_slices

MIN_SHARE = 0.01  # a language contains a gram that this share of its texts has
FEW_TEXTS = 10  # a language of fewer texts contains every gram of theirs, others what two texts have
HASHES = 3
UNKNOWN = "und"
_NON_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def grams(text: str) -> Iterator[np.ndarray]:
    """Character trigrams of the lower-cased words, with a border on both
    sides of each word, as 63-bit numbers; slice by slice, over whole texts."""
    for piece in text_slices(text):
        words = f" {_NON_LETTERS.sub(' ', piece.lower()).strip()} "
        a = np.frombuffer(words.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        if len(a) > 2:
            g = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
            yield g[a[1:-1] != 32]


def slots(g: np.ndarray, bits: int) -> list[np.ndarray]:
    """The gram's ``HASHES`` slots among 2 ** bits."""
    u = g.astype(np.uint64)
    u = u ^ (u >> np.uint64(29))
    return [((u * np.uint64(a)) >> np.uint64(64 - bits)).astype(np.int64) for a in _ODD[:HASHES]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, df): in how many texts of a language each gram occurs;
    gram -1 counts the texts themselves. Summed inside each partition first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list] = {}
        held = 0

        def total(parts):
            keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([c for _, c in parts]),
                                     len(keys)).astype(np.int64)
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                own = np.unique(np.concatenate([np.array([-1]), *grams(text or "")]))
                seen.setdefault(lang, []).append((own, np.ones(len(own), np.int64)))
                held += len(own)
                if held > 2_000_000:
                    seen = {k: [total(v)] for k, v in seen.items()}
                    held = 0
        for lang, parts in seen.items():
            keys, n = total(parts)
            yield pd.DataFrame({"lang": lang, "gram": keys, "df": n})
        give_back()

    return (docs.select("lang", "text").mapInPandas(run, "lang string, gram long, df long")
            .groupBy("lang", "gram").agg(F.sum("df").alias("df")))


class Filter:
    """Languages in order, the slot table (slots x words of 64 languages) and
    each language's false-positive rate."""

    def __init__(self, langs: list[str], table: np.ndarray, bits: int) -> None:
        self.langs, self.table, self.bits = langs, table, bits
        fill = np.array([np.mean((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1))
                         for i in range(len(langs))])
        self.false = fill ** HASHES

    def hits(self, text: str) -> tuple[np.ndarray, int]:
        """Per language, how many of the text's grams its filter returns; and
        the number of grams."""
        count, n = np.zeros(len(self.langs)), 0
        for g in grams(text):
            at = slots(g, self.bits)
            mask = self.table[at[0]]
            for s in at[1:]:
                mask &= self.table[s]
            count += [np.count_nonzero(mask[:, i // 64] & np.uint64(1 << (i % 64)))
                      for i in range(len(self.langs))]
            n += len(g)
        return count, n

    def decide(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0
        count, n = self.hits(text)
        if not n:
            return UNKNOWN, 0.0
        share = np.clip((count / n - self.false) / (1 - np.minimum(self.false, 0.999)), 0, 1)
        best = int(np.argmax(share))  # ties: the first language in order
        return self.langs[best], float(share[best])


def learn(docs: DataFrame) -> Filter:
    """Fit the filter on the rows of ``docs`` that have a language. What comes
    to the driver is the slot table alone. Its size is bounded whatever the
    corpus: grams that a hundredth of a language's texts have number at most a
    hundred times the mean distinct grams of a text."""
    counts = cut_lineage(gram_counts(docs.where(F.col("lang").isNotNull())), "grams")
    texts = counts.where("gram = -1").select("lang", F.col("df").alias("texts"))
    kept = (counts.where("gram <> -1").join(F.broadcast(texts), "lang")  # a row per language
            .where(F.col("df") >= F.greatest(F.when(F.col("texts") < FEW_TEXTS, 1).otherwise(2),
                                             F.ceil(F.col("texts") * MIN_SHARE)))
            .select("lang", "gram"))
    sizes = {r["lang"]: r["n"] for r in
             texts.join(kept.groupBy("lang").agg(F.count("*").alias("n")), "lang", "left")
             .select("lang", F.coalesce("n", F.lit(0)).alias("n")).collect()}
    langs = sorted(sizes)
    bits = max(12, int(np.ceil(np.log2(8 * HASHES * max([1, *sizes.values()])))))
    words = (len(langs) + 63) // 64 or 1
    table = np.zeros((1 << bits, words), dtype=np.uint64)
    place = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            i = b["lang"].map(place).to_numpy(np.int64)
            for s in slots(b["gram"].to_numpy(np.int64), bits):
                yield pd.DataFrame({"slot": s, "word": i // 64, "bit": i % 64})

    marked = (kept.mapInPandas(run, "slot long, word long, bit int").groupBy("slot", "word")
              .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
              .toPandas())
    table[marked["slot"], marked["word"]] = marked["mask"].to_numpy(np.int64).view(np.uint64)
    return Filter(langs, table, bits)


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the share of the text's grams
    that the language contains, 0 to 1), replacing columns of these names.
    ``und`` and 0 where the text is null or has no letter, or where no language
    was learned. Only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.decide(t) for t in texts], columns=["lang_pred", "score"])
        give_back()

    out = docs.drop("lang_pred", "score").withColumn("_lid", decide(F.col("text")))
    return out.select(*[c for c in out.columns if c != "_lid"], "_lid.lang_pred", "_lid.score")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the texts and languages outside the held-out fold (crc32 of
    doc_id modulo 4 is 2) and predict every row: doc_id, held_out, lang_pred,
    score. A null doc_id is in no held-out fold. No rows give no rows."""
    rows = docs.select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    model = learn(rows.where(~F.col("held_out")))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
