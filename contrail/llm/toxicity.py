"""Toxicity by a subsequence string kernel with Nystrom landmarks.

Units of text (words, spelled-out letters joined) are compared by their common
subsequences of three letters, each weighted down by the length it spans, so
that gaps and inserted letters cost little. A support vector machine over the
landmarks' kernel map is trained on labelled sentences. A text's score comes
from its worst units.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import held_out, text_slices

LABELLED = 30_000     # documents that are learned from at most, in hash order
LANDMARKS = 256
UNITS = 6_000         # training units of either class at most
DECAY = 0.6           # weight of each letter that a subsequence spans
SPAN = 5              # letters that a subsequence spans at most
TOXIC = 0.5
CACHE = 400_000
_SPELLED = regex.compile(r"(?<!\S)(?:\p{L}[\s.\-_*]{1,2}){3,}\p{L}(?!\p{L})")
_GAPS = frozenset(" \t\n\r\x0b\x0c.-_*")
_INNER = regex.compile(r"[^\p{L}]+")
_SENTENCE = regex.compile(r"[.!?]+\s+|\n+")
_OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def units(text: str) -> list[str]:
    """The lower-case letters of each word; letters spelled apart are joined."""
    text = _SPELLED.sub(lambda m: " " + _INNER.sub("", m[0]) + " ", text.lower())
    return [w if w.isalpha() else _INNER.sub("", w) for w in text.split()]


def unit_slices(text: str) -> Iterator[str]:
    """Slices of a whole text. Letters spelled apart at the end of one go on into
    the next, so that no spelled word is cut."""
    kept = ""
    for piece in text_slices(text):
        piece, at = kept + piece, len(kept) + len(piece)
        while True:  # back over single letters and one or two marks behind each
            gap = at
            while gap > 0 and at - gap < 2 and piece[gap - 1] in _GAPS:
                gap -= 1
            if gap == at or gap == 0 or not piece[gap - 1].isalpha() or \
                    (gap > 1 and piece[gap - 2] not in _GAPS):
                break
            at = gap - 1
        while 0 < at < len(piece) and not piece[at - 1].isspace():
            at += 1  # a spelled word begins behind white space
        yield piece[:at]
        kept = piece[at:]
    if kept:
        yield kept


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, subsequence, weight) of all three-letter subsequences within
    ``SPAN`` letters, the word's borders counting as letters."""
    joined = "".join(f"^{w}$" for w in words)
    a = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), size)
    who, keys, weights = [], [], []
    for i, j in _OFFSETS:
        if j < len(a):
            same = owner[:-j] == owner[j:]
            k = (a[:-j] << 42) | (a[i:len(a) - j + i] << 21) | a[j:]
            who.append(owner[:-j][same])
            keys.append(k[same])
            weights.append(np.full(len(keys[-1]), DECAY ** (j - 2)))
    if not who:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return np.concatenate(who), np.concatenate(keys), np.concatenate(weights)


def kernel_rows(words: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word index, vocabulary index, weight) of the subsequences that the
    vocabulary has, for words scaled to length 1 in the kernel's space."""
    who, keys, w = subsequences(words)
    order = np.lexsort((keys, who))
    who, keys, w = who[order], keys[order], w[order]
    first = np.ones(len(who), bool)
    first[1:] = (who[1:] != who[:-1]) | (keys[1:] != keys[:-1])
    at = np.flatnonzero(first)
    w = np.add.reduceat(w, at) if len(at) else w
    who, keys = who[at], keys[at]
    norm = np.sqrt(np.bincount(who, w * w, len(words)))
    place = np.searchsorted(vocabulary, keys)
    place[place == len(vocabulary)] = 0
    known = vocabulary[place] == keys if len(vocabulary) else np.zeros(len(keys), bool)
    return who[known], place[known], (w / norm[who])[known]


def train_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400,
              c: float = 20.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a squared-hinge support vector machine (Newton steps
    on the rows inside the margin)."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    w, active = np.zeros(x1.shape[1]), None
    for _ in range(rounds):
        inside = y * (x1 @ w) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        xs = x1[inside] * (c * weight[inside])[:, None]
        new = np.linalg.solve(ridge + xs.T @ x1[inside], xs.T @ y[inside])
        w = w + (new - w) * (1.0 if _ < 20 else 0.5)
    return w[:-1], float(w[-1])


class Detector:
    """f(unit), positive for insults. Through the Nystrom map the machine is one
    weight for each subsequence of the landmarks."""

    def __init__(self, good: list[str], bad: list[str], bad_weight: np.ndarray) -> None:
        half = LANDMARKS // 2
        marks = [*bad[:half], *good[:half]]
        _, keys, _ = subsequences(marks)
        self.vocabulary = np.unique(keys)
        dense = self._dense(marks)
        value, vector = np.linalg.eigh(dense @ dense.T)
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])
        words = [*bad, *good]
        maps = np.vstack([self._dense(words[i:i + 512]) @ dense.T @ root
                          for i in range(0, len(words), 512)])
        y = np.concatenate([np.ones(len(bad)), -np.ones(len(good))])
        weight = np.concatenate([bad_weight / bad_weight.sum(), np.full(len(good), 2 / len(good))])
        w, self.bias = train_svm(maps, y, weight * len(words) / 2)
        self.weights = dense.T @ (root @ w)
        self.known: dict[str, float] = {}

    def _dense(self, words: list[str]) -> np.ndarray:
        who, at, w = kernel_rows(words, self.vocabulary)
        out = np.zeros((len(words), len(self.vocabulary)))
        np.add.at(out, (who, at), w)
        return out

    def __call__(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self.known = {}
            new = list(set(words))
        if new:
            who, at, w = kernel_rows(new, self.vocabulary)
            value = np.bincount(who, w * self.weights[at], len(new)) + self.bias
            self.known.update(zip(new, value.tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def summary(self, text: str | None) -> tuple[float, float, float]:
        """The worst unit, the sum of the positive units' values and the number
        of units, over a whole text; no units: a worst of -2."""
        worst, hits, n = -2.0, 0.0, 0
        for piece in unit_slices(text or ""):
            if words := [w for w in units(piece) if len(w) > 1]:
                f = np.clip(self(words), -2, 2)
                worst, hits, n = max(worst, f.max()), hits + f[f > 0].sum(), n + len(words)
        return worst, hits, float(n)


def labelled_units(docs: DataFrame, marks: DataFrame) -> tuple[list[str], list[str], np.ndarray]:
    """Units of clean and of toxic sentences, and the weights of the latter.

    Labels are on documents. Equal sentences count once, so that a document's
    copies do not vote for its words; one that clean documents have too is
    clean. A sentence of toxic documents is labelled toxic where it has a unit
    that significantly more of their sentences hold than of clean documents',
    and that unit is what it adds. At most ``UNITS`` units of either class come
    to the driver."""
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = {(s.strip(), t) for text, t in zip(b["t"], b["toxic"], strict=True)
                    for s in _SENTENCE.split(text.lower())}
            yield pd.DataFrame(list(rows), columns=["sentence", "toxic"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        total = [0, 0]
        for b in batches:
            for sentence, toxic in zip(b["sentence"], b["toxic"], strict=True):
                seen[toxic].update({w for w in units(sentence) if len(w) > 1})
                total[toxic] += 1
            if len(seen[0]) + len(seen[1]) > 1_000_000:
                yield counts(seen)
                seen = Counter(), Counter()
        seen[0][""], seen[1][""] = total
        yield counts(seen)

    def counts(seen) -> pd.DataFrame:
        both = list(seen[0].keys() | seen[1].keys())
        return pd.DataFrame({"unit": both, "clean": [seen[0][w] for w in both],
                             "toxic": [seen[1][w] for w in both]})

    few = F.broadcast(marks)  # LABELLED rows at most
    texts = docs.select("doc_id", F.col("text").alias("t")).where("t is not null").join(few, "doc_id")
    sentences = (texts.select("t", "toxic").mapInPandas(split, "sentence string, toxic int")
                 .groupBy("sentence").agg(F.min("toxic").alias("toxic")))
    found = cut_lineage(sentences.mapInPandas(count, "unit string, clean long, toxic long")
                        .groupBy("unit").agg(F.sum("clean").alias("clean"),
                                             F.sum("toxic").alias("toxic")), "units")
    whole = found.where("unit = ''").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return [], [], np.empty(0)
    share = whole["toxic"] / (whole["clean"] + whole["toxic"])
    sure = 2 * np.log(max(2, found.count())) ** 0.5 + 2
    named = found.where("unit <> ''")
    likely = (_significant(named, share, sure).orderBy(F.desc("evidence"), "unit").limit(UNITS)
              .select("unit").toPandas()["unit"])
    # near copies of a document still repeat its words, but in the same places:
    # what counts in the end is the number of different neighbours
    wanted = frozenset(likely)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = set()
            for text, toxic in zip(b["t"], b["toxic"], strict=True):
                own = ["", *units(text), ""]
                rows.update((w, toxic, own[i - 1], own[i + 1]) for i, w in enumerate(own) if w in wanted)
            yield pd.DataFrame(list(rows), columns=["unit", "toxic", "before", "after"])

    spread = (texts.select("t", "toxic").mapInPandas(
        places, "unit string, toxic int, before string, after string").groupBy("unit", "toxic")
        .agg(F.least(F.countDistinct("before"), F.countDistinct("after")).alias("n"))
        .groupBy("unit").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
                             F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic")))
    bad = _significant(spread, share, sure).orderBy(F.desc("evidence"), "unit").collect()
    plain = named.where("toxic <= clean * 0.5")
    good = plain.orderBy(F.xxhash64("unit"), "unit").limit(UNITS).collect()
    common = plain.orderBy(F.desc("clean"), "unit").limit(UNITS // 4).collect()
    good = list(dict.fromkeys([r["unit"] for r in good] + [r["unit"] for r in common]))
    weight = np.sqrt([r["toxic"] for r in bad]) if bad else np.empty(0)
    return good, [r["unit"] for r in bad], weight


def _significant(counted: DataFrame, share: float, sure: float) -> DataFrame:
    """The units (unit, clean, toxic) with their binomial ``evidence`` of being
    commoner in toxic documents, where it is enough."""
    n, base = F.col("clean") + F.col("toxic"), F.lit(float(share))
    p = F.greatest(F.col("toxic") / n, F.lit(1e-9))
    evidence = F.col("toxic") * F.log(p / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - base))).otherwise(0)
    return counted.where((F.col("toxic") > 2 * n * F.greatest(base, F.lit(0.25)))
                         & (F.col("toxic") >= 2)).withColumn("evidence", evidence).where(
        F.col("evidence") > float(sure))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x1, w = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, x1.T @ (y - p) - 1e-2 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) for every
    row of ``docs``, from its whole text alone.

    Learned from at most ``LABELLED`` labelled documents outside the fold (crc32
    of doc_id modulo 5 is 0), in hash order; null labels are left out and a
    document labelled twice is toxic if either label says so. Null and empty
    texts have the score of a text without units, a null doc_id is not held
    out, repeated rows score alike. Where no unit tells toxic documents apart,
    all scores are the share of toxic labels. No rows give no rows."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text")
    marks = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .where(~held_out("doc_id", 5, 0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    marks = cut_lineage(marks, "labels")
    good, bad, weight = labelled_units(docs, marks)
    shared = spark.sparkContext.broadcast(Detector(good, bad, weight) if bad and good else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = shared.value
        for b in batches:
            found = [detect.summary(t) if detect else (-2.0, 0.0, 0.0) for t in b["text"]]
            yield pd.concat([b[["doc_id", "held_out"]], pd.DataFrame(
                found, columns=["worst", "hits", "n"], index=b.index)], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = cut_lineage(rows.mapInPandas(
        run, f"doc_id {kind}, held_out boolean, worst double, hits double, n double"), "worst")
    known = found.join(F.broadcast(marks), "doc_id").dropDuplicates(["doc_id"]).select(
        "worst", "hits", "n", "toxic").toPandas()  # LABELLED rows at most
    if len(known) and known["toxic"].nunique() == 2:
        w = _logistic(_shape(known), known["toxic"].to_numpy(np.float64))
    else:
        w = np.array([0.0, 0.0, 0.0, 30.0 if len(known) and known["toxic"].iloc[0] else -30.0])
    z = F.lit(float(w[3])) + F.col("worst") * float(w[0]) + F.log1p("hits") * float(w[1]) + \
        F.greatest("worst", F.lit(0.0)) * float(w[2])
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return found.select("doc_id", "held_out", score.alias("score"),
                        (score >= TOXIC).cast("int").alias("predicted"))


def _shape(known: pd.DataFrame) -> np.ndarray:
    worst = known["worst"].to_numpy()
    return np.stack([worst, np.log1p(known["hits"].to_numpy()), np.maximum(worst, 0)], axis=1)
