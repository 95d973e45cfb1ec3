"""Quality scores: random Fourier features over document statistics, ridge
regression from partition-summed normal equations, isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import held_out

FEATURES = 256     # random Fourier features
RIDGE = 1e-3       # per labelled row
BINS = 2000        # of raw scores, for the calibration
GOOD = 0.3
_SYMBOL = regex.compile(r"[^\w\s.,;:!?'\"()\-]")
_STOP = regex.compile(r"[.!?](?=\s|$)")
NAMES = ("log_chars", "log_words", "word_length", "word_spread", "distinct", "symbols", "digits",
         "upper", "capital_words", "bare_words", "marked_words", "short_words", "long_words",
         "lines", "line_words", "line_repeats", "worst_symbols", "worst_repeats", "worst_upper",
         "stops", "top_word", "pair_repeats", "stutter", "exclaim", "commas")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``NAMES``; an empty or
    null text has zeros."""
    if not text or not (words := text.split()):
        return [0.0] * len(NAMES)
    n, chars = len(words), len(text)
    sizes = np.fromiter(map(len, words), np.float64, n)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = len(_SYMBOL.findall(text))
    pairs = set(zip(words, words[1:], strict=False))
    worst_symbols = worst_repeats = worst_upper = 0.0
    for line in lines:
        w = line.split()
        if len(w) >= 5:
            worst_repeats = max(worst_repeats, 1 - len(set(w)) / len(w) - 0.002 * len(w))
            worst_upper = max(worst_upper, sum(map(str.isupper, w)) / len(w))
            if symbols:
                worst_symbols = max(worst_symbols, len(_SYMBOL.findall(line)) / len(line))
    return [
        math.log1p(chars), math.log1p(n), sizes.mean(), sizes.std(),
        len(seen) / n ** 0.85, symbols / chars, sum(map(text.count, "0123456789")) / chars,
        sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n,
        sum(map(str.isalpha, words)) / n, sum(not w[-1].isalnum() for w in words) / n,
        float((sizes <= 2).mean()), float((sizes >= 15).mean()),
        len(lines) / n, n / len(lines), 1 - len(set(lines)) / len(lines),
        worst_symbols, worst_repeats, worst_upper,
        len(_STOP.findall(text)) / n, seen.most_common(1)[0][1] / n,
        1 - len(pairs) / max(1, n - 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        text.count("!") / n, text.count(",") / n]


def document_statistics(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            stats = pd.Series([np.array(statistics(t)) for t in b["_t"]], index=b.index)
            yield b[keys].assign(stats=stats)

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, F.col(text_col).alias("_t")).mapInPandas(
        run, f"{kinds}, stats array<double>")


class Kernel:
    """Features whose inner products approximate a Gaussian kernel over the
    standardised statistics; the last feature is constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.where(deviation > 1e-12, deviation, 1.0)
        self.w = rng.normal(0, 1 / math.sqrt(len(mean)), (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * math.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.deviation, -6, 6)
        waves = np.cos(z @ self.w + self.b) * math.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(z), 1))])


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def normal_equations(rows: DataFrame, kernel: Kernel) -> tuple[np.ndarray, np.ndarray, float]:
    """X'X, X'y and the number of rows (stats, y). A partition sends its own
    sums only; Spark adds them, and the driver gets one number per entry."""
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xx, xy, n = np.zeros((size, size)), np.zeros(size), 0
        for b in batches:
            if len(b):
                x, y = kernel(_stack(b["stats"])), b["y"].to_numpy(np.float64)
                xx, xy, n = xx + x.T @ x, xy + x.T @ y, n + len(b)
        if n:
            flat = np.concatenate([xx[upper], xy, [n]])
            yield pd.DataFrame({"entry": np.arange(len(flat)), "value": flat})

    sums = (rows.select("stats", "y").mapInPandas(run, "entry int, value double")
            .groupBy("entry").agg(F.sum("value").alias("value")).toPandas().sort_values("entry"))
    flat = sums["value"].to_numpy()
    xx = np.zeros((size, size))
    xx[upper] = flat[:len(upper[0])]
    xx = xx + np.triu(xx, 1).T
    return xx, flat[len(upper[0]):-1], float(flat[-1])


def isotonic(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The non-decreasing means closest to the bins' means (pool adjacent
    violators); empty bins lie on the line between their neighbours, those
    outside all rows take the nearest value."""
    at = np.flatnonzero(count)
    if not len(at):
        return np.zeros(len(count))
    pools: list[list[float]] = []
    for c, t in zip(count[at], total[at], strict=True):
        pools.append([float(c), float(t), 1])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            c2, t2, k = pools.pop()
            pools[-1] = [pools[-1][0] + c2, pools[-1][1] + t2, pools[-1][2] + k]
    values = np.repeat([t / c for c, t, _ in pools], [int(p[2]) for p in pools])
    return np.interp(np.arange(len(count)), at, values)


class Model:
    def __init__(self, kernel: Kernel | None, weights: np.ndarray, steps: np.ndarray) -> None:
        self.kernel, self.weights, self.steps = kernel, weights, steps

    def bins(self, stats: np.ndarray) -> np.ndarray:
        raw = self.kernel(stats) @ self.weights
        return np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.steps[self.bins(stats)]


def fit(rows: DataFrame) -> Model | None:
    """A model from all rows (stats, y in 0 and 1); None without rows."""
    n = len(NAMES)
    found = rows.agg(F.count("*"), *[F.avg(F.col("stats")[i]) for i in range(n)],
                     *[F.stddev_pop(F.col("stats")[i]) for i in range(n)]).first()
    if not found[0]:
        return None
    kernel = Kernel(np.array(found[1:n + 1]), np.array(found[n + 1:]))
    xx, xy, count = normal_equations(rows, kernel)
    weights = np.linalg.solve(xx + RIDGE * count * np.eye(len(xx)), xy)
    model = Model(kernel, weights, np.zeros(BINS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"bin": model.bins(_stack(b["stats"])),
                                    "y": b["y"].to_numpy(np.float64)})

    held = (rows.select("stats", "y").mapInPandas(run, "bin int, y double").groupBy("bin")
            .agg(F.count("*").alias("n"), F.sum("y").alias("y")).toPandas())
    size, good = np.zeros(BINS), np.zeros(BINS)
    size[held["bin"]], good[held["bin"]] = held["n"], held["y"]
    model.steps = np.clip(isotonic(size, good), 0, 1)
    return model


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted
    (score >= 0.3) for every row of ``docs``, from its text alone.

    Fitted on the labelled documents outside the fold (crc32 of doc_id modulo 5
    is 0); null labels are left out and a document labelled twice counts by its
    lower label. Empty and null texts are scored by their zero statistics, a
    null doc_id is not held out, repeated rows get the same score. With no
    label to learn from every score is 0.5. No rows give no rows."""
    keyed = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text")
    stats = cut_lineage(document_statistics(keyed, ["doc_id", "held_out"]), "statistics")
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min(F.col("quality").cast("double")).alias("y"))
    rows = cut_lineage(stats.where("not held_out").join(marks, "doc_id").select("stats", "y"),
                       "labelled")
    model = fit(rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            score = m.score(_stack(b["stats"])) if m is not None and len(b) else 0.5
            yield b[["doc_id", "held_out"]].assign(score=score)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stats.mapInPandas(run, f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int"))
