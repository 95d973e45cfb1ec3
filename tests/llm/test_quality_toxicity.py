"""Quality and toxicity: held-out accuracy, folds, odd rows; parts against
plain versions."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from contrail.llm import quality, toxicity
from contrail.llm.queries import op4_quality, op8_toxicity

DOCS = "doc_id long, text string, held_out string, stats int, y int, toxic int"
LABELS = "doc_id long, quality int, toxic int"


def corpus():
    rng = np.random.default_rng(6)
    good = ["water", "runs", "down", "hill", "slowly", "because", "of", "rain", "and", "snow"]
    bad_words = ["blorgface", "snurkhead", "grumptwit"]
    docs, labels = [], []
    for i in range(400):
        words = list(rng.choice(good, 40))
        junk, toxic = i % 4 == 0, i % 5 == 1
        if toxic:
            for w in rng.choice(bad_words, 3):
                words.insert(int(rng.integers(40)), str(w))
        text = " ".join(words).capitalize() + "."
        if junk:
            text = " ".join(w + "$$$" for w in words) + " ###"
        docs.append((i, text))
        labels.append((i, 0 if junk else 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], DOCS),
            spark.createDataFrame(labels, LABELS))


@pytest.mark.parametrize("query", [quality.quality, toxicity.toxicity])
def test_learns_and_scores_every_row(spark, query):
    docs, labels = corpus()
    odd = [(900, None), (901, ""), (902, " \n "), (903, "water runs " * 20000), (None, "water runs down"),
           (7, docs[7][1])]
    out = query(*frames(spark, docs + odd, labels + [(1, None, None), (None, 1, 1), (5000, 0, 1)]))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(docs) + len(odd)
    limit = 0.3 if query is quality.quality else 0.5
    truth = {i: (q if query is quality.quality else t) for i, q, t in labels}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97
    assert len({r.score for r in got if r.doc_id == 7}) == 1
    assert len({r.score for r in got if r.doc_id in (900, 901, 902)}) == 1


@pytest.mark.parametrize("query", [quality.quality, toxicity.toxicity])
def test_without_labels_or_rows(spark, query):
    docs, labels = corpus()
    d, lab = frames(spark, docs[:5], labels)
    assert len({r.score for r in query(d, lab.limit(0)).collect()}) == 1
    assert query(d.limit(0), lab).count() == 0
    one_class = [(i, 1, 0) for i, *_ in labels]
    assert {r.predicted for r in query(*frames(spark, docs[:40], one_class)).collect()} == {
        1 if query is quality.quality else 0}


def test_normal_equations_equal_the_whole_matrix(spark):
    rng = np.random.default_rng(1)
    stats, y = rng.normal(size=(200, len(quality.NAMES))), rng.integers(0, 2, 200).astype(float)
    kernel = quality.Kernel(stats.mean(axis=0), stats.std(axis=0))
    rows = spark.createDataFrame([(s.tolist(), float(t)) for s, t in zip(stats, y)],
                                 "stats array<double>, y double").repartition(7)
    xx, xy, n = quality.normal_equations(rows, kernel)
    x = kernel(stats)
    assert n == 200 and np.allclose(xx, x.T @ x) and np.allclose(xy, x.T @ y)


def test_features_approximate_the_kernel(monkeypatch):
    monkeypatch.setattr(quality, "FEATURES", 20_000)
    rng = np.random.default_rng(2)
    stats = rng.normal(size=(6, 10))
    kernel = quality.Kernel(np.zeros(10), np.ones(10))
    x = kernel(stats)[:, :-1]
    z = np.clip(stats, -6, 6)
    want = np.exp(-((z[:, None] - z[None]) ** 2).sum(axis=2) / 20)
    assert np.abs(x @ x.T - want).max() < 0.05


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(3)
    count = rng.integers(0, 4, 30).astype(float)
    total = np.minimum(count, rng.integers(0, 4, 30))
    fit = quality.isotonic(count, total)
    assert (np.diff(fit[np.flatnonzero(count)]) >= -1e-12).all()
    # min-max formula of isotonic regression over the bins with rows
    at = np.flatnonzero(count)
    for j, b in enumerate(at):
        want = max(min(total[at[i:k + 1]].sum() / count[at[i:k + 1]].sum()
                       for k in range(j, len(at))) for i in range(j + 1))
        assert fit[b] == pytest.approx(want)


def plain_kernel(a, b):
    """All three-letter subsequences of both, directly."""
    def features(w):
        out, w = {}, f"^{w}$"
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    key = w[i] + w[j] + w[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out
    x, y = features(a), features(b)
    dot = sum(v * y.get(k, 0) for k, v in x.items())
    return dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5


def test_kernel_equals_the_definition():
    words = ["idiot", "idxiot", "i", "aaaa", "straße", "trash", "idiotic"]
    _, keys, _ = toxicity.subsequences(words)
    vocabulary = np.unique(keys)
    x = np.zeros((len(words), len(vocabulary)))
    who, at, w = toxicity.kernel_rows(words, vocabulary)
    x[who, at] = w
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if len(a) > 1 and len(b) > 1:
                assert (x @ x.T)[i, j] == pytest.approx(plain_kernel(a, b))
    assert toxicity.kernel_rows([], vocabulary)[0].size == 0


def test_gaps_and_inserted_letters(spark):
    docs, labels = corpus()
    extra = [(2000, "water runs snu-rk.head down hill slowly and snow"),
             (2001, "water runs b l o r g f a c e down hill slowly"),
             (2002, "water runs blorxgface down hill slowly and rain"),
             (2003, "water runs down hill slowly because of rain")]
    rows = toxicity.toxicity(*frames(spark, docs + extra, labels)).where("doc_id >= 2000").collect()
    assert {r.doc_id: r.predicted for r in rows} == {2000: 1, 2001: 1, 2002: 1, 2003: 0}


def accuracy(spark, query, label):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", f"{label} AS truth")
    rows = query(spark, sf).where("held_out").join(truth.dropna(), "doc_id").collect()
    return np.array([(r.truth, r.predicted, r.score) for r in rows])


def test_held_out_accuracy_on_labels(spark):
    got = accuracy(spark, op4_quality, "quality")
    assert np.mean(got[:, 0] == got[:, 1]) >= 0.97
    got = accuracy(spark, op8_toxicity, "toxic")
    toxic = got[got[:, 0] == 1]
    assert np.mean(toxic[:, 1]) >= 0.8 and np.mean(got[got[:, 0] == 0][:, 1]) <= 0.01


def test_spelled_words_are_whole_over_slices(monkeypatch):
    import random

    from contrail.llm.common import text_slices
    monkeypatch.setattr(toxicity, "text_slices", lambda text: text_slices(text, 20))
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(["a ", "b ", "c.", "word ", "-", "x", "\n", " ", "d - ", "e_"])
                       for _ in range(rng.randint(0, 60)))
        slices = list(toxicity.unit_slices(text))
        assert "".join(slices) == text
        assert [w for x in slices for w in toxicity.units(x) if w] == [w for w in toxicity.units(text) if w]
    text = "w " * 8 + "b l o r g f a c e" + " w" * 30
    assert "blorgface" in " ".join(w for x in toxicity.unit_slices("word " * 3 + text[16:])
                                   for w in toxicity.units(x))


def test_two_letter_insults_are_learned(spark):
    name = lambda n: "".join(chr(97 + int(c)) for c in str(100 + n))
    docs = [(i, f"good here and {name(i % 37)} " + ("zq" if i % 4 == 0 else name(i % 11)) + f" {name(i % 29)}.")
            for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    got = toxicity.toxicity(*frames(spark, docs + [(900, "such a zq thing"), (901, "such a fine thing")], labels))
    score = {r["doc_id"]: r["score"] for r in got.collect()}
    assert score[900] > 0.5 > score[901]


def test_quality_scores_equal_the_whole_matrix(spark):
    """All rows in one matrix, the isotonic fit by its min-max formula."""
    docs, labels = corpus()
    y = {i: q for i, q, _ in labels}
    known = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5]
    x = np.array([quality.statistics(t) for _, t in docs])
    fitted = x[known]
    kernel = quality.Kernel(fitted.mean(axis=0), fitted.std(axis=0))
    waves, target = kernel(fitted), np.array([y[i] for i in known], float)
    gram = waves.T @ waves + quality.RIDGE * len(known) * np.eye(waves.shape[1])
    weights = np.linalg.solve(gram, waves.T @ target)
    place = np.clip((kernel(x) @ weights + 0.5) / 2 * quality.BINS, 0, quality.BINS - 1).astype(int)
    used = sorted(set(place[known]))
    groups = [[y[i] for i in known if place[i] == b] for b in used]
    mean = lambda a, b: np.mean([v for g in groups[a:b + 1] for v in g])
    steps = [max(min(mean(i, j) for j in range(k, len(used))) for i in range(k + 1)) for k in range(len(used))]
    want = np.interp(place, used, steps)
    got = {r["doc_id"]: r for r in quality.quality(*frames(spark, docs, labels)).collect()}
    assert np.allclose([got[i]["score"] for i, _ in docs], want, atol=1e-9)
    assert [got[i]["predicted"] for i, _ in docs] == [int(v >= 0.3) for v in want]


def test_detector_equals_the_machine_over_the_kernel_map():
    """One weight a subsequence gives what the landmarks' kernel map gives."""
    good = ["water", "runs", "down", "hill", "slowly", "because", "rain", "snow", "warm", "stone"]
    bad = ["blorgface", "snurkhead", "grumptwit"]
    detect = toxicity.Detector(good, bad, np.ones(3))

    marks = [*bad, *good]
    inner = np.array([[plain_kernel(a, b) for b in marks] for a in marks])
    value, vector = np.linalg.eigh(inner)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    weight = np.concatenate([np.full(3, 1 / 3), np.full(len(good), 2 / len(good))]) * len(marks) / 2
    y = np.concatenate([np.ones(3), -np.ones(len(good))])
    w, bias = toxicity.train_svm(inner @ root, y, weight)
    words = ["blorgface", "blorg", "bloorgfacce", "waters", "stone", "grump", "ab"]
    want = [np.array([plain_kernel(x, m) for m in marks]) @ root @ w + bias for x in words]
    assert np.allclose(detect(words), want, atol=1e-6)
    assert detect.summary("Water BLORGFACE runs")[0] == pytest.approx(min(2, want[0]), abs=1e-6)
