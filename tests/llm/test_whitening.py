"""Whitening against exact fractions and plain numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from contrail.llm import whitening
from tests.conftest import frame

SCHEMA = "label int, vec_id long, embedding array<float>, n long, component string, x int"


def x_of(v) -> list[int]:
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def plain(rows, components=16):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} with exact covariances."""
    used = [(r[1], x_of(r[2])) for r in rows
            if r[2] and all(c is not None and math.isfinite(c) for c in r[2])]
    fit = sorted({tuple(x) for _, x in used})
    n, d = len(fit), len(fit[0])
    total = [sum(x[j] for x in fit) for j in range(d)]
    off = [[Fraction(n * x[j] - total[j], n) for j in range(d)] for x in fit]
    cov = np.array([[float(sum(r[i] * r[j] for r in off) / n) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    out = {}
    for key, x in used:
        far = np.array([float(Fraction(n * c - t, n)) for c, t in zip(x, total)])
        deviation = sum((n * c - t) ** 2 for c, t in zip(x, total))
        for k in range(min(components, d)):
            e, axis = values[d - 1 - k], axes[:, d - 1 - k]
            out[key, k + 1] = (n, deviation, abs(far @ axis) / math.sqrt(e), e / np.trace(cov))
    return out


def vectors(n=80, d=20, seed=3):
    rng = np.random.default_rng(seed)
    made = (rng.normal(size=(n, d)) * np.linspace(3, 0.5, d)) @ rng.normal(size=(d, d))
    made = [[float(c) for c in row] for row in made.astype(np.float32)]
    return [(1, i, v, 5, "c", 9) for i, v in enumerate([*made, *made[:7], *made[:1] * 20])]


@pytest.mark.parametrize("d", [3, 20])
def test_equals_exact_covariances(spark, d):
    rows = vectors(d=d)
    rows += [(1, 900, None, 1, "", 1), (1, 901, [], 1, "", 1), (1, 902, [None] * d, 1, "", 1),
             (1, 903, [float("nan")] * d, 1, "", 1), (1, 904, [float("inf")] + [0.0] * (d - 1), 1, "", 1)]
    got = whitening.whiten(frame(spark, SCHEMA, rows).repartition(3)).collect()
    want = plain(rows)
    assert len(got) == len(want)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert 0 < got[0]["identity_error"] < 1e-9
    for r in got:
        n, deviation, size, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - size) < 1e-8
        assert abs(r["explained"] - explained) < 1e-10
    # signs agree over the rows: the whitened fit vectors have unit covariance
    of = {}
    for r in got:
        of.setdefault(tuple(x_of(rows[r["vec_id"]][2])), {})[r["component"]] = r["whitened"]
    y = np.array([[v[k] for k in sorted(v)] for v in of.values()])
    assert np.abs(y.T @ y / len(y) - np.eye(y.shape[1])).max() < 1e-9


def test_polarisation_is_exact():
    rng = np.random.default_rng(1)
    c = rng.integers(-2 ** 40, 2 ** 40, (50, 4)).astype(object)
    n, rest = 50, [int(x) for x in c.sum(axis=0)]
    squares = np.array([[sum((r[i] + (r[j] if i != j else 0)) ** 2 for r in c) for j in range(4)]
                        for i in range(4)], object)
    want = [[float(Fraction(n * sum(r[i] * r[j] for r in c) - rest[i] * rest[j], n * n))
             for j in range(4)] for i in range(4)]
    assert whitening.covariance(squares, rest, n).tolist() == want


def test_huge_entries_stay_exact(spark):
    rows = [(1, i, [float(2.0 ** e), float(i), -float(2.0 ** e)], 0, "", 0)
            for i, e in enumerate([3, 20, 40, 54, 57, 100])]
    got = {r["vec_id"]: r for r in whitening.whiten(frame(spark, SCHEMA, rows)).collect() if r["component"] == 1}
    assert got.keys() == set(range(6))
    assert got[5]["deviation"] is None and all(math.isfinite(r["whitened"]) for r in got.values())
    rows = rows[:2]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(frame(spark, SCHEMA, rows)).collect()}
    assert {k: v["deviation"] for k, v in got.items() if k[1] == 1} == {
        k: v[1] for k, v in plain(rows, 1).items()}


def test_no_variance_null_ids_lengths_and_empty_tables(spark):
    rows = [(1, None, [1.0, 2.0], 0, "", 0), (1, None, [1.0, 2.0], 0, "", 0), (1, 3, [5.0], 0, "", 0),
            (1, 4, [7.0], 0, "", 0)]
    got = sorted(((len(str(r["vec_id"])), r["component"], r["n"], r["deviation"], r["whitened"],
                   r["explained"], r["identity_error"])
                  for r in whitening.whiten(frame(spark, SCHEMA, rows)).collect()), key=str)
    assert [g for g in got if g[0] == 4] == [(4, 1, 1, 0, None, 0.0, 0.0)] * 2 + [(4, 2, 1, 0, None, 0.0, 0.0)] * 2
    assert [(g[1], g[2], g[3], abs(g[4]), g[5]) for g in got if g[0] == 1] == [(1, 2, 2 * 64 ** 2 * 2, 1.0, 1.0)] * 2
    assert whitening.whiten(frame(spark, SCHEMA, [])).collect() == []
    assert whitening.whiten(frame(spark, SCHEMA, [(1, 1, None, 1, "", 1)])).collect() == []
