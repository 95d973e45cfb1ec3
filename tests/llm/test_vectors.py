"""Vector near-duplicates and search against brute force; odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from contrail.llm import search, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v int, rep string, dim int, n long"
NAN, INF = float("nan"), float("inf")


def data(n=500, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    centres = rng.normal(size=(25, dim))
    for i in range(n):
        x = centres[rng.integers(25)] * rng.uniform(0.1, 5) + rng.normal(size=dim) * rng.choice([0.05, 0.3, 2])
        rows.append((i, x.astype(np.float32).tolist(), int(rng.integers(3))))
    rows += [(n + i, rows[i][1], rows[i][2]) for i in range(40)]       # copies
    rows += [(n + 100 + i, rows[3][1], rows[3][2]) for i in range(60)]  # many of one
    return rows


ODD = [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 16, 1), (9003, [NAN] + [1.0] * 15, 1),
       (9004, [INF] + [1.0] * 15, 1), (9005, [None] + [1.0] * 15, 1), (9006, [1.0] * 16, None),
       (9007, [1.0] * 16, None), (9008, [3.0] * 5, 1), (9009, [2.0] * 5, 1), (9010, [1e30] * 16, 2),
       (9011, [1e-30] * 16, 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)


def brute_links(rows):
    out = {}
    good = [(i, np.array(v, np.float64), c) for i, v, c in rows
            if i is not None and c is not None and usable(v) and np.any(np.array(v) != 0)]
    unit = [(i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()), c) for i, v, c in good]
    for k, (i, a, c) in enumerate(unit):
        for j, b, d in unit[k + 1:]:
            if c == d and len(a) == len(b) and a @ b >= 0.93:
                out.setdefault(i, []).append(j)
                out.setdefault(j, []).append(i)
    return out


def brute_components(rows, links):
    comp = {r[0]: r[0] for r in rows}
    changed = True
    while changed:
        changed = False
        for i, js in links.items():
            least = min([comp[i], *(comp[j] for j in js)])
            changed |= least < comp[i]
            comp[i] = least
    return comp


@pytest.mark.parametrize("sizes", [{}, {"PER_PIVOT": 20, "PIVOTS": 8, "CHUNK": 50, "BLOCK": 16}])
def test_links_equal_all_pairs(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(vectors, k, v)
    rows = data() + ODD
    links = brute_links(rows)
    want = brute_components(rows, links)
    out = vectors.near_vectors(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = {r.vec_id: r for r in out.collect()}
    assert len(got) == len(rows)
    assert {i: r.n_links for i, r in got.items()} == {i: len(links.get(i, [])) for i in want}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept)
                  for r in vectors.near_vectors(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, True), (2, 2, 1, False)],
                         key=repr)
    assert vectors.near_vectors(frame(spark, []).limit(0)).count() == 0


def test_cells_miss_no_near_vector():
    """Whatever lies within the distance is in a cell that the vector visits."""
    import pandas as pd
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6))
    x[150:] = x[:150] + rng.normal(size=(150, 6)) * 0.2
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = pd.DataFrame({"label": 1, "dim": 6, "rep": range(300), "w": 1, "v": list(x)})
    placed = vectors._place(rows, rows.iloc[::11][["label", "dim", "rep", "v"]])
    home = placed[placed["home"]].set_index("rep")["cell"]
    visits = set(zip(placed["rep"], placed["cell"]))
    assert len(home) == 300
    near = x @ x.T >= vectors.COSINE
    for i, j in zip(*np.nonzero(near)):
        assert (j, home[i]) in visits
    assert len(visits) < 300 * 20


def brute_top(rows, k, every):
    out = []
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v, _ in rows
            if i is not None and usable(v)]
    for i, q in sorted({(i, tuple(v)) for i, v in good if i % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good
                        if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("sizes", [{}, {"QUERY_BLOCK": 3, "ROW_BLOCK": 37, "AT_ONCE": 2}])
def test_top_k_equals_brute_force(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(search, k, v)
    rows = data(300) + [r for r in ODD if r[0] < 9010] + [(None, [1.0] * 16, 1), (50, data()[50][1], 1)]
    got = search.top_k(frame(spark, rows))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_top(rows, 5, 50))


def test_top_k_beyond_doubles_few_rows_and_empty(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [3e6, 2.0], 1), (2, [3e6, 1.0 / 256], 1)]
    got = sorted(tuple(r) for r in search.top_k(frame(spark, rows)).collect())
    assert got == sorted(brute_top(rows, 5, 50))
    big = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [-3e38, 2.0], 1)]
    assert [r.score for r in search.top_k(frame(spark, big)).orderBy("rank").collect()] == [
        (1 << 63) - 1, -(1 << 63)]
    assert search.top_k(frame(spark, rows).limit(0)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, x = rng.integers(-99, 99, (20, 30)).astype(float), rng.integers(-99, 99, (50, 30)).astype(float)
    for s in (1, 4, 7, 30, 64):
        fq, fx = search.segment_statistics(q, s), search.segment_statistics(x, s)
        assert (fq @ fx.T >= q @ x.T - 1e-6).all()
        assert np.allclose(np.linalg.norm(fx, axis=1), np.linalg.norm(x, axis=1))


def test_each_component_is_floored_beside_a_huge_one(spark):
    rows = [(0, [0.0, 1.0]), (1, [2.0 ** 54, -0.3]), (2, [1.0, -0.3])]
    got = search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50).collect()
    assert {(r["vec_id"], r["score"]) for r in got} == {(1, -77 * 256), (2, -77 * 256)}
