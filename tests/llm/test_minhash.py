"""Near duplicates: links against brute force on all pairs, components, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from contrail.llm import minhash
from contrail.llm.graph import connected_components


def plain_set(text):
    words = [w.lower() if w.isascii() else w for w in text.split()] if text else []
    n = min(4, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def components(nodes, links):
    own = {i: i for i in nodes}

    def find(a):
        while own[a] != a:
            a = own[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        own[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def brute(docs):
    sets = {i: plain_set(t) for i, t in docs if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, components(ids, links)


def corpus():
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randint(0, 3000)}"
    docs, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(30, 200))]
        for _ in range(rnd.randint(1, 40)):
            own = list(base)
            for _ in range(rnd.randint(0, 5)):
                own[rnd.randrange(len(own))] = word()
            docs.append((i, " ".join(own)))
            i += 1
    chain = [word() for _ in range(60)]  # a chain whose ends are not alike
    for _ in range(25):
        docs.append((i, "\n".join(chain)))
        chain = [*chain[2:], word(), word()]
        i += 1
    docs += [(i + k, " ".join(word() for _ in range(50))) for k in range(60)]
    return docs


@pytest.mark.parametrize("seed", [0])
def test_components_equal_all_pairs(spark, seed):
    docs = corpus()
    sets, want = brute(docs)
    frame = spark.createDataFrame([(*d, 1, 2, "z") for d in docs],
                                  "doc_id long, text string, rep int, n int, sig string")
    out = minhash.near_duplicates(frame)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = out.collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) for r in rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one\x0btwo"), (6, "one two three"),
            (7, long), (8, long + " more"), (9, "É b c d"), (10, "é b c d"), (11, "same same same same"),
            (11, "same same same same"), (None, "one two"), (None, None)]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert got == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False),
                   6: (1, 6, True), 7: (29997, 7, True), 8: (29998, 7, False), 9: (1, 9, True),
                   10: (1, 10, True), 11: (1, 11, True)}
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is None) == [
        (0, None, True), (1, None, True)]
    assert len(rows) == len(docs)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(frame).count() == 0


def test_link_at_the_threshold(spark):
    """Sets of 9 with 8 shared of 10 in all are linked, of 8 shared of 11 not."""
    sets = [" ".join(f"a{i}" for i in range(12))]
    sets.append(" ".join([f"a{i}" for i in range(11)] + ["b"]))       # 8 of 9 each: 8 / 10
    docs = list(enumerate(sets))
    assert brute(docs)[1] == {0: 0, 1: 0}
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 0}


def test_minima_estimate_the_similarity():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    a, b = pool[:2000], pool[400:2400]
    agree = np.mean(minhash.minima(a) == minhash.minima(b))
    assert abs(agree - 1600 / 2400) < 0.15


def test_connected_components(spark):
    rnd = random.Random(9)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(150)]
    links += [(400 + i, 401 + i) for i in range(64)] + [(500, 500 + i) for i in range(1, 80)]
    links += [(7, 7), links[0], links[0][::-1]]
    frame = spark.createDataFrame([*links, (None, 3), (4, None)], "u long, v long")
    got = {r.node: r.component for r in connected_components(frame).collect()}
    want = components({x for link in links for x in link}, links)
    assert {k: got.get(k, k) for k in want} == want
    assert connected_components(frame.limit(0)).count() == 0


def test_shingle_sizes_of_the_query_and_the_pipeline(spark, tmp_path):
    """Over 0.8 at four words and under it at five: op5 links, the stage does not."""
    import corpus_pipeline
    from contrail.llm import queries

    base = [f"w{i}" for i in range(40)]
    near = [*base[:20], "other", *base[21:]]

    def like(a, b, size):
        x, y = (set(minhash.shingle_set(" ".join(t), size).tolist()) for t in (a, b))
        return len(x & y) / len(x | y)
    assert like(base, near, 4) >= 0.8 > like(base, near, 5)
    docs = [(1, " ".join(base)), (2, " ".join(near))]
    rows = [(i, t, "en", "s", len(t)) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op5_near_duplicates(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.kept) for r in got) == [(1, True), (2, False)]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()) == [1, 2]
    assert minhash.near_duplicates(frame, shingle=5).where("kept").count() == 2
