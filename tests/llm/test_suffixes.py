"""Suffix arrays: against sorting, and whole documents against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import suffixes
from tests.conftest import frame

LENGTH = suffixes.LENGTH
SCHEMA = "lang string, doc_id long, text string, t int, id int, spans int, kept string"


def suffix(s: np.ndarray, i: int) -> list[int]:
    return s[i:i + int(np.flatnonzero(s[i:] == 0)[0])].tolist()


symbols = st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(symbols, st.integers(1, 3))
def test_suffix_array_equals_sorting(parts, times):
    s = np.array([c for p in parts for c in (*(p * times), 0)], np.uint8)
    order = suffixes.suffix_array(s)
    marks = np.flatnonzero(s == 0)
    want = sorted(np.flatnonzero(s).tolist(),
                  key=lambda i: ([*suffix(s, i), 0], marks[np.searchsorted(marks, i)]))
    assert order.tolist() == want
    for least in (2, 9):
        assert suffixes.suffix_array(s, least).tolist() == [i for i in want if len(suffix(s, i)) >= least]
    shallow = suffixes.suffix_array(s, 20, 20)
    assert [suffix(s, i)[:20] for i in shallow] == [suffix(s, i)[:20] for i in want if len(suffix(s, i)) >= 20]


@settings(max_examples=100, deadline=None)
@given(symbols, st.sampled_from([3, 8, 100]))
def test_common_prefixes(parts, most):
    s = np.array([c for p in parts for c in (*(p * 3), 0)], np.uint8)
    order = suffixes.suffix_array(s)
    def common(a, b):
        n = 0
        while n < min(len(a), len(b), most) and a[n] == b[n]:
            n += 1
        return n
    want = [common(suffix(s, a), suffix(s, b)) for a, b in zip(order, order[1:])]
    assert suffixes.common_prefixes(order, s, most).tolist()[1:] == want


def test_every_suffix_is_in_one_segment(monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 500)
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abcd ") for _ in range(n)) for n in (0, 99, 100, 101, 5000, 350)]
    texts.append(b"xy" * 700)
    frequent = suffixes.Frequent(np.unique(suffixes.gram_hashes(texts[4]))[::3])
    for rare in (None, frequent):
        h, g, text, at, n = suffixes._found(texts, rare, LENGTH, True)
        seen = [(k, p) for k, a, m in zip(text, at, n) for p in range(a, a + m - LENGTH + 1)]
        assert len(seen) == len(set(seen))
        assert set(seen) == {(k, p) for k, t in enumerate(texts) for p in range(len(t) - LENGTH + 1)}
        # the landmark follows from a suffix's first bytes alone
        of = {}
        for x, k, a, m in zip(h, text, at, n):
            for p in range(a, a + m - LENGTH + 1):
                assert of.setdefault(texts[k][p:p + LENGTH], x) == x


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept); ids are distinct or rows equal."""
    seen, out = {}, {}
    for key, text in sorted({(r[1], (r[2] or "").encode()) for r in rows if r[1] is not None}):
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - LENGTH + 1):
            if seen.setdefault(text[p:p + LENGTH], (key, p)) != (key, p):
                gone[p:p + LENGTH] = True
        kept = bytes(b for b, x in zip(text, gone) if not x)
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        out[key, text] = (key, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    done = []
    for r in rows:
        text = (r[2] or "").encode()
        done.append(out[r[1], text] if r[1] is not None else
                    (None, len(text), 0, 0, hashlib.sha256(text).hexdigest()))
    return sorted(done, key=str)


def got(df) -> list[tuple]:
    return sorted(((r[suffixes_id], r["n_bytes"], sum(x["end"] - x["start"] for x in r["spans"]),
                    len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
                   for r in df.collect() for suffixes_id in ["doc_id"]), key=str)


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß語") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(rng.randint(15, 60)) for _ in range(8)]
    line = prose(22)
    texts = [None, "", "short", "z" * 99, "z" * 100, "z" * 5000, "ab" * 900, (line + "\n") * 40]
    for _ in range(120):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages)[rng.randint(0, 40):], prose(rng.randint(0, 20))]
        texts.append(rng.choice([" ", ""]).join(parts))
    texts += [line + prose(rng.randint(1, 3)) for _ in range(60)]
    texts += texts[20:30]
    rng.shuffle(texts)
    return [("x", i, t, i, 1, 2, "k") for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_equal_brute_force(spark, seed):
    rows = corpus(seed)
    rows += [("y", None, rows[30][2], 1, 1, 1, ""), rows[9], rows[9]]
    df = frame(spark, SCHEMA, rows).repartition(5)
    assert got(suffixes.suffix_dedup(df)) == brute(rows)


def test_equal_ids_come_in_the_order_of_their_hashes(spark):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdef") for _ in range(150))
    df = frame(spark, "doc_id long, text string", [(7, "one " + shared), (7, "two " + shared)])
    removed = sorted(r["n_bytes"] - len(r["kept"]) for r in suffixes.suffix_dedup(df).collect())
    assert removed == [0, 151]  # with the space before


def test_a_text_longer_than_a_slice(spark):
    rng = np.random.default_rng(4)
    text = bytes(rng.integers(97, 123, suffixes.SLICE + 300_000, dtype=np.uint8)).decode()
    cut = suffixes.SLICE
    rows = [(1, text), (2, "!" + text[cut - 70:cut + 60]), (3, text[5:104]), (4, text[-100:])]
    found = suffixes.suffix_dedup(frame(spark, "doc_id long, text string", rows))
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()} == {
        1: [], 2: [(1, 131)], 3: [], 4: [(0, 100)]}


def test_crowded_landmarks_meet_by_their_strings(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 3)
    monkeypatch.setattr(suffixes, "frequent_landmarks", lambda texts, length: np.zeros(0, np.uint64))
    rows = corpus(3)
    assert got(suffixes.suffix_dedup(frame(spark, SCHEMA, rows))) == brute(rows)


def test_empty_tables(spark):
    assert suffixes.suffix_dedup(frame(spark, SCHEMA, [])).collect() == []
    nulls = suffixes.suffix_dedup(frame(spark, SCHEMA, [(None,) * 7, (None, 1, None, None, None, None, None)]))
    assert sorted((r["n_bytes"], r["spans"], bytes(r["kept"])) for r in nulls.collect()) == [(0, [], b"")] * 2
