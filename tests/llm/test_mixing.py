"""Mixing: weights, budgets, whole and partial passes, odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from contrail.llm import mixing


def test_exponent_meets_entropy_or_repetition():
    tokens = [1000, 100, 50, 10]
    a = mixing.solve(tokens, 0.9, 1e9)
    assert mixing.entropy(mixing.temper(tokens, a)) == pytest.approx(0.9 * math.log(4), abs=1e-6)
    a = mixing.solve(tokens, 0.999, 3.0)
    passes = [w / t for w, t in zip(mixing.temper(tokens, a), tokens)]
    assert max(passes) / min(passes) == pytest.approx(3.0, abs=1e-6)
    assert mixing.solve([5, 5], 0.99, 2) == 1.0
    assert mixing.solve([5, 0], 0.99, 2) == mixing.solve([], 0.99, 2) == 1.0
    assert mixing.solve(tokens, 0.999, 1.0) == 1.0


def test_default_budget_uses_every_source_in_full():
    tokens = [1000, 100, 0, 10]
    b = mixing.budgets(tokens, 0.5, None)
    assert all(x >= t for x, t in zip(b, tokens)) and b[2] == 0 and b[0] == 1000


def rows(n=400):
    rnd = random.Random(2)
    return [(i, " ".join(["w"] * rnd.randint(1, 30)),
             rnd.choices(["big", "mid", "small", None], [60, 20, 15, 5])[0]) for i in range(n)]


def mixed(spark, data, **kw):
    frame = spark.createDataFrame(data, "doc_id long, text string, source string").withColumns(
        {"mix_copy": F.lit("x"), "passes": F.lit(1), "block": F.lit(2), "key": F.lit(3), "s": F.lit(4)})
    out = mixing.mix(frame, **kw)
    assert out.columns == ["doc_id", "text", "source", "passes", "block", "key", "s", "mix_copy",
                           "mix_weight", "mix_tokens", "mix_order"]
    return out.collect()


@pytest.mark.parametrize("total", [None, 1500, 20_000])
def test_realised_tokens_follow_the_weights(spark, monkeypatch, total):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    data = rows()
    got = mixed(spark, data, total=total, target_entropy=0.99, max_repeat=5)
    held, copies = Counter(), Counter()
    for r in got:
        held[r.source] += r.mix_tokens
        copies[r.source, r.doc_id] += 1
    size = Counter()
    for _, text, s in data:
        size[s] += len(text.split())
    names = sorted(size, key=lambda s: (s is not None, s or ""))
    a = mixing.solve([size[s] for s in names], 0.99, 5)
    for s, b in zip(names, mixing.budgets([size[s] for s in names], a, total)):
        assert b - 30 < held[s] <= b
        own = [copies[s, i] for i, _, x in data if x == s]
        assert max(own) - min(own) <= 1  # whole passes and one part
        if total is None:
            assert min(own) >= 1
    for (s, i), n in copies.items():
        assert sorted(r.mix_copy for r in got if r.doc_id == i) == list(range(n))


def test_mixing_is_repeatable(spark):
    data = rows(100)
    key = lambda got: sorted((r.doc_id, r.mix_copy) for r in got)
    assert key(mixed(spark, data, total=700)) == key(mixed(spark, data[::-1], total=700))


def test_odd_rows(spark):
    data = [(1, None, "a"), (2, "", "a"), (3, " x  y\n", "a"), (None, "one two", "b"),
            (4, "same words", "b"), (4, "same words", "b"), (5, "w " * 20000, None)]
    got = mixed(spark, data, target_entropy=0.5)
    assert Counter(r.doc_id for r in got if r.mix_copy == 0) == Counter([1, 2, 3, None, 4, 4, 5])
    assert {r.doc_id: r.mix_tokens for r in got}[3] == 2
    assert mixed(spark, []) == []
    none = mixed(spark, [(1, "", "a"), (2, None, None)])
    assert [(r.mix_copy, r.mix_weight) for r in none] == [(0, 0.0)] * 2


def spark_hash(seed: int, *longs: int) -> int:
    """xxhash64 of an int literal and longs, as Spark chains them."""
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    for x in longs:
        h = xxhash.xxh64_intdigest((x % (1 << 64)).to_bytes(8, "little"), h)
    return h - ((h >> 63) << 64)


@pytest.mark.parametrize("total", [None, 1500, 9000])
def test_rows_and_order_equal_the_plain_version(spark, monkeypatch, total):
    """Passes, block permutations and the cut of the last pass, row by row."""
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    data, seed = rows(), 7
    size = Counter()
    for _, text, s in data:
        size[s] += len(text.split())
    names = sorted(size, key=lambda s: (s is not None, s or ""))
    a = mixing.solve([size[s] for s in names], 0.99, 5)
    want = []
    for s, b in zip(names, mixing.budgets([size[s] for s in names], a, total)):
        own = [(i, len(t.split())) for i, t, x in data if x == s]
        passes, rest = divmod(b, size[s])
        blocks = -(-size[s] // 200)
        block = {i: spark_hash(seed, i) % blocks for i, _ in own}
        for k in range(passes + 1):
            left = rest
            for h, n in sorted((spark_hash(seed + 1, k, n), n) for n in set(block.values())):
                inside = sorted((spark_hash(seed + 2, i, t), i, t) for i, t in own if block[i] == n)
                whole = k < passes or sum(t for *_, t in inside) <= left
                held = 0
                for place, i, t in inside:
                    held += t
                    if whole or held <= left:
                        want.append(((k, h, n, place), i))
                left = left - sum(t for *_, t in inside) if whole else -1
                if k == passes and left < 0:
                    break
    got = mixed(spark, data, total=total, target_entropy=0.99, max_repeat=5)
    assert sorted((tuple(r.mix_order), r.doc_id) for r in got) == sorted(want)
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    in_order = mixing.ordered(mixing.mix(frame, total=total, target_entropy=0.99, max_repeat=5)).collect()
    assert [tuple(r.mix_order) for r in in_order] == sorted(o for o, _ in want)
