"""Packing: round trip through the tokenizer, borders, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contrail.llm import packing
from contrail.llm.common import prefix_offsets, text_slices

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def coder():
    return packing.WordIds(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aAbZsσΣé́İıß '’.,!?;:19²½\t\n\r\x0b\x1c  <|>日本", "<|endoftext|>", "'re",
                                 "don't", "word", "…", "1234"]), max_size=60))
def test_word_ids_equal_the_tokenizer(coder, tokenizer, parts):
    text = "".join(parts)
    got = np.frombuffer(coder(text), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_ids_with_a_small_store(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 5)
    monkeypatch.setattr(packing, "LONG_PART", 3)
    code, rnd = packing.WordIds(PATH), random.Random(3)
    for _ in range(60):
        text = " ".join(rnd.choice(["the", "them.", "a", "straße,", "x" * 30, "no", "b.", "don't", "<|endoftext|>",
                                    "12,3a", "--", "\x00", "a<b", "c3p0...!?1", "e\u0301."])
                        for _ in range(rnd.randint(0, 30)))
        assert np.frombuffer(code(text), "<u4").tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids


def test_every_latin_letter_beside_others(coder, tokenizer):
    for c in map(chr, range(0x20, 0x250)):
        text = f"{c} a{c} {c}a 1{c}. a{c}a, {c}{c}"
        assert np.frombuffer(coder(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_encode_word_by_word(tokenizer):
    other = packing.WordIds(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_part and packing.WordIds(PATH).by_part
    assert np.frombuffer(other("don't 12."), "<u4").tolist() == [
        i for w in ("don't", "12.") for i in other.tokenizer.encode(w, add_special_tokens=False).ids]


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(min_codepoint=0x20, max_codepoint=0x7E),
                         st.characters(min_codepoint=0xA1, max_codepoint=0x24F)), max_size=40))
def test_latin_text_equals_the_tokenizer(coder, tokenizer, text):
    assert np.frombuffer(coder(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", ["\u00a0", "\u3000", "\u2003", "\x85"])
def test_words_without_ids_beside_a_long_new_word(tokenizer, blank):
    code = packing.WordIds(PATH)
    for text in (f"see {blank} at https://example.org/{'a' * 80} now {blank}.", f"{blank} {'b' * 90} x", f"{blank} {blank}"):
        assert np.frombuffer(code(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_batches_equal_single_texts(tokenizer):
    import pyarrow as pa
    texts = ["", "The the", " ", "a\x0bb\x0cc\x1cd", "İ. É. ß!", "", "x" * 99]
    ids, ends = packing.WordIds(PATH).batch(pa.array(texts))
    for t, lo, hi in zip(texts, [0, *ends], ends):
        assert ids[lo:hi].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_slices_keep_the_text():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice("ab \n") for _ in range(rnd.randint(0, 90)))
        parts = list(text_slices(text, 7))
        assert "".join(parts) == text
        assert all(p[-1] in " \n" for p in parts[:-1])


def check(rows, docs, tokenizer, size, end=2):
    """Brute force: the pieces of all documents rebuild their ids, and the
    sequences have neither gap nor overlap."""
    own = {}
    for doc, text in docs:
        ids = (tokenizer.encode(text, add_special_tokens=False).ids if text else []) + [end]
        own.setdefault(doc, []).append(np.array(ids, "<u4").tobytes())
    pieces: dict = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        pieces.setdefault(r.sequence_id, []).append(r)
    for s, group in pieces.items():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == size or s == max(pieces) and 0 < at <= size
    assert sorted(pieces) == list(range(len(pieces)))
    order = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    rebuilt, current = {}, None
    for r in order:
        if r.start == 0:
            current = b""
        current += r.ids
        if r.start + r.length == r.doc_tokens:
            rebuilt.setdefault(r.doc_id, []).append(current)
    assert {k: sorted(v) for k, v in rebuilt.items()} == {k: sorted(v) for k, v in own.items()}


def test_pack_round_trip(spark, tokenizer):
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma.", "δέλτα"])
                         for _ in range(rnd.randint(0, 40)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "  \n "), (203, "long " * 5000), (7, "again"),
             (7, "again"), (None, "no id"), (None, None)]
    rows = [(d, t, 1, 2) for d, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int, ids int").repartition(5)
    out = packing.pack(frame, PATH, 64, with_ids=True)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                           "offset", "ids"]
    rows = out.collect()
    check(rows, docs, tokenizer, 64)
    whole = packing.sequences(out).collect()
    total = sum(r.length for r in rows)
    assert sorted(len(r.ids) // 4 for r in whole) == sorted(
        [64] * (total // 64) + ([total % 64] if total % 64 else []))


def test_pack_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(frame, PATH).count() == 0


def test_prefix_offsets_over_many_keys(spark):
    rows = [(k, (k * 7) % 11) for k in range(0, 300, 3)]
    got = prefix_offsets(spark.createDataFrame(rows, "k int, v long"), "k", "v", "o", fan=16).collect()
    at, want = 0, {}
    for k, v in rows:
        want[k], at = at, at + v
    assert {r.k: r.o for r in got} == want
