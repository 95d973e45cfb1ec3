"""Tokenizer alignment against a plain version that goes token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contrail.llm import alignment
from contrail.llm.common import text_parts
from tests.conftest import frame

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "key int, doc_id long, t string, text string, codes int, weight int, n_a string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def gpt_bytes() -> dict[str, int]:
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    table = gpt_bytes()

    def tokens(text):
        of_a = [(i, bytes(table[c] for c in a.id_to_token(i)))
                for i in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i)
                 else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        raw = (" " + text).encode()
        whole = b"".join(x for _, x in of_a) == raw == b"".join(x for _, x in of_b)
        return (of_a, of_b) if whole else ([], [])

    def spans(tokens):
        out, at = [], 0
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    def one(text):
        x, y = map(spans, tokens(text or "") if text else ([], []))
        links = [(i, j) for i, s, e in x for j, u, v in y if s < v and u < e]
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo < e <= hi) for side in (x, y)))
            lo = hi
        return len(x), len(y), len(cuts), links, ";".join(groups)

    def corpus(rows):
        made = [(r[1], *one(r[3])) for r in rows]
        count = Counter(p for m in made for p in set(m[4]))
        top = {}
        for (i, _), n in count.items():
            top[i] = max(top.get(i, 0), n)
        return sorted((key, n_a, n_b, n_g, len(links), sum(count[p] == top[p[0]] for p in links),
                       sum(count[p] for p in links),
                       hashlib.sha256(g.encode()).hexdigest() if g else "")
                      for key, n_a, n_b, n_g, links, g in made)
    return corpus


def rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    odd = ["", None, " ", "\t", "a  b", "tab\tand\nline", "<|endoftext|> and </s> <unk> <0x41>", "▁", "a▁b",
           "日本語のテキスト", "é é ﬁ ①", "😀 emoji 👨‍👩‍👧", "\x00\x01", "trailing  ", "word " * 3000, "ü" * 40]
    words = ["the", "cat", "unbelievable", "Größe", "naïve", "don't", "x1y2", "...", "année"]
    odd += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(30)]
    odd += odd[16:26] * 2
    return [(1, i, "x", t, 2, 3, "n") for i, t in enumerate(odd)] + [(1, 20, "x", odd[20], 2, 3, "n")]


def got(df) -> list[tuple]:
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(COLUMNS).collect())


@pytest.mark.parametrize("head", [alignment.HEAD_PAIRS, 40, 0])
def test_documents_equal_the_plain_version(spark, plain, head):
    docs = frame(spark, SCHEMA, rows()).repartition(3)
    assert got(alignment.align_documents(docs, A, B, head_pairs=head)) == plain(rows())


def test_groups_and_pair_counts(spark):
    docs = frame(spark, "doc_id long, text string", [(1, "ab"), (2, "ab"), (3, None)])
    out = alignment.align_documents(docs, A, B, with_groups=True).collect()
    for r in out:
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")
    assert {r["groups"] != "" for r in out if r["doc_id"] < 3} == {True}
    size = len(alignment.PieceTokenizer(B).entries)
    counts = alignment.pair_counts(alignment.aligned_texts(docs, A, B), size).collect()
    assert {r["count"] for r in counts} == {2}
    assert all(r["code"] == r["a"] * size + r["b"] for r in counts)


def test_null_ids_and_empty_tables(spark):
    docs = frame(spark, "doc_id long, text string", [(None, "ab"), (None, None)])
    assert sorted(r["n_a"] for r in alignment.align_documents(docs, A, B).collect()) == [0, 1]
    assert alignment.align_documents(docs.where("false"), A, B).collect() == []


def test_batches_are_cut_by_size():
    assert list(text_parts([], 10)) == []
    assert list(text_parts([1, 10, 1, 1, 8, 2, 30], 10)) == [(0, 1), (1, 2), (2, 5), (5, 6), (6, 7)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    [*"aB.é日▁1\u0301\u00a0\u3000\u2028\t\n'", " ", "  ", " the", " cat's", " ünb", "<s>", "<|endoftext|>", "\x00",
     "\U0001F600", " 12", "..."]), min_size=1, max_size=14).map("".join), min_size=1, max_size=4))
def test_words_put_together_equal_whole_texts(aligners, texts):
    whole, by_word = aligners
    want, got = whole(texts), by_word(texts)
    assert got.measures.tolist() == want.measures.tolist() and got.groups == want.groups
    assert got.codes.tolist() == want.codes.tolist() and got.bounds.tolist() == want.bounds.tolist()


@pytest.fixture(scope="module")
def aligners():
    assert alignment.WordAligner(A, B).by_word
    return alignment.Aligner(A, B), alignment.WordAligner(A, B)


def test_words_of_many_strings(aligners, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 40)
    monkeypatch.setattr(alignment, "LONG_WORD", 5)
    assert aligners[1].align.a.fast is not None
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join(rng.choice([str(rng.randint(0, 400)), "word ", "été", "x\n"]) for _ in range(40))
                 for _ in range(3)]
        want, got = aligners[0](texts), aligners[1](texts)
        assert got.groups == want.groups and got.codes.tolist() == want.codes.tolist()
