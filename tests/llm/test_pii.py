"""Personal data: patterns against plain regular expressions, the field, odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from contrail.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(c) for c in digits[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), n, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_patterns_equal_the_plain_ones():
    rnd = random.Random(3)
    pieces = ["a", "b.c", "@", "x@y.zz", ".", "-", " ", "+", "1", "22", "255", "256", "4111111111111111",
              "4111 1111 1111 1111", "(", ")", "+1 (212) 555-0147", "10.0.0.1", "é", "٣", "\n", "%", "0"]
    for _ in range(6000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(spark)


def test_long_runs_cost_no_more_than_their_length(field):
    for text in ("1" * 300_000, "a." * 150_000, "1." * 150_000, "+" * 300_000, "@" * 300_000, "1 " * 150_000):
        pii.base_spans(text)


def test_the_field_adds_other_spellings(field):
    texts = ["please call (415) 555-2671 tomorrow", "anna dot berg at mail dot com wrote",
             "her SSN 123-45-6789 was there", "nothing at all to see", "in 1999 we sold 12345678 units",
             "write to a.12@mail1.example.com or +1 (635) 555-6187 now"]
    got = [[(t[a:b], k) for a, b, k in everything if k in pii.ADDED]
           for t, (_, everything) in zip(texts, pii.all_spans(texts, field))]
    assert got == [[("(415) 555-2671", "contact")], [("anna dot berg at mail dot com", "contact")],
                   [("123-45-6789", "identity")], [], [], []]


def test_viterbi_finds_the_best_path(field):
    """Against all paths of short lines."""
    rnd = random.Random(4)
    words = ["call", "(415)", "555-2671", "at", "dot", "SSN", "123-45-6789", "thing", "x9", "com."]
    lines = [[rnd.choice(words) for _ in range(rnd.randint(0, 5))] for _ in range(60)]
    found = field.decode(lines)
    for line, tags in zip(lines, found):
        assert len(tags) == len(line)
        if not line:
            continue
        edge = field._score("")
        s = np.stack([edge, *[field._score(w) for w in line], edge])
        e = s[:-2, 0] + s[1:-1, 1] + s[2:, 2]

        def value(path, e=e):
            return field.starts[path[0]] + sum(e[t, k] for t, k in enumerate(path)) + sum(
                field.moves[a, b] for a, b in itertools.pairwise(path))
        best = max(value(p) for p in itertools.product(range(len(pii.TAGS)), repeat=len(line)))
        assert value(list(tags)) == pytest.approx(best)


def test_gradient_of_the_likelihood(spark, field):
    """Training lowers the number of wrong tags on its own table to a few."""
    rows = pii.labelled_table(spark).collect()
    wrong = 0
    for r, found in zip(rows, field.spans([r.text for r in rows])):
        wrong += sorted(found) != sorted((s.a, s.b, s.kind) for s in r.spans)
    assert wrong <= 0.06 * len(rows)


def test_query_rows(spark):
    docs = [(1, None), (2, ""), (3, "é x@y.example.com 10.0.0.1, 300.1.1.1"), (4, "4111 1111 1111 1111"),
            (4, "4111 1111 1111 1111"), (5, "+1 (212) 555-0147 " * 3000), (None, "a@b.c")]
    frame = spark.createDataFrame([(*d, "q", 1) for d in docs],
                                  "doc_id long, text string, pii string, n_email int")
    out = pii.personal_data(frame)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = out.collect()
    assert len(rows) == len(docs)
    for r, (doc, text) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id)), docs):
        base = plain_spans(text or "")
        assert r.doc_id == doc
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for *_, k in base) for kind in PLAIN]
        said = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) <= set(r.spans.split(",")) or not base
    assert pii.personal_data(frame.limit(0)).count() == 0


def test_masked():
    text = "mail x@y.zz or 10.0.0.1 now"
    assert pii.masked(text, pii.base_spans(text)) == "mail <EMAIL> or <IP> now"
    assert pii.masked("abc", []) == "abc"
    assert pii.masked("+1 4111111111111111", [(0, 19, "phone"), (3, 19, "card")]) == "<PHONE>"


def test_runs_of_zeros_and_long_tokens():
    zeros = "0" * 5000
    assert pii.base_spans(f"x {zeros}.1.1.1 y") == [(2, 2 + 5000 + 6, "ip")]
    assert pii.base_spans(f"{zeros}1.2.3.256 1.{zeros}255.3.4") == [(5010, 5010 + 5009, "ip")]
    # the whole token counts, not its first characters
    assert pii.features("q" * 45 + "415-555-2671") != pii.features("q" * 45)
    assert pii.features("q" * 90 + "7")[3] == "d=1"
