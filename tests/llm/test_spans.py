"""Substring duplicates against a plain version; odd rows."""

from __future__ import annotations

import random

from contrail.llm import spans


def plain(docs):
    """All runs in one dictionary, in the order of ids."""
    first, gone = {}, {}
    for key, text in sorted({d for d in docs if d[0] is not None and d[1] is not None},
                            key=lambda d: d[0]):
        for (i, e), h in zip(*spans.runs(text)):
            if first.setdefault(h, (key, i)) != (key, i):
                gone.setdefault(key, set()).update(range(i, e))
    out = {}
    for key, text in docs:
        cut = gone.get(key, set()) if text is not None else set()
        parts = spans.sentences(text)
        out[key] = (len(parts), len(cut), text if not cut else
                    "".join(text[a:b] for j, (a, b) in enumerate(parts) if j not in cut))
    return out


def corpus():
    rnd = random.Random(8)
    sentence = lambda: " ".join(f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(2, 12))) + \
        rnd.choice([". ", "! ", "?\n", "\n", ".\n"])
    passage = "".join(sentence() for _ in range(8))
    docs = []
    for i in range(80):
        body = [sentence() for _ in range(rnd.randint(0, 15))]
        if i % 4 == 0:
            body.insert(rnd.randint(0, len(body)), passage if i % 8 else passage.upper())
        docs.append((i, "".join(body)))
    docs += [(100 + k, docs[3][1]) for k in range(5)] + [(120, docs[5][1] * 2)]
    return docs, passage


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "h", 2) for d in docs],
                                 "doc_id long, text string, th int, runs string, i int").repartition(4)


def test_removal_equals_the_plain_version(spark):
    docs, passage = corpus()
    out = spans.substring_dedup(frame(spark, docs))
    assert out.columns == ["doc_id", "n_sentences", "n_removed", "text"]
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in out.collect()}
    assert got == plain(docs)
    kept = [i for i, r in got.items() if i % 4 == 0 and i < 80
            and " ".join(passage.lower().split()) in " ".join((r[2] or "").lower().split())]
    assert kept == [0]  # the first occurrence alone


def test_odd_rows(spark):
    long = "".join(f"one{i} two{i} three{i} four{i} five{i}. " for i in range(4000))
    docs = [(1, None), (2, ""), (3, "Hi."), (4, "Hi."), (5, long), (6, long), (7, "x " * 60), (8, "x " * 60),
            (9, "a b. c d.\n\n e"), (9, "a b. c d.\n\n e")]
    rows = spans.substring_dedup(frame(spark, [*docs, (None, long), (None, None)])).collect()
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in rows if r.doc_id is not None}
    assert got == plain(docs)
    assert got[6][2] == "" and got[5][2] == long and got[4][2] == "Hi." and got[8][1] == 4
    assert len(rows) == 12
    assert sorted((r.n_removed, r.text is None) for r in rows if r.doc_id is None) == [(0, False), (0, True)]
    assert spans.substring_dedup(frame(spark, docs).limit(0)).count() == 0


def test_repeated_rows_answer_alike(spark):
    text = "".join(f"a{i} b{i} c{i} d{i} e{i}. " for i in range(6))
    rows = spans.substring_dedup(frame(spark, [(1, text), (1, text), (2, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, 6), (2, 6)]


def test_sentences_make_up_the_text():
    rnd = random.Random(1)
    for _ in range(400):
        text = "".join(rnd.choice(["a ", "bb ", ". ", ".", "\n", "! ", "ccc"]) for _ in range(rnd.randint(0, 120)))
        parts = spans.sentences(text)
        assert "".join(text[a:b] for a, b in parts) == text
        assert all(len(text[a:b].split()) <= spans.LONGEST for a, b in parts)


def removed_words(first, second):
    """How many words of ``second`` runs of ``first`` cover."""
    known = set(spans.runs(first)[1])
    gone = {j for (i, e), h in zip(*spans.runs(second)) if h in known for j in range(i, e)}
    return sum(len(second[a:b].split()) for j, (a, b) in enumerate(spans.sentences(second)) if j in gone)


def test_passages_of_50_words_are_found_at_any_offset():
    rnd = random.Random(4)
    words = lambda n: [f"w{rnd.randint(0, 5000)}" for _ in range(n)]
    for trial in range(150):
        passage = words(50)
        for k in rnd.sample(range(50), trial % 5):  # from no sentence end to four
            passage[k] += "."
        texts = [" ".join(words(rnd.randint(0, 40)) + passage + words(rnd.randint(0, 40))) for _ in range(2)]
        assert removed_words(*texts) >= spans.ENOUGH


def test_unspaced_scripts_and_their_marks():
    rnd = random.Random(6)
    signs = lambda n: "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(n))
    assert len(spans.sentences("你好。再见！好？ 人।")) == 4
    for marks in (0, 3):
        for _ in range(30):
            passage = list(signs(100))
            for k in rnd.sample(range(100), marks):
                passage[k] += "。"
            first, second = (signs(rnd.randint(0, 60)) + "".join(passage) + signs(rnd.randint(0, 60)) for _ in range(2))
            assert set(spans.runs(first)[1]) & set(spans.runs(second)[1])
            assert "".join(second[a:b] for a, b in spans.sentences(second)) == second


def test_short_repeats_stay():
    text = lambda mid: "one two three four. " + mid + " five six seven eight. nine ten."
    assert removed_words(text("a b c d e f g h i j k l m n o."), text("q r s t u v w x y z a.")) == 0


def test_long_texts_of_tied_words_take_linear_time():
    import time
    began = time.process_time()
    assert spans.runs("a " * 200_000)[0] and spans.runs("\u4e00" * 20_000)[0]
    assert time.process_time() - began < 5
