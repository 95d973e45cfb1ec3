"""Language filters: held-out accuracy, false positives, odd rows."""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections import Counter

import numpy as np

from contrail.llm import langid
from contrail.llm.queries import op2_language_id

WORDS = {"en": ["the", "and", "thing", "with", "other", "water"],
         "de": ["der", "und", "schön", "nicht", "straße", "wasser"],
         "fr": ["le", "être", "avec", "où", "maison", "voilà"]}


def docs(n=90):
    rng = np.random.default_rng(3)
    return [(i, " ".join(rng.choice(WORDS[lang], 12)), lang)
            for i, lang in enumerate(["en", "de", "fr"] * (n // 3))]


def test_language_id_learns_and_holds_out(spark):
    rows = [(*r, "x", "y") for r in docs()]
    frame = spark.createDataFrame(
        rows + [(900, None, "en", "x", "y"), (901, "", "de", "x", "y"), (902, "12 ?!", "fr", "x", "y"),
                (903, "the and with " * 3000, None, "x", "y"), (None, "und der nicht", "de", "x", "y"),
                (5, rows[5][1], "fr", "x", "y")],
        "doc_id long, text string, lang string, lang_pred string, held_out string")
    out = langid.language_id(frame)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == 96
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].lang_pred == lang for i, _, lang in docs())
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(90))
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert by[903].lang_pred == "en"
    none = [r for r in got if r.doc_id is None]
    assert [(r.lang_pred, r.held_out) for r in none] == [("de", False)]
    assert all(0 <= r.score <= 1 for r in got)
    assert len([r for r in got if r.doc_id == 5]) == 2


def test_no_labels_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.language_id(frame).collect()] == [("und", 0.0)]
    assert langid.language_id(frame.limit(0)).count() == 0


def test_filter_returns_every_language_of_a_gram_and_few_others():
    """Against exact sets: no misses, and false hits near the corrected rate."""
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 62, 3000)) for _ in range(70)]  # two mask words
    bits = 17
    table = np.zeros((1 << bits, 2), np.uint64)
    for i, own in enumerate(sets):
        for s in langid.slots(own, bits):
            np.bitwise_or.at(table[:, i // 64], s, np.uint64(1 << (i % 64)))
    f = langid.Filter([f"l{i:02d}" for i in range(70)], table, bits)
    for i in (0, 63, 64, 69):
        at = langid.slots(sets[i], bits)
        mask = table[at[0]] & table[at[1]] & table[at[2]]
        assert ((mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    strange = rng.integers(0, 1 << 62, 20000)
    at = langid.slots(strange, bits)
    mask = table[at[0]] & table[at[1]] & table[at[2]]
    rate = np.mean((mask[:, 0] >> np.uint64(5)) & np.uint64(1))
    assert abs(rate - f.false[5]) < 0.002


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Ein schöner Tag, nicht wahr? " * 40
    whole = np.sort(np.concatenate(list(langid.grams(text))))
    monkeypatch.setattr(langid, "text_slices", lambda t: __import__(
        "contrail.llm.common", fromlist=["x"]).text_slices(t, 50))
    assert (np.sort(np.concatenate(list(langid.grams(text)))) == whole).all()


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op2_language_id(spark, sf).where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)


def test_languages_with_one_and_three_learned_texts(spark):
    few = [("xx", "kwizo pluvrag zenthi"), *(("yy", t) for t in ("bolmak tirfen", "gursho vadlep", "nimquo hesjat"))]
    rows = [*docs(), *((500 + i, text, lang) for i, (lang, text) in enumerate(few))]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for lang, text in few:
        got, score = model.decide(text)
        assert got == lang and score > 0.9
    assert all(model.decide(text)[0] == lang for _, text, lang in docs())


def test_decisions_equal_a_plain_version(spark):
    """Filter, corrected counts and scores in plain numbers, text by text."""
    import math
    rng = random.Random(4)
    words = {"aa": ["tha", "wern", "ost", "lith"], "bb": ["qui", "mundo", "ésta", "ñor"], "cc": ["да", "нет", "мир"]}
    docs = [(i, " ".join(rng.choice(words[lang]) + rng.choice(["", "x", "yz"]) for _ in range(rng.randint(1, 30))), lang)
            for i in range(120) for lang in [rng.choice(list(words))]]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "12 !", "cc"), (903, "ost мир qui", "aa"), (904, "zzz", None)]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string")
    held = [d for d in docs + odd if d[2] is not None and zlib.crc32(str(d[0]).encode()) % 4 != 2]

    def grams(text):
        out = []
        for w in "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()).split():
            w = f" {w} "
            out += [(ord(w[i]) << 42) | (ord(w[i + 1]) << 21) | ord(w[i + 2]) for i in range(len(w) - 2)]
        return out

    kept = {}
    for lang in sorted({d[2] for d in held}):
        own = [set(grams(t)) for _, t, x in held if x == lang]
        df = Counter(g for s in own for g in s)
        least = max(1 if len(own) < langid.FEW_TEXTS else 2, math.ceil(len(own) * langid.MIN_SHARE))
        kept[lang] = {g for g, n in df.items() if n >= least}
    bits = max(12, math.ceil(math.log2(8 * langid.HASHES * max(1, *map(len, kept.values())))))

    def slots(g):
        u = g ^ (g >> 29)
        return [((u * a) % (1 << 64)) >> (64 - bits) for a in langid._ODD[:langid.HASHES]]

    filled = {lang: {s for g in own for s in slots(g)} for lang, own in kept.items()}
    want = {}
    for i, text, _ in docs + odd:
        found = grams(text)
        best = ("und", 0.0)
        if found:
            for lang in sorted(kept):
                false = (len(filled[lang]) / (1 << bits)) ** langid.HASHES
                hits = sum(all(s in filled[lang] for s in slots(g)) for g in found)
                share = min(1, max(0, (hits / len(found) - false) / (1 - false)))
                if best[0] == "und" or share > best[1]:
                    best = (lang, share)
        want[i] = best
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language_id(frame).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
