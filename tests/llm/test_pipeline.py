"""The pipeline against a plain version of its stages; the guard of the entry."""

from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter

import pytest
import public_tokenizers

import corpus_pipeline
from contrail.llm import langid, minhash, mixing, packing, pii
from contrail.llm.common import held_out

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's rows, each written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(10_001, None, "en", "src1", 0), (10_002, "", None, None, 0), (10_003, "123 ... 456", "de", "src2", 11),
         (None, "the thing and that in the water", "en", "src3", 31)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(1))
    home, out = tmp_path_factory.mktemp("stages"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(str(home / name))
        out.append(spark.read.parquet(str(home / name)))
    return [df.collect() for df in out], out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "personal_data", "mix_sources", "packing"]
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[1][1:-1])


def test_language_stage(stages, spark):
    (before, after, *_), frames = stages
    model = langid.learn(frames[0].where(~held_out("doc_id", 4, 2)))
    want = Counter()
    for r in before:
        lang, score = model.decide(r.text)
        if lang != "und" and score >= corpus_pipeline.MIN_SCORE:
            want[r] += 1
    assert Counter(after) == want
    assert len(before) - len(after) == 3  # null, empty, no letter


def one_of_each_group(rows) -> Counter:
    """Brute force over all pairs of rows."""
    sets = [set(minhash.shingle_set(r.text, corpus_pipeline.SHINGLE).tolist()) for r in rows]
    own = list(range(len(rows)))

    def find(a):
        while own[a] != a:
            a = own[a]
        return a
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                own[find(b)] = find(a)
    best = {}
    for i, r in enumerate(rows):
        key = (r.doc_id is None, r.doc_id or 0)
        best[find(i)] = min(best.get(find(i), (key, i)), (key, i))
    return Counter(rows[i].doc_id for _, i in best.values())


def test_near_duplicate_stage(stages):
    _, before, after, *_ = stages[0]
    assert Counter(r.doc_id for r in after) == one_of_each_group(before) and len(after) < len(before)
    assert Counter(after) <= Counter(before)


def test_rows_that_share_an_id_are_documents_each(spark):
    def text(seed, n=60):
        return " ".join(f"w{(seed * 7919 + i * i) % 997}" for i in range(n))
    rows = [(3, text(1)), (7, text(1) + " more"), (7, text(2)), (9, text(3)), (9, text(3)), (None, text(2)),
            (None, text(4)), (None, None), (12, ""), (12, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(
        [(3, text(1)), (7, text(2)), (9, text(3)), (None, text(4)), (None, None), (12, ""), (12, " ")], key=str)
    assert Counter(r.doc_id for r in got) == one_of_each_group(docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_personal_data_stage(stages, spark):
    _, _, before, after, *_ = stages[0]
    field = pii.train(spark)
    want = Counter()
    for r in before:
        (_, spans), = pii.all_spans([r.text], field)
        text = pii.masked(r.text, spans)
        want[r.doc_id, text, r.lang, r.source, len(text)] += 1
    assert Counter(tuple(r) for r in after) == want
    assert any("<EMAIL>" in r.text for r in after)


def test_mixing_stage(stages):
    _, _, _, before, after, _ = stages[0]
    once, copies = Counter(before), Counter(after)
    assert set(once) == set(copies)  # no document is left out
    size = Counter()
    for r in before:
        size[r.source] += len(r.text.split())
    names = sorted(size, key=lambda s: (s is not None, s or ""))
    exponent = mixing.solve([size[s] for s in names], None, mixing.MAX_REPEAT)
    for s, budget in zip(names, mixing.budgets([size[s] for s in names], exponent, None)):
        own = [r for r in after if r.source == s]
        longest = max(len(r.text.split()) for r in own)
        assert budget - longest <= sum(len(r.text.split()) for r in own) <= budget


def test_packing_stage_and_run(stages, spark):
    before, pieces = stages[0][-2], stages[0][-1]
    code = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(code(r.text)) // 4 + 1 for r in before)
    assert sum(r.length for r in pieces) == total
    assert len({r.sequence_id for r in pieces}) == -(-total // packing.SEQUENCE)
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).columns == stages[1][-1].columns


def test_the_rest_works_without_this_part(tmp_path):
    """Without the subpackage and the pipeline the entry still imports."""
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "contrail", ".git"):
            os.symlink(os.path.join(root, name), tmp_path / name)
    os.mkdir(tmp_path / "contrail")
    for name in os.listdir(os.path.join(root, "contrail")):
        if name != "llm":
            os.symlink(os.path.join(root, "contrail", name), tmp_path / "contrail" / name)
    with open(os.path.join(root, "__spark_entry__.py")) as f:
        (tmp_path / "entry_copy.py").write_text(f.read())
    said = subprocess.run(
        [sys.executable, "-B", "-c", "import entry_copy as e; print(sorted(e.queries())[-1], len(e.oracle_sql()))"],
        cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    last, n = said.stdout.split()
    assert last == f"q{int(n):02d}", said.stderr
