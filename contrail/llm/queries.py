"""Registered queries of the training-data operators, with production
parameters over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, langid, minhash, mixing, packing, pii, quality, search, spans, suffixes,
               toxicity, vectors, whitening)
from .common import table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                        packing.SEQUENCE, END_ID)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_copy", "mix_weight", "mix_tokens",
                        F.col("mix_order.block_place").alias("mix_block_place"),
                        F.col("mix_order.block").alias("mix_block"),
                        F.col("mix_order.row_place").alias("mix_row_place"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=minhash.SHINGLE)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.substring_dedup(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.suffix_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER),
        public_tokenizers.path(PIECE_TOKENIZER))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_language_id, op3_source_mixing, op4_quality, op5_near_duplicates,
    op6_substring_dedup, op7_personal_data, op8_toxicity, op9_near_vectors, op10_top_k,
    op11_embedding_whitening, op12_suffix_dedup, op13_tokenizer_alignment)}

_USABLE = """embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""

_REACH = """reach(id, c) AS (
  SELECT DISTINCT id, id FROM nodes
  UNION
  SELECT e.b, r.c FROM reach r JOIN links e ON e.a = r.id)"""

SQL: dict[str, str] = {
    "op5_near_duplicates": r"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM d),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS an, any_value(y.n) AS bn, count(*) AS m
  FROM items x JOIN items y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM pairs WHERE 100 * m >= 80 * (an + bn - m)),
links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
nodes AS (SELECT doc_id AS id FROM documents),
""" + _REACH + """
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
FROM sets s JOIN (SELECT id, min(c) AS c FROM reach GROUP BY id) r ON s.doc_id = r.id""",
    "op9_near_vectors": f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND {_USABLE} AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH}
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, r.c AS component_id, e.vec_id = r.c AS kept
FROM embeddings e JOIN (SELECT id, min(c) AS c FROM reach GROUP BY id) r ON e.vec_id = r.id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON e.vec_id = n.a""",
    "op10_top_k": f"""WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE {_USABLE} AND len(embedding) > 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score FROM s QUALIFY rank <= 5""",
    "op12_suffix_dedup": """WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, md5(substring(h, 2 * p + 1, 200)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
f AS (SELECT s, min((doc_id, p)) AS place FROM w GROUP BY s HAVING count(*) > 1),
r AS (
  SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS q
  FROM w JOIN f ON w.s = f.s WHERE (w.doc_id, w.p) <> f.place),
g AS (
  SELECT doc_id, p, count_if(q IS NULL OR p > q + 100) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM r),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, n),
cuts AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM spans
  UNION ALL
  SELECT d.doc_id, len(d.h) // 2, coalesce(max(s.b), 0) FROM d LEFT JOIN spans s ON d.doc_id = s.doc_id
  GROUP BY d.doc_id, d.h),
kept AS (
  SELECT c.doc_id, string_agg(substring(d.h, 2 * c.z + 1, 2 * (c.a - c.z)), '' ORDER BY c.z) AS k
  FROM cuts c JOIN d ON c.doc_id = d.doc_id GROUP BY c.doc_id),
gone AS (SELECT doc_id, sum(b - a) AS m, count(*) AS n FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone.m, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(gone.n, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.k)) AS kept_sha256
FROM d JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN gone ON d.doc_id = gone.doc_id""",
}
