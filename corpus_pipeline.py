"""The corpus pipeline: language identification, near-duplicate removal,
masking of personal data, mixing of sources and packing, over ``documents``.

Each stage works on all that the one before it kept and is written as Parquet
before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import langid, minhash, mixing, packing, pii
from contrail.llm.common import held_out
from contrail.llm.queries import END_ID, TOKENIZER
from contrail.session import cut_lineage, drop_path, scratch_path, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of a text's grams that its best language must hold: below it the text
#: is in none of the languages.
MIN_SCORE = 0.1
#: Words of a shingle in the near-duplicate stage.
SHINGLE = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the rows outside the held-out fold and drop the
    rows in none of them: null texts, texts without a letter, other languages."""
    model = langid.learn(docs.where(~held_out("doc_id", 4, 2)))
    found = langid.identify(docs, model)
    return found.where((F.col("lang_pred") != langid.UNKNOWN)
                       & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that with the least id (a
    null id comes last, ties go by row number). Every row is a document of its
    own, whether its id is null or listed before. Texts without words are in no
    group; an empty table stays empty."""
    rows = cut_lineage(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")
    found = minhash.near_duplicates(rows, id_col="_row", shingle=SHINGLE).select("_row", "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "_row")
    first = (found.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id")
             .agg(F.min(place).alias("first")).select("first._row"))
    return rows.join(first, "_row", "left_semi").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put each span's kind in its place; n_chars follows the text. Every row
    stays, whatever its id; null texts stay null, empty ones empty."""
    found = pii.find(docs, with_masked=True).withColumn("text", F.col("pii.masked"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat the documents of rare sources until the weights are met; every row
    stays at least once. A null source is one of its own; texts without words
    come along with every whole pass; an empty table stays empty."""
    return mixing.mix(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences. Null and empty texts are their end
    id alone, repeated rows are packed each; an empty table has no pieces."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), packing.SEQUENCE, END_ID)


STAGES = [("language_id", language), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("mix_sources", mix_sources), ("packing", pack)]

#: SQL expresses neither the filters nor the field nor the tokenizer: the
#: pipeline is tested against a plain version in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage writes for itself goes when its
    result is written, and that when the next one is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with temporary(spark):
            docs = cut_lineage(stage(spark, docs, sf_dir), path=path)
        if last:
            drop_path(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
