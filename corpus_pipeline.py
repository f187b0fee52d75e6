"""Corpus preparation: language ID, line dedup, near-duplicate removal,
benchmark decontamination and tokenisation of ``documents``.

Every stage reads all rows its predecessor kept. The first four return the
columns of ``documents``, with ``n_chars`` counted again where the text
changes; the last adds ``token_ids`` and ``decodes_back``. Rows without id are
never duplicates of others and stay; empty texts are rejected by the first
stage, texts that line dedup empties by the second; a text that consists of
benchmark passages stays as an empty row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm import bpe, decontaminate, langid, line_templates, similarity_join
from touchline.llm.common import ship, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _as_documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.char_length("text").cast("bigint")).select(COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or of no known language go."""
    ship(spark)
    model = langid.fit(docs)
    found = langid.predict(docs.select(COLUMNS), model, known=True)
    if model is None:  # nothing to learn from: only texts without letters go
        return found.where(F.col("text").rlike(r"\p{L}")).select(COLUMNS)
    return found.where("known").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first; a
    document of which nothing is left goes with them."""
    kept = line_templates.drop_recurring_lines(docs.select(COLUMNS))
    return _as_documents(kept.where("n_dropped = 0 or trim(text) <> ''"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id
    stays: all its unlike texts, of rows that repeat one text the first."""
    ship(spark)
    groups = similarity_join.near_duplicates(docs)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(COLUMNS).join(kept, "doc_id", "left_semi")
    once = rows.withColumn("r", F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang", "n_chars")))
    return once.where("r = 1").select(COLUMNS).union(docs.where("doc_id is null").select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    ship(spark)
    found = decontaminate.find(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))
    return _as_documents(decontaminate.removed(found))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding."""
    ship(spark)
    return bpe.tokenized(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokenization", tokenization),
]

# language ID is a fitted classifier, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
