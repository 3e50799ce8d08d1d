"""From raw documents to token ids: five stages, each written and read again before the next.

For all stages: null and empty texts are texts without words (only the first stage drops them), very long texts are read whole,
repeated rows are treated alike, rows with a null id stay unless their own text decides, an empty table gives an empty table, and
further columns, whatever their names, pass unchanged through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm import op2_decontaminate, op4_pii, op5_language, op7_jaccard, op10_bpe
from opslake.llm.common import without, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to which the classifier gives a language stay, whichever; those it rejects (und: null text or no letter) go.

    Its doubt alone rejects nothing: clean texts in a mixture of languages, or short ones, are to stay. A row with a null id stays.
    """
    found = op5_language.identify(docs, op5_language.fit(docs))
    return without(docs, found.where("lang_pred = 'und'").select("doc_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id stays; texts without words link with nothing and stay.

    Rows that repeat an id stay or go together.
    """
    classes = op7_jaccard.components(docs)
    return without(docs, classes.where("doc_id <> component_id").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whichever of several items; without items all stay."""
    hits = op2_decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, hits.select("doc_id"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities get surrogates; n_chars is the length of the new text, and stays as it was for null texts."""
    return op4_pii.pseudonymize(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, one row for each document; null and empty texts have no ids."""
    return op10_bpe.encode(docs, TOKENIZER).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pii", pii), ("tokens", tokens),
]

#: Classifiers, a similarity join and a tokenizer aren't expressible in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
