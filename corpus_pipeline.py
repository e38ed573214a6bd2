"""A corpus from documents: toxic, repeated and leaked ones go, sources are mixed, ids are written."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import decontam, mixing, simhash, tokenstore, toxicity
from stratalake.llm.common import stored, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model learns from this input."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.without_near_duplicates(docs, shingle=3, radius=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document by its Poisson count, for equal shares of all sources, in random order."""
    return mixing.mixed(docs, mixing.source_rates(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Files of ids in the order of the stored mixture, and where each document is in them."""
    files = tokenstore.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), order=tokenstore.stored_order())
    return tokenstore.read_tokens(files)


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_output", token_ids),
]

#: SQL has neither the toxicity model nor XXH64; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again by the next."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name)
    return rows
