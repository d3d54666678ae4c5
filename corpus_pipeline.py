"""The documents through a training-data pipeline, stage by stage.

Each stage is written as Parquet below the shared scratch folder and read again by
the next one. All stages but the last return the columns of `documents`, other ones
than the five known ones included, whatever their names.

Rows that repeat a doc_id are documents of their own: near_dedup keeps one of those with
the same words, mixture draws them together. Rows without doc_id are never
duplicates of a group's representative; mixture draws those of one text together. A null
or empty text goes in the first stage, and no later stage needs a doc_id, lang or source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import langid, mixing, secrets, superminhash
from clickloom.llm.production import WEIGHTS, domain_of_source, owner_and_repository
from clickloom.llm.queries import bpe_digests
from clickloom.session import ship_code, stored

#: The mixture's budget, per cent of the tokens that reach it, read once at most.
MIX_PERCENT, MIX_EPOCHS = 80, 1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognizable language go: no text, no letter, or nothing
    to learn languages from. `lang` becomes the predicted one where it was missing."""
    found = langid.train(docs.filter(~langid.held_out()))
    return langid.accepted(docs, found)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return superminhash.deduplicated(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked in the text; every document stays."""
    return secrets.masked(docs, *owner_and_repository())


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn towards the target weights, each once at most."""
    drawn = mixing.mixed(docs, domain_of_source(), MIX_PERCENT, WEIGHTS, epochs=MIX_EPOCHS, keyed=True)
    return mixing.selected(docs, drawn)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe_digests(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("secret_masking", secret_masking),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL can't express the trained model, the signatures or the tokenizer; the tests hold
#: the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table of documents."""
    ship_code(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
