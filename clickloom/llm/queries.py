"""The queries of the operators, by name, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe,
    factorisation,
    langid,
    lexical,
    lines,
    merkle,
    mixing,
    onebit,
    pstable,
    repeats,
    secrets,
    superminhash,
    syncmers,
)
from clickloom.llm.oracle import ORACLE  # noqa: F401
from clickloom.llm.production import (
    ALTERED,
    ANCHORS,
    DAMAGE,
    LABELS,
    LOST,
    PERCENT,
    RELABELLED,
    TWICE,
    WEIGHTS,
    domain_of_source,
    owner_and_repository,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    turn = F.pmod("page_id", F.lit(DAMAGE))
    held = F.when(turn == ALTERED, F.concat(F.col("html"), F.lit("#"))).otherwise(F.col("html"))
    replica = merkle.archived(pages, held).withColumn("turn", turn)
    end = F.max(F.col("record_offset") + F.col("record_length"))
    replica = replica.withColumn("end", end.over(Window.partitionBy("archive")))
    second = replica.filter(F.col("turn") == TWICE).withColumn(
        "record_offset", F.col("record_offset") + F.col("end")
    )
    left = replica.filter(~F.col("turn").eqNullSafe(F.lit(LOST)))
    found = left.unionByName(second).drop("turn", "end")
    return merkle.audit(merkle.archived(pages), found).drop("range_no")


def superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def line_labelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return lines.measured(documents, lines.train(documents, _table(spark, sf_dir, "labels")))


def factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    machine = factorisation.train(documents, labels.filter(~factorisation.held_out()))
    scored = factorisation.scored(documents, machine)
    return scored.select(
        "doc_id",
        factorisation.held_out().alias("held_out"),
        "score",
        (F.col("score") >= factorisation.THRESHOLD).cast("int").alias("predicted"),
    )


def secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return secrets.reported(secrets.judged(documents, *owner_and_repository()))


def hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return mixing.mixed(documents, domain_of_source(), PERCENT, WEIGHTS)


def syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compared(_table(spark, sf_dir, "documents"))


def forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def bpe_digests(documents: DataFrame) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(documents, path), path)
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    left = repeats.without_repeats(documents, lambda kept: F.sha2(kept.cast("binary"), 256))
    return left.withColumnRenamed("kept", "kept_sha256")


def hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = langid.train(documents.filter(~langid.held_out()))
    found = langid.identify(documents, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS)
    labelled = embeddings.withColumn("label", moved.otherwise(F.col("label")))
    return onebit.hard_negatives(labelled, F.col("vec_id") % ANCHORS == 0)


def pstable_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.linked(_table(spark, sf_dir, "embeddings"))


def presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.searched(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_merkle_audit": merkle_audit,
    "op2_superminhash": superminhash_dedup,
    "op3_line_labelling": line_labelling,
    "op4_factorisation_machine": factorisation_machine,
    "op5_secret_ownership": secret_ownership,
    "op6_hierarchical_mixing": hierarchical_mixing,
    "op7_closed_syncmers": syncmer_fingerprints,
    "op8_forced_boundary_bpe": forced_boundary_bpe,
    "op9_fixed_block_anchors": fixed_block_anchors,
    "op10_hierarchical_language": hierarchical_language,
    "op11_one_bit_codes": one_bit_codes,
    "op12_pstable_hashing": pstable_hashing,
    "op13_presence_masks": presence_masks,
}
