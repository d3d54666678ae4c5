import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clickloom.llm import mixing, secrets
from clickloom.llm.production import WEIGHTS, domain_of_source, owner_and_repository
from clickloom.session import stored

from .conftest import SF
from .test_superminhash import by_brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    planted = [(9000, None, "en", "src1", 0), (9001, "123 ### 456", "en", "src1", 11)]
    kept = {}
    docs = docs.select(COLUMNS).union(spark.createDataFrame(planted, docs.select(COLUMNS).schema))
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        kept[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == COLUMNS

    before, after = kept["language"]
    gone = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert gone == {9000, 9001}

    before, after = kept["near_dedup"]
    groups = by_brute_force({r.doc_id: r.text for r in before.collect()})
    assert {r.doc_id for r in after.collect()} == {c for _, c in groups.values()}

    before, after = kept["secret_masking"]
    assert before.count() == after.count()
    judged = secrets.judged(after, *owner_and_repository())
    assert judged.filter(F.exists("spans", lambda s: s["live"])).count() == 0

    before, after = kept["mixture"]
    drawn = mixing.mixed(before, domain_of_source(), corpus_pipeline.MIX_PERCENT, WEIGHTS, epochs=1)
    chosen = {r.doc_id for r in drawn.filter("selected_tokens > 0").collect()}
    assert {r.doc_id for r in after.collect()} == chosen and len(chosen) < before.count()

    before, after = kept["tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        ids = library.encode(texts.pop(r.doc_id), add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert not texts


def test_odd_rows_pass_every_stage(spark, odd):
    """Repeated and missing doc_ids, nulls, empty and very long texts, clashing names."""
    docs, rows = odd, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        if name != "tokens":
            assert docs.columns == odd.columns
        rows[name] = sorted((r.doc_id for r in docs.collect()), key=repr)
    # of the two rows without doc_id the one with a text stays, next to its copies
    assert rows["language"] == sorted([4, 5, 6, 7, 8, 9, 9, 10, None], key=repr)
    assert rows["near_dedup"] == sorted([4, 5, 7, 8, 10, None], key=repr)
    assert rows["secret_masking"] == rows["near_dedup"]
    assert rows["mixture"] and set(rows["mixture"]) <= set(rows["near_dedup"])
    assert rows["tokens"] == rows["mixture"]


def test_run_is_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < rows.count() < 200


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
