import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.llm import lexical
from clickloom.llm.queries import QUERIES

from .conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_brute_force(documents, items, most=10):
    docs = [(doc, Counter(terms(text))) for doc, text in documents]
    docs = [(doc, held, held.total()) for doc, held in docs if held]
    n, total = len(docs), sum(size for _, _, size in docs)
    df = Counter(t for _, held, _ in docs for t in held)
    smallest = {}
    for item, text in items:
        if text is not None:
            smallest[item] = min(text, smallest.get(item, text), key=lambda t: t.encode())
    out = []
    for item, text in smallest.items():
        scored = []
        for doc, held, size in docs:
            if doc is None:
                continue
            m = 100 - 75 + (75 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1000000000 * held[t]) // (1000 * held[t] + 8 * m))
                for t in terms(text)
                if t in held
            )
            if score > 0:
                scored.append((-score, doc))
        out += [(item, k + 1, doc, -s) for k, (s, doc) in enumerate(sorted(scored)[:most])]
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def test_query_equals_brute_force(spark, texts, items):
    expected = by_brute_force(texts.items(), items)
    assert len(expected) > 100
    assert found(QUERIES["op13_presence_masks"](spark, SF)) == expected


@pytest.mark.parametrize("docs, item_bytes", [(3, 1 << 20), (8192, 200)])
def test_small_blocks_and_item_groups(spark, texts, items, monkeypatch, docs, item_bytes):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs)
    monkeypatch.setattr(lexical, "ITEM_BYTES", item_bytes)
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    some = items[:12]
    asked = spark.createDataFrame(some, "item_id long, text string")
    assert found(lexical.searched(documents, asked)) == by_brute_force(texts.items(), some)


def test_odd_rows(spark, odd):
    long = " ".join(f"w{i % 700}" for i in range(20_000))
    items = [
        (1, "alpha1 ALPHA1 bêta2 Gamma3"),
        (1, "the5 of6"),
        (2, None),
        (3, ""),
        (4, "... !!! |||"),
        (5, "nothing holds these"),
        (None, "texte with ODD spaces"),
        (6, long),
        (7, " ".join(f"{w}{i}" for w in ("alpha", "the", "of", "x") for i in range(100))),  # over 64 terms
        (8, "42 ünïcode Ünïcode 🙂"),
    ]
    clashing = {c: F.lit("clash") for c in ("doc_id", "score", "rank", "size", "terms", "item_group")}
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns(clashing)
    given = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()] + [(50, long)]
    documents = spark.createDataFrame(given, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("item_id", "n_terms", "counts", "term", "count")}
    )
    assert found(lexical.searched(documents, asked)) == by_brute_force(given, items)


def test_ties_go_by_doc_id(spark):
    rows = [(n, "same words here") for n in (9, 3, 7, 7, 1, 30, 20)] + [(40, "other text")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    ranked = sorted(lexical.searched(documents, items, most=5).collect(), key=lambda r: r["rank"])
    assert [r.doc_id for r in ranked] == [1, 3, 7, 7, 9]
    assert len({r.score for r in ranked}) == 1


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    documents = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert lexical.searched(empty, items).count() == 0
    assert lexical.searched(documents, items.limit(0)).count() == 0
    assert lexical.searched(documents, items).count() == 1


def test_few_documents_are_scored(spark, texts, items, monkeypatch):
    """The groups' maxima end the search before most documents that hold a term."""
    import numpy as np

    scored = []
    add = lexical._Top.add
    monkeypatch.setattr(
        lexical._Top, "add", lambda self, docs, scores: scored.append(len(docs)) or add(self, docs, scores)
    )
    rows = [lexical.terms_of(t) for t in texts.values()]
    numbers = {t: n for n, t in enumerate(sorted({t for r in rows for t in r}))}
    lists = [np.unique([numbers[t] for t in r], return_counts=True) for r in rows if r]
    import pyarrow as pa

    ends = pa.array(np.cumsum([0, *(len(a) for a, _ in lists)]), pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(lists)), pa.int64()),
            pa.array([int(c.sum()) for _, c in lists], pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate([a for a, _ in lists]), pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate([c for _, c in lists]), pa.int32())),
        ],
        names=["doc_id", "n_terms", "terms", "counts"],
    )
    block = lexical._Block([batch], len(lists), sum(len(r) for r in rows))
    holding = 0
    for _, text in items:
        own = np.unique([numbers[t] for t in lexical.terms_of(text) if t in numbers])
        held = np.concatenate([np.flatnonzero([n in a for a, _ in lists]) for n in own])
        holding += len(np.unique(held))
        lexical._search(block, own, np.full(len(own), 1000), lexical._Top(10))
    assert sum(scored) < 0.7 * holding
