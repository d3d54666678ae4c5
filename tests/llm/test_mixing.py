from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import mixing
from clickloom.llm.production import PERCENT, WEIGHTS, domain_of_source

from .test_merkle import against_duckdb


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    rows = against_duckdb(spark, "op6_hierarchical_mixing", f"/root/testdata/{sf}")
    assert len(rows) > 100


def poured(capacity, weight, budget):
    """Budgets by raising the level step by step."""
    given = dict.fromkeys(capacity, 0.0)
    left, open_ = float(budget), set(capacity)
    while open_ and left > 1e-9:
        step = min([left / sum(weight[c] for c in open_)] + [(capacity[c] - given[c]) / weight[c] for c in open_])
        for c in open_:
            given[c] += step * weight[c]
        left = budget - sum(given.values())
        open_ = {c for c in open_ if capacity[c] - given[c] > 1e-9}
    return given


def test_shortages_go_to_siblings_first(spark):
    rows = [
        # path, tokens: web/en has one small and two large sources
        ("web", "en", "a", 10), ("web", "en", "b", 1000), ("web", "en", "c", 1000),
        ("web", "de", "d", 1000), ("books", "en", "e", 50),
    ]
    frame = spark.createDataFrame(rows, "domain string, lang string, source string, n_tokens long")
    budgets = {
        r.source: r.budget
        for r in mixing.leaf_budgets(frame, 30, {}, epochs=1).collect()
    }
    domain = poured({"web": 3010, "books": 50}, {"web": 1, "books": 1}, 918)
    language = poured({"en": 2010, "de": 1000}, {"en": 1, "de": 1}, domain["web"])
    source = poured({"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 1, "c": 1}, language["en"])
    expected = source | {"d": language["de"], "e": domain["books"]}
    assert budgets["a"] == 10 and budgets["e"] == 50
    assert all(abs(budgets[k] - v) <= 2 for k, v in expected.items())


def test_leaves_fill_their_budgets(spark):
    sf = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mixed(documents, domain_of_source(), PERCENT, WEIGHTS).collect()
    tokens, taken, cut = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        leaf = (r.domain, r.lang, r.source)
        tokens[leaf] += r.n_tokens
        taken[leaf] += r.selected_tokens
        cut[leaf] += 0 < r.partial_tokens < r.n_tokens
    total = sum(tokens.values())
    assert 0 <= total * PERCENT // 100 - sum(taken.values()) < len(tokens) + 20
    assert max(cut.values()) == 1  # a prefix ends inside one document at most
    assert all(taken[k] <= mixing.MOST_EPOCHS * n for k, n in tokens.items())


def test_odd_rows(odd, empty):
    rows = mixing.mixed(odd, F.lit(None), 50, {"lang": {"en": 3}}).collect()
    assert len(rows) == odd.count()
    assert {(r.domain, r.source) for r in rows if r.doc_id is None} == {("?", "src3"), ("?", "?")}
    assert all(r.selected_tokens == 0 for r in rows if r.n_tokens == 0)
    everything = mixing.mixed(odd, F.lit("d"), 400, {}, keyed=True)
    assert {r.full_epochs for r in everything.collect() if r.n_tokens} == {4}
    kept = mixing.selected(odd, everything)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]  # the row without doc_id that has words is one
    assert sorted(i for i in ids if i is not None) == [4, 5, 6, 7, 8, 9, 9, 10, 11]
    assert ids.count(None) == 1
    none = mixing.mixed(empty, F.lit("d"), 50, {}, keyed=True)
    assert none.count() == 0 and mixing.selected(empty, none).count() == 0
