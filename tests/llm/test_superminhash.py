import re

import numpy as np
from pyspark.sql import functions as F

from clickloom.llm import superminhash
from clickloom.llm.components import components
from clickloom.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_brute_force(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_query_finds_what_brute_force_finds(spark, texts):
    rows = QUERIES["op2_superminhash"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == by_brute_force(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_chain_of_edits_is_one_component(spark):
    base = [f"w{i}" for i in range(400)]
    chain = {100 - n: " ".join(base[:n * 2] + [f"x{i}" for i in range(n * 2)] + base[n * 2:]) for n in range(12)}
    expected = by_brute_force(chain)
    frame = spark.createDataFrame(list(chain.items()), "doc_id long, text string")
    rows = superminhash.near_duplicates(frame).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert len({c for _, c in expected.values()}) < len(chain)


def test_members_that_miss_the_hub_still_meet(spark, monkeypatch):
    """Pairs inside a bucket that only the second comparison can link, over blocks."""
    monkeypatch.setattr(superminhash, "BLOCK", 2)
    base = [f"w{i}" for i in range(300)]
    texts = {1: " ".join(base)}
    for n in range(8):
        own = base[:40 + n] + ["y" * (n % 2 + 1)] * 30 + base[70 + n:]
        texts[n + 2] = " ".join(own)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = superminhash.near_duplicates(frame).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == by_brute_force(texts)


def test_odd_rows(odd):
    rows = superminhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [found[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(found[i].component_id == i and found[i].kept for i in (1, 2, 3, 4))
    assert found[6].component_id == 5 and not found[6].kept
    assert found[9].component_id == 7
    loose = sorted((r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is None and r.n_shingles)
    assert [x[1] for x in loose] == [7] and not loose[0][2]
    kept = superminhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8, 10, 11]


def test_empty_table(empty):
    assert superminhash.near_duplicates(empty).count() == 0
    assert superminhash.deduplicated(empty).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    values = draw.integers(0, 2**63, 900, dtype=np.uint64)
    for share in (0.3, 0.6, 0.9):
        n = int(600 * share)
        a, b = values[:600], np.concatenate([values[:n], values[600 : 1200 - n]])
        real = n / (1200 - n)
        rows = superminhash.superminhash([np.unique(a), np.unique(b)])
        assert abs((rows[0] == rows[1]).mean() - real) < 0.15


def test_small_sets_use_each_slot_of_an_element_once():
    rows = superminhash.superminhash([np.array([7], np.uint64), np.array([7, 9], np.uint64)])
    assert (rows[0] == rows[1]).mean() > 0.3


def test_components(spark):
    edges = [(n, n + 1) for n in range(50)] + [(100, 5), (200, 201), (7, 7), (None, 3), (201, 200)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {n: 0 for n in (*range(1, 51), 100)} | {201: 200}
    assert {r.node: r.component for r in rows} == expected


def near_copies(n, seed, words=240, changed=24):
    """Copies of one text, each with a few words changed: some pairs are linked, others not."""
    draw = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(words)]
    texts = {}
    for i in range(n):
        own = list(base)
        for at in draw.choice(words // 5, draw.integers(0, changed // 5 + 1), replace=False):
            own[at * 5] = f"c{draw.integers(0, 40)}"
        texts[int(i)] = " ".join(own)
    return texts


def test_a_group_of_two_thousand_near_copies(spark, monkeypatch):
    """Rows of the comparison stay below the members of its buckets."""
    texts = near_copies(2000, 5)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    forests = []
    forest = superminhash._forest
    monkeypatch.setattr(
        superminhash, "_forest", lambda members, sets: forests.append((members, forest(members, sets))) or forests[-1][1]
    )
    rows = superminhash.near_duplicates(frame).collect()
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if root(a) != root(b):
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((root(a), root(b)))
                    group[high] = low
    assert {r.doc_id: r.component_id for r in rows} == {i: root(i) for i in sets}
    (members, links), = forests
    assert links.count() <= members.count() <= 2000 * superminhash.BANDS


def test_links_of_a_group_make_the_components_of_all_links():
    import pyarrow as pa

    texts = near_copies(120, 6)
    sets = [superminhash.shingle_set(t) for t in texts.values()]
    for across in (False, True):
        own = [i % 2 if across else 0 for i in range(len(sets))]
        table = pa.table(
            {
                "class_id": list(texts),
                "component": list(texts),
                "own": own,
                "block": [0] * len(sets),
                "with_block": [int(across)] * len(sets),
                "elements": [s.tobytes() for s in sets],
            }
        )
        group = {i: i for i in texts}

        def root(x):
            while group[x] != x:
                x = group[x]
            return x

        def join(a, b):
            low, high = sorted((root(a), root(b)))
            group[high] = low

        links = superminhash._links_of_group(table)
        assert len(links) < len(sets)
        for a, b in links:
            join(a, b)
        found = {i: root(i) for i in texts}
        group = {i: i for i in texts}
        for a in texts:
            for b in range(a):
                common = len(np.intersect1d(sets[a], sets[b]))
                linked = 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common)
                if linked and (not across or own[a] != own[b]):
                    join(a, b)
        assert found == {i: root(i) for i in texts}


def test_rows_of_one_doc_id_with_different_texts_are_judged_each(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, b), (3, c), (2, c), (4, a), (5, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rows", F.lit("clash"))
    kept = superminhash.deduplicated(docs)
    assert kept.columns == ["doc_id", "text", "rows"]
    found = sorted(((r.doc_id, r.text or "") for r in kept.collect()))
    # 2's rows are copies of 1's and of the smallest document with c, which is 2 itself
    assert found == [(1, a), (1, b), (2, c), (5, "")]
