import hashlib
import re

from clickloom.llm import repeats
from clickloom.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_brute_force(rows):
    earliest = {}
    split = [(doc, WORD.findall(text or "")) for doc, text in rows]
    for doc, words in split:
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            if doc is not None:
                earliest[window] = min(earliest.get(window, doc), doc)
    out = []
    for doc, words in split:
        keep = [True] * len(words)
        for k in range(len(words) - 49):
            if doc is not None and earliest[tuple(words[k : k + 50])] < doc:
                keep[k : k + 50] = [False] * 50
        out.append((doc, len(words), keep.count(False), " ".join(w for w, k in zip(words, keep) if k)))
    return sorted(out, key=repr)


def test_query_removes_what_brute_force_removes(spark, texts):
    rows = QUERIES["op9_fixed_block_anchors"](spark, SF).collect()
    expected = by_brute_force(texts.items())
    assert sum(e[2] for e in expected) > 1000
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows], key=repr) == sorted(
        [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in expected], key=repr
    )


def test_odd_rows(odd):
    rows = repeats.without_repeats(odd).collect()
    given = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows], key=repr)
    assert found == by_brute_force(given)


def test_passages_at_every_offset(spark):
    words = [f"p{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for n in range(60):
        own = [f"a{n}_{i}" for i in range(n)]
        rows.append((n + 1, " ".join(own + words[n : n + 50 + n % 3 - 1] + [f"b{n}"])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.without_repeats(frame).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found], key=repr) == by_brute_force(rows)


def test_many_batches(spark, monkeypatch):
    """Windows of a text meet those of texts that another batch sent."""
    monkeypatch.setattr(repeats, "BATCH_BYTES", 1)
    passage = " ".join(f"q{i}" for i in range(80))
    rows = [(n, f"{n} {passage} {n}") for n in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.without_repeats(frame).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found], key=repr) == by_brute_force(rows)


def test_empty_table(empty):
    assert repeats.without_repeats(empty).count() == 0


def test_marks_miss_no_document(spark):
    import random

    from pyspark.sql import functions as F

    draw = random.Random(3)
    ids = [draw.randint(-(2**62), 2**62) for _ in range(3000)] + list(range(-20, 3000))
    hits = set(ids[::3])
    rows = spark.createDataFrame([(i, "t") for i in ids] + [(None, "t")], "doc_id long, text string")
    found = spark.createDataFrame([(i, b"") for i in hits], "doc_id long, keys binary")
    marked = {r.doc_id for r in repeats._marked(rows, found).filter("marked").collect()}
    assert hits <= marked and len(marked - hits) < 5
    none = repeats._marked(rows, found.limit(0))
    assert none.count() == len(ids) + 1 and none.filter("marked").count() == 0


def test_texts_without_hits_are_not_shuffled(spark):
    """Texts of one passage meet; the others pass from the scan to the result."""
    passage = " ".join(f"q{i}" for i in range(60))
    rows = [(n, " ".join(f"w{n}_{i}" for i in range(200))) for n in range(300)]
    rows += [(1000 + n, f"x{n} {passage}") for n in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked = []
    screened = repeats._screened
    repeats._screened = lambda rows, *a: asked.append(rows) or screened(rows, *a)
    try:
        found = repeats.without_repeats(frame).collect()
    finally:
        repeats._screened = screened
    assert {r.doc_id for r in asked[0].collect()} == {1000 + n for n in range(5)}
    assert sum(r.n_removed for r in found) == 4 * 60 and len(found) == 305


def _some_texts(n):
    import random

    draw = random.Random(6)
    passages = [" ".join(f"p{k}_{i}" for i in range(70)) for k in range(5)]
    rows = []
    for doc in range(n):
        own = " ".join(f"w{draw.randint(0, 10**6)}" for _ in range(draw.randint(20, 300)))
        rows.append((doc, f"{own} {draw.choice(passages) if doc % 3 else ''} {doc}"))
    return rows


def test_ranges_are_cut_into_parts(spark, monkeypatch):
    """Few ranges of many parts, gathered from many batches."""
    monkeypatch.setattr(repeats, "RANGES", 4)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 5000)
    monkeypatch.setattr(repeats, "parts_for", lambda *_: 150)
    rows = _some_texts(120)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = repeats.without_repeats(frame).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found], key=repr) == by_brute_force(rows)


def test_packed_rows_do_not_grow_with_parts(spark, monkeypatch):
    """Rows that a batch sends, for parts below and far beyond the ranges."""
    monkeypatch.setattr(repeats, "RANGES", 16)
    frame = spark.createDataFrame(_some_texts(400), "doc_id long, text string").coalesce(2)
    sent = []
    cut = repeats._cut_into_parts
    monkeypatch.setattr(
        repeats, "_cut_into_parts", lambda packed, *a: sent.append(packed.filter("known is null").count()) or cut(packed, *a)
    )
    for parts in (64, 512, 4096):
        repeats._shared(frame, parts, repeats._probes, anchors=True)
    assert sent[0] == sent[1] == sent[2] <= 2 * 16
