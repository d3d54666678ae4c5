import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from clickloom.llm import syncmers
from clickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def edited(text, following):
    text, following = text or "", following or ""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def check(rows, given):
    """rows by doc_id; given (doc_id, text) in order."""
    for n, (doc, text) in enumerate(given):
        expected = edited(text, given[(n + 1) % len(given)][1])
        assert rows[doc].edited_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert rows[doc].n_chars == len(text or "")


def test_query_edits_with_the_next_document(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in QUERIES["op7_closed_syncmers"](spark, SF).collect()}
    given = sorted((r.doc_id, r.text) for r in documents)
    check(rows, given)
    by_text, by_print = {}, {}
    for doc, text in given:
        assert by_text.setdefault(text, rows[doc].fingerprint) == rows[doc].fingerprint
        by_print.setdefault(rows[doc].fingerprint, text)
    near = [rows[d].near_edited for d, t in given if len(t.split()) > 100]
    assert np.mean(near) > 0.6 and np.mean([rows[d].near_next for d, _ in given]) < 0.05


def test_closed_syncmers_by_definition(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 5, 6, 7, 30, 200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    words = F.split("text", " ")
    hashes = frame.filter("text <> ''").select(
        "id",
        F.expr("transform(split(text, ' '), w -> xxhash64(w))").alias("h"),
    )
    inner = f"transform(sequence(0, size(h) - {syncmers.S}), i -> xxhash64(h[i], h[i + 1]))"
    inner = hashes.filter(f"size(h) >= {syncmers.S}").selectExpr("id", f"{inner} AS s").collect()
    found = {r.id: [a.position for a in r.a] for r in frame.select("id", syncmers.anchors(F.col("text")).alias("a")).collect()}
    width = syncmers.K - syncmers.S + 1
    for r in inner:
        n = len(texts[r.id].split())
        if n >= syncmers.K:
            windows = [r.s[i : i + width] for i in range(n - syncmers.K + 1)]
            assert found[r.id] == [i for i, w in enumerate(windows) if min(w) in (w[0], w[-1])]
    assert found[0] == [] and found[1] == [0] and found[2] == [0]
    assert words is not None


def test_anchors_do_not_depend_on_context(spark):
    passage = " ".join(f"w{i * 7 % 31}" for i in range(40))
    frame = spark.createDataFrame([(1, passage), (2, f"one two {passage} end")], "id int, text string")
    a, b = (
        [x.hash for x in r.a]
        for r in frame.orderBy("id").select(syncmers.anchors(F.col("text")).alias("a")).collect()
    )
    assert set(a) <= set(b)


def test_odd_rows(spark, odd, empty):
    rows = syncmers.compared(odd).collect()
    assert len(rows) == odd.count()
    given = sorted(
        ((r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect() if r.doc_id is not None)
    )
    unique = {r.doc_id: r for r in rows if r.doc_id is not None}
    expected = {}
    for n, (doc, text) in enumerate(given):
        expected.setdefault(doc, set()).add(edited(text, given[(n + 1) % len(given)][1]))
    for doc, r in unique.items():
        assert r.edited_sha256 in {hashlib.sha256(t.encode()).hexdigest() for t in expected[doc]}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert unique[5].near_next == 1.0 and unique[5].fingerprint == unique[6].fingerprint
    assert len({r.edited_sha256 for r in rows if r.doc_id == 9}) == 1  # alike rows have one next
    assert syncmers.compared(empty).count() == 0
    single = syncmers.compared(odd.filter("doc_id = 8")).collect()
    check({8: single[0]}, [(8, odd.filter("doc_id = 8").first().text)])
    loose = syncmers.compared(odd.filter("doc_id is null")).collect()
    assert len(loose) == 2


def by_hand(a, b):
    """Likeness of two printed fingerprints, from what is printed alone."""
    a, b = ([x[i : i + 8] for i in range(0, len(x), 8)] for x in (a, b))
    if not a and not b:
        return 1.0
    shifts = [b.index(m) - i for i, m in enumerate(a) if m in b]
    width = max(2, -(-max(len(a), len(b)) // 8))
    best = 0
    for offset in (0, width // 2):
        cells = [(d + offset) // width for d in shifts]
        best = max([best, *(cells.count(c) for c in set(cells))])
    return 2 * best / (len(a) + len(b))


def test_likeness_is_that_of_the_printed_fingerprints(spark):
    rows = QUERIES["op7_closed_syncmers"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    following = [*rows[1:], rows[0]]
    assert len(rows) == 200
    for r, n in zip(rows, following):
        assert abs(r.near_edited - by_hand(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - by_hand(r.fingerprint, n.fingerprint)) < 1e-12


def test_matching_goes_by_position(spark):
    draw = random.Random(4)
    words = [f"w{draw.randint(0, 10**6)}" for _ in range(400)]
    swapped = words[200:] + words[:200]
    quarters = words[300:] + words[200:300] + words[100:200] + words[:100]
    inserted = words[:150] + ["new", "words", "here"] + words[150:]
    moved = [f"x{i}" for i in range(100)] + words
    texts = [words, swapped, quarters, inserted, moved, words[::-1]]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id int, text string")
    marks = frame.select("id", syncmers.fingerprint(F.col("text")).alias("m"))
    pairs = marks.filter("id = 0").selectExpr("m as own").join(marks)
    found = {r.id: r.l for r in pairs.select("id", syncmers.likeness(F.col("own"), F.col("m")).alias("l")).collect()}
    assert found[0] == 1.0 and found[3] > 0.95 and found[4] > 0.85
    assert found[1] < 0.6 and found[2] < 0.4 and found[5] < 0.1


def test_keys_are_followed_across_slices(spark):
    draw = random.Random(2)
    keys = [(draw.randint(-1000, 1000), bytes([i % 7, i // 7]), i) for i in range(200)]
    frame = spark.createDataFrame(keys, "doc_id long, text_key binary, n_chars int").repartition(5)
    few = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(few, "false")
    try:
        rows = syncmers._preceded(frame).collect()
    finally:
        spark.conf.unset(few)
    order = sorted(keys)
    before = {k[:2]: order[n - 1] for n, k in enumerate(order)}
    assert len(rows) == 200
    for r in rows:
        assert tuple(r.before) == before[r.doc_id, bytes(r.text_key)]
