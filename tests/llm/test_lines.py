import itertools
import re

import numpy as np

from clickloom.llm import lines
from clickloom.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    own = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in own[:i] for i, line in enumerate(own)),
        len(inside),
    )


def columns(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)


def test_base_of_the_query(spark, texts):
    rows = QUERIES["op3_line_labelling"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r.doc_id]) < 8000:
            assert columns(r) == base(texts[r.doc_id])
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.content_share >= lines.CONTENT)


def test_good_documents_stay_and_bad_ones_go(spark):
    """On the larger table, against the labels."""
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op3_line_labelling"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [rows[x.doc_id] for x in labels if x.quality == 1 and not rows[x.doc_id].base_failed]
    bad = [rows[x.doc_id] for x in labels if x.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.97
    assert np.mean([r.kept for r in bad]) < 0.1


def test_viterbi_finds_the_best_of_all_labellings():
    draw = np.random.default_rng(2)
    for n in (1, 2, 5, 8):
        content, steps = draw.normal(0, 2, n), draw.normal(0, 1, (2, 2))

        def total(labels):
            inner = sum(steps[a][b] for a, b in zip(labels, labels[1:]))
            return sum(c for c, y in zip(content, labels) if y) + inner

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert lines.viterbi(content, steps).tolist() == list(best)
    assert lines.viterbi(np.empty(0), np.zeros((2, 2))).tolist() == []


def test_fit_follows_the_likelihood():
    """Labels that one feature gives away and that persist along the chain."""
    draw = np.random.default_rng(4)
    chains, labels = [], []
    for n in range(60):
        x = draw.normal(0, 1, (draw.integers(1, 12), lines.FEATURES))
        x[:, 0] = 1
        x[:, 3] += 2 * (n % 2)
        chains.append(x)
        labels.append(n % 2)
    field = lines.fit(chains, labels, [1.0] * len(chains))
    assert field.weights[3] > 0.5
    assert field.steps[0, 0] > field.steps[0, 1] and field.steps[1, 1] > field.steps[1, 0]


def test_odd_rows(spark, odd, empty):
    given = {(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()}
    rows = lines.measured(odd, None).collect()
    assert len(rows) == odd.count()
    short = {doc: text for doc, text in given if doc is not None and len(text or "") < 8000}
    for r in rows:
        if r.doc_id in short:
            assert columns(r) == base(short[r.doc_id])
    labels = spark.createDataFrame(
        [(1, 0, 0), (7, 1, 0), (8, 0, 0), (9, 1, 0), (None, 1, 1), (5, None, 1), (7, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    field = lines.train(odd, labels)
    assert lines.measured(odd, field).count() == odd.count()
    assert lines.train(empty, labels) is None and lines.train(odd, labels.limit(0)) is None
    assert lines.measured(empty, field).count() == 0


def planted(draw, good):
    """Lines of a document with their labels: blocks of plain lines and of boilerplate,
    most words in those that the document's quality asks for."""
    out = []
    for _ in range(draw.integers(2, 5)):
        for label in (1, 0) if draw.random() < 0.5 else (0, 1):
            many = draw.integers(4, 9) if label == good else draw.integers(0, 3)
            for _ in range(many):
                n = draw.integers(6, 15)
                words = ["".join(draw.choice(list("abcdeghilmnorstu"), draw.integers(2, 9))) for _ in range(n)]
                if label:
                    out.append((1, " ".join(words).capitalize() + "."))
                else:
                    out.append((0, " ".join(w.upper() + draw.choice(["!!", "|", "%%%"]) for w in words)))
    return out


def test_both_labels_are_found_inside_one_document(spark):
    """Learned from documents' qualities alone, held against the planted lines."""
    draw = np.random.default_rng(7)
    made = {n: planted(draw, n % 2) for n in range(160)}
    docs = [(n, "\n".join(line for _, line in own)) for n, own in made.items()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(100)], "doc_id long, quality int, toxic int")
    field = lines.train(frame, labels)
    right, mixed = [], 0
    for n, text in docs:
        x, _ = lines.document_lines(text)
        found = lines.viterbi(x @ field.weights, field.steps)
        right += [a == b for a, (b, _) in zip(found.tolist(), made[n])]
        mixed += 0 < found.mean() < 1
    assert np.mean(right) > 0.97
    assert mixed > 0.9 * sum(0 < np.mean([b for b, _ in own]) < 1 for own in made.values())
    rows = {r.doc_id: r for r in lines.measured(frame, field).collect()}
    shares = np.array([rows[n].content_share for n in made])
    assert ((shares > 0) & (shares < 1)).mean() > 0.5
    assert np.mean([(rows[n].content_share >= lines.CONTENT) == (n % 2 == 1) for n in range(100, 160)]) > 0.95


def test_shares_lie_between(spark):
    """On the table: plain lines of bad documents are content."""
    rows = QUERIES["op3_line_labelling"](spark, "/root/testdata/sf0.01").collect()
    between = [r for r in rows if 0 < r.content_share < 1]
    assert len(between) > 30


def test_labels_are_held_to_the_quality():
    draw = np.random.default_rng(1)
    field = lines.Field(draw.normal(0, 1, lines.FEATURES), draw.normal(0, 1, (2, 2)))
    for _ in range(50):
        n = draw.integers(1, 9)
        x, counts = draw.normal(0, 1, (n, lines.FEATURES)), draw.integers(1, 30, n)
        free = lines.viterbi(x @ field.weights, field.steps)
        for quality in (0, 1):
            labels = lines.held_to(x, counts, quality, field)
            assert (counts @ labels >= lines.CONTENT * counts.sum()) == bool(quality)
            if (counts @ free >= lines.CONTENT * counts.sum()) == bool(quality):
                assert labels.tolist() == free.tolist()


def test_labels_that_change_along_the_chain_are_fitted():
    draw = np.random.default_rng(5)
    chains, labels = [], []
    for _ in range(80):
        y = np.cumsum(draw.random(draw.integers(2, 15)) < 0.3) % 2
        x = draw.normal(0, 1, (len(y), lines.FEATURES))
        x[:, 0] = 1
        x[:, 4] += 3 * y
        chains.append(x)
        labels.append(y)
    field = lines.fit(chains, labels, [1.0] * len(chains))
    found = [lines.viterbi(x @ field.weights, field.steps) for x in chains]
    assert np.mean(np.concatenate(found) == np.concatenate(labels)) > 0.9
    alone = lines.fit(chains, labels, [1.0] * len(chains), with_steps=False)
    assert not alone.steps.any() and alone.weights[4] > 0.5
