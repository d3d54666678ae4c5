import zlib

import numpy as np

from clickloom.llm import langid, sampling
from clickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_hierarchical_language"](spark, SF).collect()}
    documents = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 for r in rows.values())
    right = [rows[d.doc_id].lang_pred == d.lang for d in documents if rows[d.doc_id].held_out]
    assert np.mean(right) > 0.98


def test_family_comes_first():
    model = langid.Model(
        ("germanic", "romance"),
        (("de", "en"), ("es", "fr")),
        ((-1, 0, 1), (0, 0, 1), (1, 0, 1)),
        np.zeros((langid.BUCKETS, 3)),
        np.zeros(3),
    )
    assert model.predict(np.array([2.0, -1.0, 9.0]))[0] == "en"
    assert model.predict(np.array([-2.0, -1.0, 9.0]))[0] == "es"
    assert 0 <= model.predict(np.array([-2.0, -1.0, 9.0]))[1] <= 1


def test_machine_separates():
    draw = np.random.default_rng(0)
    x = draw.normal(0, 1, (200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.2, 1, -1)
    w = langid.svm(x, y)
    assert np.mean(np.sign(x @ w[:-1] + w[-1]) == y) > 0.95


def test_words_are_added_up(spark):
    model = langid.fit(
        np.array(["en", "de", "fr"] * 4),
        np.array([langid.features(t) for t in ["the cat and the dog", "der Hund und die", "le chat et la"] * 4]),
    )
    scorer = langid._Scorer(model)
    text = "The cat, the hat and the Haus! été " * 3
    direct = langid.features(text) @ model.weights + model.biases
    assert np.allclose(scorer.margins(langid.words_of(text)), direct, atol=1e-3)


def test_odd_rows(spark, odd, empty):
    model = langid.train(odd)
    rows = langid.identify(odd, model).collect()
    assert len(rows) == odd.count()
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1, 2, 3, 11))
    assert found[5].lang_pred in {"en", "fr", "de"}
    kept = langid.accepted(odd, model)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [4, 5, 6, 7, 8, 9, 9, 10]
    assert kept.filter("lang is null").count() == 0
    assert langid.train(empty) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0
    one = langid.train(odd.filter("lang = 'en'"))
    assert {r.lang_pred for r in langid.identify(odd, one).collect()} == {"en", "und"}


def _many_languages(spark, names, each):
    """Texts of `each` rows a language, which has words of its own."""
    draw = np.random.default_rng(4)
    rows = []
    for name in names:
        words = ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)]
        for _ in range(each):
            rows.append((len(rows), " ".join(draw.choice(words, 30)), name))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_no_language_is_left_out(spark):
    names = [v for members in langid.FAMILIES.values() for v in members] + [f"x{i:02}" for i in range(40)]
    documents = _many_languages(spark, names, 4)
    model = langid.train(documents)
    assert sorted(v for own in model.languages for v in own) == sorted(names)
    assert len(model.pairs) < 500
    found = {r.doc_id: r.lang_pred for r in langid.identify(documents, model).collect()}
    assert np.mean([found[r.doc_id] == r.lang for r in documents.collect()]) > 0.98


def test_unlisted_languages_form_families_with_their_like():
    draw = np.random.default_rng(1)
    bases = draw.random((3, langid.BUCKETS)) * (draw.random((3, langid.BUCKETS)) < 0.02)
    names = [f"{g}{i}" for i in range(3) for g in "xyz"]
    means = {v: (bases["xyz".index(v[0])] + draw.random(langid.BUCKETS) * 0.01).astype(np.float32) for v in names}
    found = langid.families_of([*names, "en"], means | {"en": bases[0]})
    assert found["en"] == "germanic"
    # nine names make five families; none of them mixes what is apart
    families = {f: {v[0] for v in names if found[v] == f} for f in set(found.values()) - {"germanic"}}
    assert len(families) == 5 and all(len(v) == 1 for v in families.values())
    assert langid.families_of(["aa"], {"aa": bases[0]}) == {"aa": "with aa"}


def test_a_text_without_letters_is_unknown(spark):
    texts = ["²", "½ ①", "Ⅷ ٣ 7", "a½b", "ª", "中", "x²y", "_", "🙂", ""]
    assert [langid.words_of(t) for t in texts] == [[], [], [], ["a", "b"], ["ª"], ["中"], ["x", "y"], [], [], []]
    model = langid.fit(np.array(["en", "fr"]), np.array([langid.features(t) for t in ("the cat", "le chat")]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(frame, model).collect()}
    assert {i for i, (name, _) in found.items() if name == "und"} == {0, 1, 2, 7, 8, 9}
    assert all(found[i][1] == 0 for i in (0, 1, 2, 7, 8, 9))


def test_a_column_of_other_values_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = [(i, f"word{i % 5} text", v) for i, v in enumerate(["en", "de", "fr"] * 5 + [f"junk{i}" for i in range(20)])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(v for own in model.languages for v in own) == ["de", "en", "fr"]


def test_words_are_forgotten_by_the_size_of_the_model():
    model = langid.Model(("a",), (("a",),), ((0, 0, 0),) * 2000, np.zeros((langid.BUCKETS, 2000)), np.zeros(2000))
    assert langid._Scorer(model).most * 2001 <= langid.REMEMBERED_VALUES


def test_copies_displace_no_language(spark):
    """One text makes up most of a language; its copies are drawn apart."""
    copies = [(i, "same text", "aa") for i in range(3000)]
    others = [(5000 + i, f"text {i}", v) for v in ("aa", "bb", "cc") for i in range(30)]
    rows = spark.createDataFrame(copies + others, "doc_id long, text string, lang string")
    for by in (["doc_id", "text"], ["text"]):
        counts = sampling.class_counts(rows, "lang")
        drawn = sampling.sample_of_each(rows, "lang", counts, 40, by)
        found = {r.lang: r["count"] for r in drawn.groupBy("lang").count().collect()}
        assert found["bb"] == found["cc"] == 30 and found.get("aa", 0) <= 40
        assert by == ["text"] or found["aa"] > 20


def test_learning_tells_copies_apart(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(langid, "sample_of_each", lambda *a: asked.append(a) or sampling.sample_of_each(*a))
    assert langid.train(_many_languages(spark, ["en", "de"], 3)) is not None
    assert asked[0][4] == ["doc_id", "text"]
