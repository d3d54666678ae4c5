"""Language identification in two steps: the family first, then the language in it.

Both steps are one-versus-one linear support vector machines over hashed character
n-grams of words: one for each pair of families, one for each pair of languages of
a family. A text's features are shares of its n-grams, so a machine's margin is a
mean over words, and what a word adds to each margin is worked out once and
remembered, up to a bound.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.sampling import class_counts, sample_of_each
from clickloom.llm.words import REMEMBERED, mapped, slices

UNKNOWN = "und"
#: Languages that are close to each other; any other is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "finnic": ("et", "fi"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}
#: Bound of the training sample: texts of each language, and languages, the most
#: frequent ones. The latter lies above the languages that corpora name and stops a
#: column of other values.
SAMPLE, LANGUAGES = 400, 512
BUCKETS = 1 << 13
#: Values that a task remembers, one for each machine and word.
REMEMBERED_VALUES = 1 << 24
#: Features are shares of n-grams times this, so that margins have a scale of about 1.
SCALE = 40.0

_LETTERS = re.compile(r"[^\W\d_]+")


def families_of(names: list[str], means: dict[str, np.ndarray]) -> dict[str, str]:
    """The family of each name. Those without a listed one form families by the cosines of
    their `means`: the two closest groups are joined until n names make n^(2/3)
    families, none above 1.5 times their mean size, so that machines grow with the 4/3rd
    power of names."""
    listed = {v: f for f, members in FAMILIES.items() for v in members}
    groups = [[v] for v in sorted(set(names) - set(listed))]
    sums = np.array([means[v] / max(1e-30, np.linalg.norm(means[v])) for (v,) in groups], np.float32)
    most = np.ceil(1.5 * len(groups) ** (1 / 3))
    for _ in range(len(groups) - int(np.ceil(len(groups) ** (2 / 3) - 1e-9))):
        unit = sums / np.maximum(1e-30, np.linalg.norm(sums, axis=1, keepdims=True))
        sizes = np.array([len(g) for g in groups])
        allowed = np.triu(sizes[:, None] + sizes <= most, 1)
        if not allowed.any():
            break
        a, b = divmod(int(np.where(allowed, unit @ unit.T, -2).argmax()), len(groups))
        sums[a] += sums[b]
        groups[a] += groups.pop(b)
        sums = np.delete(sums, b, axis=0)
    own = {v: f"with {min(group)}" for group in groups for v in group}
    return {v: listed.get(v) or own[v] for v in names}


def ngrams(word: str) -> list[int]:
    """Buckets of the word's 1-, 2- and 3-grams, its edges marked, and of itself."""
    marked = f"<{word}>"
    grams = [marked] + [marked[i : i + n] for n in (1, 2, 3) for i in range(len(marked) + 1 - n)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in grams]


def words_of(text: str) -> list[str]:
    """Runs of letters. The pattern also takes numerals such as one half; few texts have any."""
    words = _LETTERS.findall(text.lower())
    if not words or "".join(words).isalpha():
        return words
    letters = ("".join(c if c.isalpha() else " " for c in w) for w in words)
    return [run for w in letters for run in w.split()]


def features(text: str) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.float32)
    for word in words_of(text):
        np.add.at(counts, ngrams(word), 1)
    return counts * (SCALE / max(1.0, counts.sum()))


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights and, last, the bias of a linear machine with hinge loss: dual
    coordinate descent in a fixed order. y is 1 or -1."""
    return _machine(sparse(x), x.shape[1], y, c, rounds)


def sparse(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and values of what is not zero in each row."""
    places = [np.flatnonzero(row) for row in x]
    return [(p, row[p].astype(np.float32)) for row, p in zip(x, places)]


def _machine(
    rows: list[tuple[np.ndarray, np.ndarray]], width: int, y: np.ndarray, c: float = 10.0, rounds: int = 30
) -> np.ndarray:
    limit = c * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    norms, alpha, w = [float(v @ v) + 1 for _, v in rows], np.zeros(len(y)), np.zeros(width + 1, np.float32)
    draw = np.random.default_rng(7)
    for _ in range(rounds):
        for i in draw.permutation(len(y)):
            places, values = rows[i]
            gradient = y[i] * (w[places] @ values + w[-1]) - 1
            moved = min(max(alpha[i] - gradient / norms[i], 0.0), limit[i])
            if moved != alpha[i]:
                step = np.float32((moved - alpha[i]) * y[i])
                w[places] += step * values
                w[-1] += step
                alpha[i] = moved
    return w


@dataclass(frozen=True)
class Model:
    """families[i] has languages[i]; a machine is positive for the first of its pair."""

    families: tuple[str, ...]
    languages: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[int, int, int], ...]  # (-1 for families or the family, first, second)
    weights: np.ndarray
    biases: np.ndarray

    def predict(self, margins: np.ndarray) -> tuple[str, float]:
        family, share = self._step(-1, len(self.families), margins)
        own = self.languages[family]
        language, of_family = self._step(family, len(own), margins)
        return own[language], share * of_family

    def _step(self, group: int, n: int, margins: np.ndarray) -> tuple[int, float]:
        """The choice with most support, each machine giving its two sides shares."""
        if n == 1:
            return 0, 1.0
        support = np.zeros(n)
        for (of, a, b), margin in zip(self.pairs, margins):
            if of == group:
                first = 1 / (1 + np.exp(-np.clip(2 * margin, -40, 40)))
                support[a] += first
                support[b] += 1 - first
        best = int(support.argmax())
        return best, float(support[best] / (n - 1))


def fit(languages: np.ndarray, x: np.ndarray | list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """From the languages of texts and their features, dense or as sparse() has them."""
    x = sparse(x) if isinstance(x, np.ndarray) else x
    names = sorted(set(languages.tolist()))
    means = {v: np.zeros(BUCKETS, np.float32) for v in names}
    for language, (places, values) in zip(languages.tolist(), x):
        means[language][places] += values
    family = families_of(names, means)
    families = tuple(sorted(set(family.values())))
    members = tuple(tuple(v for v in names if family[v] == f) for f in families)
    place = {f: i for i, f in enumerate(families)}
    of = np.array([place[family[v]] for v in languages])
    pairs, weights, biases = [], [], []

    def learn(group: int, a: int, b: int, labels: np.ndarray, first, second) -> None:
        rows = np.flatnonzero((labels == first) | (labels == second))
        w = _machine([x[i] for i in rows], BUCKETS, np.where(labels[rows] == first, 1, -1))
        pairs.append((group, a, b))
        weights.append(w[:-1])
        biases.append(w[-1])

    for a, b in combinations(range(len(families)), 2):
        learn(-1, a, b, of, a, b)
    for group, own in enumerate(members):
        for a, b in combinations(range(len(own)), 2):
            learn(group, a, b, languages, own[a], own[b])
    table = np.array(weights, np.float32).reshape(-1, BUCKETS).T
    return Model(families, members, tuple(pairs), table, np.array(biases))


def train(labelled: DataFrame) -> Model | None:
    """A model from a bounded sample of the rows (doc_id, text, lang); None without any."""
    rows = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    counts = class_counts(rows, "lang", LANGUAGES)
    if not counts:
        return None
    sample = sample_of_each(rows, "lang", counts, SAMPLE, ["doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                found = [features(t) for t in texts]
                places = [np.flatnonzero(f).astype(np.uint16) for f in found]
                values = [f[p].astype(np.float32) for f, p in zip(found, places)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang").cast(pa.string()),
                        pa.array([p.tobytes() for p in places], pa.binary()),
                        pa.array([v.tobytes() for v in values], pa.binary()),
                    ],
                    names=["lang", "places", "values"],
                )

    drawn = mapped(sample, run, "lang string, places binary, values binary").toArrow()
    places, values = drawn.column("places").to_pylist(), drawn.column("values").to_pylist()
    x = [(np.frombuffer(p, np.uint16), np.frombuffer(v, np.float32)) for p, v in zip(places, values)]
    return fit(np.array(drawn.column("lang").to_pylist()), x) if len(drawn) else None


class _Scorer:
    """What each word adds to the margins, for the words seen lately."""

    def __init__(self, model: Model):
        self.model = model
        self.most = min(REMEMBERED, REMEMBERED_VALUES // (len(model.pairs) + 1))
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.parts = np.zeros((1024, len(self.model.pairs) + 1))

    def margins(self, words: list[str]) -> np.ndarray:
        if len(self.places) > self.most:
            self.forget()
        places = self.places
        for word in set(words).difference(places):
            if len(places) == len(self.parts):
                self.parts = np.vstack([self.parts, np.zeros_like(self.parts)])
            grams = ngrams(word)
            self.parts[len(places), :-1] = self.model.weights[grams].sum(axis=0)
            self.parts[len(places), -1] = len(grams)
            places[word] = len(places)
        at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
        counts = np.bincount(at, minlength=1)
        total = counts @ self.parts[: len(counts)] if len(counts) < 4 * len(at) else self.parts[at].sum(axis=0)
        return total[:-1] * (SCALE / total[-1]) + self.model.biases


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) for every row, from its whole text alone.

    `und` with score 0 if the text is null or has no letter, or if no model could
    be fitted. A model of one language predicts it with score 1. Rows are
    independent: repeated rows and missing doc_ids are returned as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model) if model is not None else None
        for batch in batches:
            for part, texts in slices(batch):
                found: list[tuple[str, float]] = []
                for text in texts:
                    words = words_of(text) if scorer is not None else []
                    if words:
                        found.append(scorer.model.predict(scorer.margins(words)))
                    else:
                        found.append((UNKNOWN, 0.0))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return mapped(rows, run, f"doc_id {kind}, lang_pred string, score double")


def accepted(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `documents`, all columns, whose language is recognized; a missing
    `lang` becomes the predicted one. Rows that identify() calls `und` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model) if model is not None else None
        for batch in batches:
            for part, texts in slices(batch):
                words = [words_of(t) if scorer is not None else [] for t in texts]
                found = [scorer.model.predict(scorer.margins(w))[0] if w else None for w in words]
                place = part.schema.get_field_index("lang")
                lang = part.column(place)
                filled = pc.coalesce(lang, pa.array(found, pa.string()).cast(lang.type))
                columns = [filled if i == place else c for i, c in enumerate(part.columns)]
                whole = pa.RecordBatch.from_arrays(columns, names=part.schema.names)
                yield whole.filter(pa.array([f is not None for f in found], pa.bool_()))

    return mapped(documents, run, documents.schema)


def held_out():
    """Rows that no model learns from; a row without doc_id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))
