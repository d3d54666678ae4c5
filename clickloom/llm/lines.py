"""Quality rules with line labels from a linear-chain conditional random field.

Each line with a word is content or boilerplate. The field scores a line by its
form and a step by the two labels; Viterbi decoding finds the best labelling of the
whole document, and the share of its words that lie in content lines decides.

The field is fitted on a bounded sample of documents of known quality, whose lines'
labels are not known. They are found in turn with the field: it begins with lines alone,
each taken for what its document is; then Viterbi decoding labels the lines, held to
what is known, that a good document is content for at least the share that keeps it and a
bad one for less, and the field is fitted to these labels, steps included. So a
bad document's plain lines and a good one's boilerplate become what they look like. The
likelihood's gradient comes from the forward-backward recursion.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.sampling import bounded_sample, class_counts
from clickloom.llm.words import encoded, mapped, mixed, slices, window_hashes, word_hashes

#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
#: Bound of the training sample: documents of either quality.
SAMPLE = 400
#: A document is kept if at least this share of its words is in content lines.
CONTENT = 0.5

#: Times that labels and field are found in turn.
TURNS = 3
FEATURES = 12
_SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Field:
    """weights: of a line's features for content; steps[a][b]: of label b after a.
    Label 1 is content."""

    weights: np.ndarray
    steps: np.ndarray


def line_features(line: str, earlier: bool) -> list[float]:
    """Form of a line that has a word; `earlier`: it repeats a line above."""
    words = line.split()
    n, size = max(1, len(words)), len(line)
    letters = sum(map(str.isalpha, line))
    upper = sum(map(str.isupper, line))
    raw = encoded(line)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return [
        1.0,
        min(n, 60) / 20,
        1.0 if n < 4 else 0.0,
        min(size / n, 20) / 10,
        letters / size,
        upper / max(1, letters),
        sum(map(str.isdigit, line)) / size,
        min(1.0, symbols / n),
        line.count("!") / n,
        1 - len(set(words)) / n,
        1.0 if line.rstrip(_SPACE)[-1:] in ".?!:;\"'”»" else 0.0,
        1.0 if earlier else 0.0,
    ]


def document_lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and word counts of the lines with a word."""
    rows, counts, seen = [], [], set()
    for line in text.split("\n"):
        words = len(encoded(line).split())
        if words:
            rows.append(line_features(line, line in seen))
            counts.append(words)
            seen.add(line)
    return np.array(rows, float).reshape(-1, FEATURES), np.array(counts, np.int64)


def viterbi(content: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best labels of a chain; `content` scores label 1 against 0. Ties: content."""
    if not len(content):
        return np.empty(0, np.int8)
    (s00, s01), (s10, s11) = steps.tolist()
    scores = content.tolist()
    no, yes, back = 0.0, scores[0], []
    for score in scores[1:]:
        from_no = (no + s00 > yes + s10, no + s01 > yes + s11)
        back.append(from_no)
        no, yes = (
            no + s00 if from_no[0] else yes + s10,
            (no + s01 if from_no[1] else yes + s11) + score,
        )
    labels = [1 if yes >= no else 0]
    for from_no in reversed(back):
        labels.append(0 if from_no[labels[-1]] else 1)
    return np.array(labels[::-1], np.int8)


def fit(
    chains: list[np.ndarray],
    labels: list,
    weights: list[float],
    rounds: int = 60,
    with_steps: bool = True,
) -> Field:
    """Maximum penalised likelihood by Adam; all chains advance together. labels[i] holds
    the labels of chain i's lines, or one for all, and chain i counts `weights[i]` times.
    Without steps, lines are labelled each by itself."""
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains = [chains[i] for i in order]
    known = [np.broadcast_to(labels[i], len(c)) for i, c in zip(order, chains)]
    # each chain counts alike, however long it is
    scale = np.array([weights[i] / len(c) for i, c in zip(order, chains)])
    lengths = np.array([len(c) for c in chains])
    steps_of = [int((lengths > t).sum()) for t in range(lengths[0])]
    x = [np.array([c[t] for c in chains[:k]]) for t, k in enumerate(steps_of)]
    y = [np.array([c[t] for c in known[:k]]) for t, k in enumerate(steps_of)]
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = scale @ lengths
    for turn in range(1, rounds + 1):
        w, steps = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        unary = [np.stack([np.zeros(len(r)), r @ w], axis=1) for r in x]
        ahead = [unary[0]]
        for t in range(1, len(x)):
            into = ahead[-1][: steps_of[t], :, None] + steps
            ahead.append(np.logaddexp(into[:, 0], into[:, 1]) + unary[t])
        slope = np.zeros_like(theta)
        after = np.zeros((steps_of[-1], 2))
        for t in range(len(x) - 1, -1, -1):
            k = steps_of[t]
            both = ahead[t] + after if with_steps else unary[t]
            norm = np.logaddexp(both[:, 0], both[:, 1])
            p = np.exp(both[:, 1] - norm)
            slope[:FEATURES] += (scale[:k] * (y[t] - p)) @ x[t]
            if t and with_steps:
                arrive = unary[t] + after
                joint = np.exp(
                    ahead[t - 1][:k, :, None] + steps + arrive[:, None, :] - norm[:, None, None]
                )
                expected = (scale[:k, None, None] * joint).sum(axis=0)
                real = np.bincount(2 * y[t - 1][:k] + y[t], scale[:k], minlength=4)
                slope[FEATURES:] += real - expected.ravel()
                through = steps + arrive[:, None, :]
                back = np.zeros((steps_of[t - 1], 2))
                back[:k] = np.logaddexp(through[:, :, 0], through[:, :, 1])
                after = back
            elif t:
                after = np.zeros((steps_of[t - 1], 2))
        slope = slope / total - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta + 0.2 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return Field(theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def held_to(x: np.ndarray, counts: np.ndarray, quality: int, field: Field) -> np.ndarray:
    """Labels of a document's lines by the field, or, where their share of content says
    another quality than the known one, by the field with the least shift of all lines'
    scores that mends it."""
    scores = x @ field.weights

    def labelled(shift: float) -> tuple[np.ndarray, bool]:
        labels = viterbi(scores + shift, field.steps)
        return labels, bool(counts @ labels >= CONTENT * counts.sum())

    labels, good = labelled(0.0)
    if good == bool(quality):
        return labels
    near, far = 0.0, 64.0 if quality else -64.0
    mended = np.full(len(x), quality, np.int8)
    for _ in range(16):
        middle = (near + far) / 2
        labels, good = labelled(middle)
        if good == bool(quality):
            far, mended = middle, labels
        else:
            near = middle
    return mended


def learned(
    chains: list[np.ndarray], counts: list[np.ndarray], quality: list[int], weights: list[float]
) -> Field:
    """The field from documents of known quality, labels and field found in turn."""
    field = fit(chains, quality, weights, with_steps=False)
    for _ in range(TURNS):
        labels = [held_to(x, n, q, field) for x, n, q in zip(chains, counts, quality)]
        field = fit(chains, labels, weights)
    return field


def train(documents: DataFrame, labels: DataFrame) -> Field | None:
    """A field from a bounded sample of labelled documents; None without both
    qualities among them. Rows that repeat a doc_id in `labels` count once, as
    the rounded mean."""
    marks = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    counts = class_counts(marks, "quality", 2)
    if len(counts) < 2:
        return None
    drawn = bounded_sample(marks, "quality", counts, SAMPLE, ["doc_id"])
    # Bounded by the sample's size.
    rows = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                found = [document_lines(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("quality"),
                        pa.array([x.astype(np.float32).tobytes() for x, _ in found], pa.binary()),
                        pa.array([n.tobytes() for _, n in found], pa.binary()),
                    ],
                    names=["quality", "lines", "counts"],
                )

    # a document's rows may repeat: the bound holds for what comes to the driver too, and
    # a hash of the row decides which stay
    rows = rows.withColumn("sample_place", F.xxhash64("doc_id", "text")).orderBy("sample_place", "doc_id")
    rows = rows.limit(2 * SAMPLE).select("text", "quality")
    sample = rows.mapInArrow(run, "quality int, lines binary, counts binary").toArrow()
    chains, counted, found = [], [], []
    for quality, raw, counts in zip(*(sample.column(c).to_pylist() for c in sample.column_names)):
        if raw:
            chains.append(np.frombuffer(raw, np.float32).reshape(-1, FEATURES).astype(float))
            counted.append(np.frombuffer(counts, np.int64))
            found.append(quality)
    if len(set(found)) < 2:
        return None
    balance = {q: 1 / found.count(q) for q in set(found)}
    return learned(chains, counted, found, [balance[q] for q in found])


def measured(documents: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_lines, n_content_lines and content_share of every row.

    A null or empty text has no words and fails the base rules; its content share
    is 0. Without a field all lines are content. Rows are independent: repeated
    rows and missing doc_ids are returned as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *_measures(texts, field)], names=["doc_id", *_NAMES]
                )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(f"{name} {kind}" for name, kind in _NAMES.items())
    return mapped(rows, run, f"doc_id {kind}, {schema}")


_NAMES = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "kept": "boolean",
    "n_lines": "long",
    "n_content_lines": "long",
    "content_share": "double",
}


def _measures(texts: list[str], field: Field | None) -> list[pa.Array]:
    raw = [encoded(t) for t in texts]
    words = [r.split() for r in raw]
    n = np.array([len(w) for w in words], np.int64)
    # code points in words: all but the white space that splits them
    chars = [len(t) - len(r) + len(r.translate(None, b" \t\n\x0b\x0c\r")) for t, r in zip(texts, raw)]
    symbols = [len(r) - len(r.translate(None, SYMBOLS)) for r in raw]
    repeated = _repeated_words(words, n)
    failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
    lines, repeats, content, share = [], [], [], []
    for text in texts:
        own = [line for line in text.split("\n") if line.strip(_SPACE)]
        repeats.append(len(own) - len(set(own)))
        x, counts = document_lines(text)
        labels = viterbi(x @ field.weights, field.steps) if field else np.ones(len(x), np.int8)
        lines.append(len(x))
        content.append(int(labels.sum()))
        share.append(float(counts @ labels / counts.sum()) if len(counts) else 0.0)
    kept = ~failed & (np.array(share) >= CONTENT)
    values = [n, chars, symbols, repeats, repeated, failed, kept, lines, content, share]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return [pa.array(v, kinds[k]) for v, k in zip(values, _NAMES.values())]


def _repeated_words(words: list[list[bytes]], n: np.ndarray) -> np.ndarray:
    """Words in windows of three that the text holds twice or more."""
    flat = word_hashes([w for own in words for w in own])
    if len(flat) < 3:
        return np.zeros(len(n), np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    whole = np.flatnonzero(owner[2:] == owner[:-2])
    keys = mixed(window_hashes(flat, 3)[whole] + owner[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = whole[counts[place] > 1]
    covered = np.zeros(len(flat), bool)
    for step in range(3):
        covered[starts + step] = True
    return np.bincount(owner, weights=covered, minlength=len(n)).astype(np.int64)
