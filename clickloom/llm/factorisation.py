"""Document quality by a factorisation machine.

Features are hashed words, statistics of the text's structure, and its length. Each
feature has a weight and a short vector; a pair of features adds the product of
their values and of their vectors. The sum over all pairs is half the difference of
the squared sum and the sum of squares, so a text is scored in time linear in its
features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.sampling import bounded_sample, class_counts
from clickloom.llm.words import encoded, mapped, slices, word_hashes

WORD_BUCKETS = 1 << 11
RANK = 8
#: Bound of the training sample: labelled documents of either quality.
SAMPLE = 800
THRESHOLD = 0.3

_MARKS = b"#*$%&|<>"
STATISTICS = 12


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray


def statistics(text: str, raw: bytes, words: list[bytes]) -> list[float]:
    """Structure of a text and, as metadata, its length."""
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    distinct = len(set(words))
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    steady = sum(a == b for a, b in zip(words, words[1:]))
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        len(raw) / n / 10,
        distinct / n,
        distinct / math.sqrt(n) / 5,
        upper / max(1, letters),
        sum(raw.count(d) for d in b"0123456789") / size,
        math.log1p(100 * (len(raw) - len(raw.translate(None, _MARKS))) / n),
        math.log1p(100 * raw.count(b"!") / n),
        steady / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
    ]


_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_UPPER = bytes(range(65, 91))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the hashed words, each row of length 1, and the
    statistics' matrix."""
    raw = [encoded(t) for t in texts]
    words = [r.lower().split() for r in raw]
    numbers = np.array([statistics(*v) for v in zip(texts, raw, words)]).reshape(-1, STATISTICS)
    flat = word_hashes([w for own in words for w in own]) % np.uint64(WORD_BUCKETS)
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    places, counts = np.unique(owner * WORD_BUCKETS + flat.astype(np.int64), return_counts=True)
    rows, columns, values = places // WORD_BUCKETS, places % WORD_BUCKETS, np.log1p(counts)
    norms = np.sqrt(np.bincount(rows, weights=values**2, minlength=len(texts)))
    return rows, columns, values / norms[rows] if len(rows) else values, numbers


def scores(texts: list[str], machine: Machine) -> np.ndarray:
    rows, columns, values, numbers = features(texts)
    numbers = np.clip((numbers - machine.centre) / machine.spread, -4, 4)
    n = len(texts)
    words, extra = slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, None)
    linear = numbers @ machine.weights[extra] + np.bincount(
        rows, weights=values * machine.weights[words][columns], minlength=n
    )
    pairs = np.zeros(n)
    for f in range(RANK):
        v = machine.factors[:, f]
        own = values * v[words][columns]
        sums = np.bincount(rows, weights=own, minlength=n) + numbers @ v[extra]
        squares = np.bincount(rows, weights=own**2, minlength=n) + numbers**2 @ v[extra] ** 2
        pairs += 0.5 * (sums**2 - squares)
    return 1 / (1 + np.exp(-np.clip(machine.bias + linear + pairs, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = 14) -> tuple:
    """Weighted logistic loss by Adam over small batches in a fixed order."""
    draw = np.random.default_rng(11)
    dims = x.shape[1]
    theta = [np.zeros(1), np.zeros(dims), draw.normal(0, 0.01, (dims, RANK))]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    turn = 0
    for _ in range(rounds):
        order = draw.permutation(len(y))
        for start in range(0, len(y), 128):
            rows = order[start : start + 128]
            batch = x[rows]
            sums = batch @ theta[2]
            squared = batch**2
            pairs = 0.5 * (sums**2 - squared @ theta[2] ** 2).sum(axis=1)
            p = 1 / (1 + np.exp(-np.clip(theta[0] + batch @ theta[1] + pairs, -40, 40)))
            error = (p - y[rows]) * weights[rows] / len(rows)
            slopes = [
                error.sum(keepdims=True),
                batch.T @ error + 1e-5 * theta[1],
                batch.T @ (error[:, None] * sums)
                - (squared.T @ error)[:, None] * theta[2]
                + 1e-4 * theta[2],
            ]
            turn += 1
            for i, slope in enumerate(slopes):
                m[i] = 0.9 * m[i] + 0.1 * slope
                v[i] = 0.999 * v[i] + 0.001 * slope**2
                step = (m[i] / (1 - 0.9**turn)) / (np.sqrt(v[i] / (1 - 0.999**turn)) + 1e-8)
                theta[i] = theta[i] - 0.01 * step
    return float(theta[0][0]), theta[1], theta[2]


def train(documents: DataFrame, labels: DataFrame) -> Machine | None:
    """A machine from a bounded sample of the labelled documents; None without both
    qualities among them. Rows that repeat a doc_id in `labels` count once, as
    the rounded mean. The sample's classes are weighted back to their shares."""
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
    rows = rows.withColumn("place", F.xxhash64("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                of, columns, values, numbers = features(texts)
                cuts = np.searchsorted(of, np.arange(1, len(texts)))
                pieces = {
                    "places": [c.astype(np.uint16).tobytes() for c in np.split(columns, cuts)],
                    "amounts": [c.astype(np.float32).tobytes() for c in np.split(values, cuts)],
                    "numbers": [row.astype(np.float32).tobytes() for row in numbers],
                }
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("quality"),
                        part.column("place"),
                        *(pa.array(p, pa.binary()) for p in pieces.values()),
                    ],
                    names=["quality", "place", *pieces],
                )

    schema = "quality int, place long, places binary, amounts binary, numbers binary"
    # a document's rows may repeat: the bound holds for what comes to the driver too, and
    # a hash of the row decides which stay, and the order they are learned in
    sample = mapped(rows, run, schema).orderBy("place").limit(2 * SAMPLE).toArrow()
    y = np.array(sample.column("quality").to_pylist(), float)
    if len(set(y.tolist())) < 2:
        return None
    numbers = np.array([np.frombuffer(b, np.float32) for b in sample.column("numbers").to_pylist()])
    centre, spread = numbers.mean(axis=0), numbers.std(axis=0) + 1e-3
    x = np.zeros((len(y), WORD_BUCKETS + STATISTICS), np.float32)
    x[:, WORD_BUCKETS:] = np.clip((numbers - centre) / spread, -4, 4)
    for row, places, amounts in zip(x, *(sample.column(c).to_pylist() for c in ("places", "amounts"))):
        row[np.frombuffer(places, np.uint16)] = np.frombuffer(amounts, np.float32)
    share = {q: counts[int(q)] / sum(counts.values()) / (y == q).mean() for q in (0.0, 1.0)}
    bias, weights, factors = fit(x, y, np.array([share[q] for q in y.tolist()]))
    return Machine(bias, weights, factors, centre.astype(float), spread.astype(float))


def scored(documents: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id and score, the probability of good quality, of every row from its whole
    text alone.

    Null counts as the empty text, which is scored like any other. Without a
    machine every score is 0.5. Rows are independent: repeated rows and missing
    doc_ids are returned as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                found = scores(texts, machine) if machine else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"]
                )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return mapped(rows, run, f"doc_id {kind}, score double")


def held_out(column: str = "doc_id"):
    """Rows that no machine learns from; a row without doc_id is held out."""
    text = F.col(column).cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % 5 == 0, F.lit(True))
