"""Hard negatives by rotated one-bit codes, residual intervals and integer scores.

Components become integers, and vectors are rotated by a fixed random rotation. The signs of a
rotated vector are its code; stored beside it is the alignment of vector and code, their
inner product. What the code leaves is coded the same way again, LEVELS
times, and the norm of the last rest is stored. An anchor's rotated components are
cut into bit planes, so its inner products with a code are popcounts, and with the
alignments they estimate its score. By Cauchy and Schwarz the last rest and what the planes
leave out move the score no further than the product of their norms: a fixed
interval, no chance involved. Rows whose interval can't reach an anchor's best, or the
band of its negatives, are left out; the others are scored in integers.

Rows are packed into blocks by the scan. Blocks of rows and blocks of anchors meet in
cells, each a task's work of bounded size, and a cell answers with no more than the best few of
each anchor. Nothing is approximate, so recall is 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.vectors import by_length
from clickloom.llm.words import mapped
from clickloom.session import stored

LEVELS, PLANES = 6, 8
SEED = 11
#: Components times this, rounded down, are what scores are made of.
SCALE = 256
#: Scaled components beyond this count as this, so that scores fit 64 bits.
LARGEST = 1 << 24
POSITIVES, NEGATIVES = 5, 10
#: Negatives score between these per cents of the positive's score.
LOWEST, HIGHEST = 30, 90
#: Of a block of rows and of a block of anchors.
BLOCK_BYTES, BLOCK_ANCHORS = 1 << 20, 1024

_BLOCK = "length int, ids binary, labels binary, vectors binary, codes binary, aligned binary, norms binary"
_SCORED = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
_WHOLE = "vec_id long, label long, length int, vector array<long>"

_rotations: dict[int, np.ndarray] = {}


def hard_negatives(embeddings: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for
    the rows of `embeddings` (vec_id, label, embedding) where `is_anchor` holds.

    Rows without vec_id, label or vector, or with a component that is null or not
    finite, take no part, nor do vectors without components. Vectors of
    different lengths are not compared. A row that repeats a vec_id, label and vector counts once;
    rows of one vec_id that differ are rows of their own, of which those that score alike
    count once, and an anchor is the smallest of them by label and vector. An anchor
    without positives, or a positive without negatives in its band, gives no rows.
    Other columns are not used.
    """
    usable = embeddings.filter("vec_id is not null and label is not null and embedding is not null")
    columns = [F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding"]
    blocks = stored(mapped(usable.select(*columns), _packed, _BLOCK), "blocks")
    anchors = stored(_anchors(usable.filter(is_anchor).select(*columns)), "anchors")
    grid = _Grid(blocks, anchors)

    none = F.expr("cast(array() as array<struct<id:long,score:long>>)").alias("positives")
    near = grid.scored(anchors.withColumn("positives", none), _positives).select(
        "anchor_id", "vec_id", "score"
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = near.distinct().withColumn("place", F.row_number().over(order))
    best = best.filter(F.col("place") <= POSITIVES)
    held = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("vec_id").alias("id"), "score")).alias("positives")
    )
    banded = stored(anchors.join(held, "vec_id"), "banded")

    found = grid.scored(banded, _negatives).distinct()
    pair = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(pair)).filter(F.col("rank") <= NEGATIVES)
    return ranked.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


# ---- codes


def rotation(length: int) -> np.ndarray:
    """A random orthogonal matrix for vectors of a length, filled up to whole words."""
    if length not in _rotations:
        wide = -(-length // 64) * 64
        draw = np.random.default_rng([SEED, length]).standard_normal((wide, wide))
        q, r = np.linalg.qr(draw)
        _rotations[length] = (q * np.sign(np.diag(r)))[:length]
    return _rotations[length]


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, axis=-1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


class Codes:
    """Codes, alignments and norms of some vectors, by level where there are several."""

    def __init__(self, words: np.ndarray, aligned: np.ndarray, norms: np.ndarray) -> None:
        self.words, self.aligned, self.norms = words, aligned, norms

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        rest = vectors.astype(np.float64) @ rotation(vectors.shape[1])
        whole = np.linalg.norm(rest, axis=1)
        unit = 1 / np.sqrt(rest.shape[1])
        words, aligned = [], []
        for _ in range(LEVELS):
            signs = rest > 0
            code = np.where(signs, unit, -unit)
            aligned.append((rest * code).sum(axis=1))
            words.append(_words(signs))
            rest = rest - aligned[-1][:, None] * code
        left = np.linalg.norm(rest, axis=1)
        return cls(np.stack(words, axis=1), np.stack(aligned, axis=1), np.stack([whole, left], axis=1))

    def at(self, places: np.ndarray) -> Codes:
        return Codes(self.words[places], self.aligned[places], self.norms[places])


class Query:
    """An anchor's rotated components, cut into bit planes."""

    def __init__(self, vector: np.ndarray) -> None:
        turned = vector.astype(np.float64) @ rotation(len(vector))
        self.low = turned.min()
        steps = (1 << PLANES) - 1
        self.step = max((turned.max() - self.low) / steps, 1e-300)
        cut = np.clip(np.rint((turned - self.low) / self.step), 0, steps).astype(np.uint8)
        self.planes = [_words((cut >> p) & 1) for p in range(PLANES)]
        seen = self.low + self.step * cut
        self.total, self.square = seen.sum(), (seen * seen).sum()
        self.missed = np.linalg.norm(turned - seen)
        self.norm, self.unit = np.linalg.norm(turned), 1 / np.sqrt(len(turned))

    def along(self, words: np.ndarray) -> np.ndarray:
        """Inner products of the cut components with codes, by popcounts."""
        ones = np.bitwise_count(words).sum(axis=-1, dtype=np.int64)
        weighted = np.zeros(words.shape[:-1], np.int64)
        for p, plane in enumerate(self.planes):
            weighted += np.bitwise_count(words & plane).sum(axis=-1, dtype=np.int64) << p
        return (2 * (self.low * ones + self.step * weighted) - self.total) * self.unit

    def interval(self, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each vector can have with the anchor."""
        along = self.along(codes.words)
        middle = (along * codes.aligned).sum(axis=1)
        # the last rest is orthogonal to the last code
        free = np.sqrt(np.maximum(self.square - along[:, -1] ** 2, 0))
        reach = free * codes.norms[:, 1] + self.missed * codes.norms[:, 0]
        reach += 1e-9 * self.norm * codes.norms[:, 0] + 1e-6  # rounding of all this
        return middle - reach, middle + reach


def _integers(matrix: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * matrix), -LARGEST, LARGEST).astype(np.int64)


# ---- blocks


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK_BYTES; vectors of one length in each."""
    held: dict[int, list] = {}
    for batch in batches:
        ids = batch.column("vec_id").to_numpy()
        labels = batch.column("label").to_numpy()
        for places, matrix in by_length(batch.column("embedding")):
            length = matrix.shape[1]
            for start in range(0, len(places), 256):
                some = places[start : start + 256]
                parts = held.setdefault(length, [])
                parts.append((ids[some], labels[some], _integers(matrix[start : start + 256])))
                if sum(v.nbytes for _, _, v in parts) >= BLOCK_BYTES:
                    yield _block(length, held.pop(length))
    for length, parts in held.items():
        yield _block(length, parts)


def _block(length: int, parts: list) -> pa.RecordBatch:
    ids, labels, vectors = (np.concatenate(p) for p in zip(*parts))
    codes = Codes.of(vectors)
    contents = (ids, labels, vectors.astype(np.int32), codes.words, codes.aligned, codes.norms)
    return pa.RecordBatch.from_arrays(
        [pa.array([length], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in contents)],
        names=["length", "ids", "labels", "vectors", "codes", "aligned", "norms"],
    )


def _anchors(rows: DataFrame) -> DataFrame:
    """vec_id, label, length and integer vector, one row of each vec_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in by_length(batch.column("embedding")):
                some = batch.take(pa.array(places))
                integers = _integers(matrix)
                ends = pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("vec_id"),
                        some.column("label"),
                        pa.array(np.full(len(matrix), matrix.shape[1], np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(integers.reshape(-1))),
                    ],
                    names=["vec_id", "label", "length", "vector"],
                )

    whole = mapped(rows, run, _WHOLE)
    least = F.min(F.struct("label", "vector", "length")).alias("least")
    return whole.groupBy("vec_id").agg(least).select("vec_id", "least.label", "least.length", "least.vector")


class _Rows:
    """The rows of a cell: one or more blocks of a length, repeated rows once."""

    def __init__(self, blocks: pa.Table, length: int) -> None:
        words, wide = -(-length // 64), LEVELS

        def joined(name: str, kind, shape: tuple[int, ...]) -> np.ndarray:
            parts = [np.frombuffer(b, kind) for b in blocks.column(name).to_pylist()]
            return np.concatenate(parts).reshape(-1, *shape)

        self.ids, self.labels = joined("ids", np.int64, ()), joined("labels", np.int64, ())
        self.vectors = joined("vectors", np.int32, (length,))
        self.codes = Codes(
            joined("codes", np.uint64, (wide, words)),
            joined("aligned", np.float64, (wide,)),
            joined("norms", np.float64, (2,)),
        )
        #: Rows of one vec_id that differ would let the bounds count it twice.
        self.distinct = len(np.unique(self.ids)) == len(self.ids)

    def scores(self, places: np.ndarray, vector: np.ndarray) -> np.ndarray:
        return self.vectors[places].astype(np.int64) @ vector


class _Grid:
    """Which cells there are, and what their tasks do."""

    def __init__(self, blocks: DataFrame, anchors: DataFrame) -> None:
        session = blocks.sparkSession
        usual = int(session.conf.get("spark.sql.shuffle.partitions"))
        self.lanes, self.groups = max(1, blocks.count()), max(1, -(-anchors.count() // BLOCK_ANCHORS))
        # cells are work, not bytes: AQE would put them all in a few tasks
        self.parts = max(usual, self.lanes * self.groups // 16)
        lane = F.pmod(F.xxhash64("ids"), F.lit(self.lanes)).cast("int")
        self.rows = blocks.withColumn("lane", lane).withColumn(
            "anchor_group", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1)))
        )

    def scored(self, anchors: DataFrame, choose: Callable) -> DataFrame:
        """What `choose` finds for each anchor in each cell."""
        cell = ["length", "anchor_group", "lane"]
        group = F.pmod(F.xxhash64("vec_id"), F.lit(self.groups)).cast("int")
        sent = anchors.withColumn("anchor_group", group).withColumn(
            "lane", F.explode(F.sequence(F.lit(0), F.lit(self.lanes - 1)))
        )

        def run(rows: pa.Table, some: pa.Table) -> pa.Table:
            out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
            if len(rows) and len(some):
                held = _Rows(rows, rows.column("length")[0].as_py())
                columns = (some.column(c).to_pylist() for c in ("vec_id", "label", "vector", "positives"))
                for anchor, label, vector, positives in zip(*columns):
                    for part in choose(held, anchor, label, np.array(vector, np.int64), positives):
                        n = len(part[-1])
                        for to, values in zip(out, (anchor, *part)):
                            to.append(np.broadcast_to(np.asarray(values, np.int64), n))
            names = [c.split()[0] for c in _SCORED.split(", ")]
            return pa.Table.from_arrays([pa.array(np.concatenate(v)) for v in out], names=names)

        left = self.rows.repartition(self.parts, *cell).groupBy(*cell)
        right = sent.repartition(self.parts, *cell).groupBy(*cell)
        return left.cogroup(right).applyInArrow(run, _SCORED)


def _positives(rows: _Rows, anchor: int, label: int, vector: np.ndarray, _) -> Iterator[tuple]:
    """The anchor's best other rows of its label."""
    places = np.flatnonzero((rows.labels == label) & (rows.ids != anchor))
    if not len(places):
        return
    low, high = Query(vector).interval(rows.codes.at(places))
    places = places[high >= _sure(rows, low, POSITIVES)]
    best, scores = _top(rows.ids[places], rows.scores(places, vector), POSITIVES)
    yield 0, 0, best, scores


def _negatives(rows: _Rows, anchor: int, label: int, vector: np.ndarray, positives: list) -> Iterator[tuple]:
    """For each positive, the best rows of other labels inside its band."""
    places = np.flatnonzero(rows.labels != label)
    bands = [(-(-LOWEST * p["score"] // 100), HIGHEST * p["score"] // 100) for p in positives]
    if not len(places) or all(least > most for least, most in bands):
        return
    low, high = Query(vector).interval(rows.codes.at(places))
    open_ = np.zeros(len(places), bool)
    for least, most in bands:
        inside = low[(low >= least) & (high <= most)]
        open_ |= (low <= most) & (high >= max(least, _sure(rows, inside, NEGATIVES)))
    places = places[open_]
    scores = rows.scores(places, vector)
    for positive, (least, most) in zip(positives, bands):
        inside = (scores >= least) & (scores <= most)
        best, own = _top(rows.ids[places[inside]], scores[inside], NEGATIVES)
        yield positive["id"], positive["score"], best, own


def _sure(rows: _Rows, low: np.ndarray, most: int) -> float:
    """A score that `most` rows reach for certain."""
    if len(low) < most or not rows.distinct:
        return -np.inf
    return float(np.partition(low, len(low) - most)[len(low) - most])


def _top(ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.stack([-scores, ids], axis=1), axis=0)[:most]
    return pairs[:, 1], -pairs[:, 0]
