"""Near duplicates among embeddings by p-stable hashing and exact cosines.

Vectors are normalised. In each table, random Gaussian projections plus an offset are cut into
cells of equal width, and the cells of all projections together name a bucket.
Two unit vectors at cosine c lie sqrt(2 - 2c) apart; with the values below a pair at
exactly THRESHOLD shares a projection's cell with probability 0.82, all of a table's
with 0.14, and no table with 7e-4. Pairs that are closer miss less: 1e-6 at cosine 0.95.

Equal vectors are folded before they are hashed. Members of a bucket meet in blocks,
so that no task holds a large one, and each pair is compared, exactly, in the
first table that it shares. A block answers with one row for each of its members: how
many vectors it is linked with, and the smallest one it hangs together with there. Pairs
themselves never leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.vectors import by_length, component_kind
from clickloom.llm.words import mapped
from clickloom.operators.skew import shuffled_apart
from clickloom.session import stored

#: Vectors are linked from this cosine on.
THRESHOLD = 0.9
TABLES, PROJECTIONS, WIDTH = 48, 10, 2.0
SEED = 12
#: Members of a bucket that one task compares with each other or with as many others.
BLOCK = 1024

_HASHED = "vec_key binary, node long, copies long, vector binary, buckets array<int>"
_ANSWER = "vec_key binary, node long, links long, root long"

_drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def linked(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `embeddings`.

    n_links counts the other rows at cosine THRESHOLD or more, component_id is the
    smallest vec_id reachable over such links. A null vector, one without components,
    of zeros only, or with a component that is null or not finite has no links, nor has
    a row without vec_id, whose ids stay null. Vectors of different lengths
    are not compared. Rows that repeat a vec_id are vectors of their own, linked if
    their vectors are, and in one component. Other columns are not used.
    """
    kind = component_kind(embeddings, "embedding")
    keyed = stored(_keyed(embeddings, kind), "vectors")
    folded = (
        keyed.filter("vec_key is not null")
        .groupBy("vec_key")
        .agg(
            F.min("vec_id").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
        )
    )
    hashed = stored(_hashed(folded, kind), "hashed")
    answers = stored(_compared(_dealt(hashed), kind), "answers")

    links = answers.groupBy("vec_key").agg(F.sum("links").alias("links"))
    found = components(answers.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        hashed.select("vec_key", "node", "copies")
        .join(shuffled_apart(links).hint("merge"), "vec_key", "left")
        .join(shuffled_apart(found).hint("merge"), "node", "left")
        .select(
            "vec_key",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    labelled = keyed.select("vec_id", "vec_key").join(
        shuffled_apart(named).hint("merge"), "vec_key", "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return labelled.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _keyed(embeddings: DataFrame, kind: np.dtype) -> DataFrame:
    """vec_id, vec_key (128-bit hash of the vector) and vector of every row; the last
    two are null where there is nothing to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            keys: list[bytes | None] = [None] * len(batch)
            vectors: list[bytes | None] = [None] * len(batch)
            for places, matrix in by_length(batch.column("embedding")):
                matrix = (matrix + 0.0).astype(kind)  # one zero
                for place, vector in zip(places.tolist(), matrix):
                    if vector.any() and ids[place].is_valid:
                        vectors[place] = vector.tobytes()
                        keys[place] = xxhash.xxh3_128_digest(vectors[place])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
                names=["vec_id", "vec_key", "vector"],
            )

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return mapped(rows, run, "vec_id long, vec_key binary, vector binary")


def _projections(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and offsets for vectors of a length, alike on every executor."""
    if length not in _drawn:
        draw = np.random.default_rng([SEED, length])
        directions = draw.standard_normal((length, TABLES * PROJECTIONS))
        _drawn[length] = directions, draw.uniform(0, WIDTH, TABLES * PROJECTIONS)
    return _drawn[length]


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that no square is too large or small for a double."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1])


def buckets(matrix: np.ndarray) -> np.ndarray:
    """A 32-bit name of each row's bucket in each table."""
    directions, offsets = _projections(matrix.shape[1])
    matrix = scaled(matrix)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    cells = np.floor((unit @ directions + offsets) / WIDTH).astype(np.int16)
    cells = np.ascontiguousarray(cells.reshape(len(matrix), TABLES, PROJECTIONS))
    names = [
        xxhash.xxh32_intdigest(cell.tobytes(), matrix.shape[1]) for row in cells for cell in row
    ]
    return np.array(names, np.uint32).view(np.int32).reshape(len(matrix), TABLES)


def _hashed(folded: DataFrame, kind: np.dtype) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.frombuffer(v, kind).astype(np.float64) for v in batch.column("vector").to_pylist()]
            names = np.zeros((len(batch), TABLES), np.int32)
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                places = np.flatnonzero(lengths == length)
                names[places] = buckets(np.stack([vectors[i] for i in places]))
            ends = pa.array(np.arange(len(batch) + 1) * TABLES, pa.int32())
            arrays = [batch.column(c) for c in ("vec_key", "node", "copies", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(ends, pa.array(names.reshape(-1)))],
                names=["vec_key", "node", "copies", "vector", "buckets"],
            )

    return mapped(folded, run, _HASHED)


def _dealt(hashed: DataFrame) -> DataFrame:
    """The members of each bucket of two or more, one row for each pair of blocks they
    take part in; the vector joins last, so that it is shuffled once."""
    size = F.octet_length("vector").alias("bytes")  # of one length only
    entries = hashed.select("vec_key", size, F.posexplode("buckets").alias("table", "bucket"))
    bucket = ["table", "bucket", "bytes"]
    sizes = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = entries.join(shuffled_apart(sizes).hint("merge"), bucket)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("vec_key"), blocks).cast("int")
    members = members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    members = members.select(
        "vec_key",
        *bucket,
        "own",
        F.least("own", "other").alias("block"),
        F.greatest("own", "other").alias("with_block"),
    )
    dealt = members.join(hashed.hint("merge"), "vec_key")
    return dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


_GROUP = ["table", "bucket", "bytes", "block", "with_block"]


def _compared(dealt: DataFrame, kind: np.dtype) -> DataFrame:
    """The answers of all groups; rows come ordered by group, and the last group of a
    batch may go on in the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            ends = _group_ends(table)
            last = ends[-2] if len(ends) > 1 else 0
            yield _answers(table.slice(0, last), ends[:-1], kind)
            held = table.slice(last)
        if held is not None:
            yield _answers(held, _group_ends(held), kind)

    return mapped(dealt, run, _ANSWER)


def _group_ends(table: pa.Table) -> list[int]:
    if not len(table):
        return []
    change = np.zeros(len(table) - 1, bool)
    for name in _GROUP:
        values = table.column(name).to_numpy()
        change |= values[1:] != values[:-1]
    return [*(np.flatnonzero(change) + 1).tolist(), len(table)]


def _answers(table: pa.Table, ends: list[int], kind: np.dtype) -> pa.RecordBatch:
    n = len(table)
    links, root = np.zeros(n, np.int64), np.arange(n)
    least = node = table.column("node").to_numpy()
    if n:
        copies = table.column("copies").to_numpy()
        names = table.column("buckets").combine_chunks().flatten().to_numpy().reshape(-1, TABLES)
        vectors = table.column("vector").to_pylist()
        first, own, block, with_block = (
            table.column(c).to_numpy() for c in ("table", "own", "block", "with_block")
        )
        for a, b in zip([0, *ends], ends):
            matrix = np.frombuffer(b"".join(vectors[a:b]), kind).reshape(b - a, -1).astype(np.float64)
            across = own[a:b] if block[a] != with_block[a] else None
            inside = np.arange(b - a)
            for i, j in _pairs(matrix, names[a:b], first[a], across):
                np.add.at(links, a + i, copies[a + j])
                np.add.at(links, a + j, copies[a + i])
                _join(inside, i, j)
            root[a:b] = a + inside
        # the smallest node of each tree
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, root, node)
        least = least[root]
    touched = links > 0
    keys = table.column("vec_key").combine_chunks().filter(pa.array(touched))
    arrays = [keys, *(pa.array(x[touched], pa.int64()) for x in (node, links, least))]
    return pa.RecordBatch.from_arrays(arrays, names=["vec_key", "node", "links", "root"])


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Makes `root` alike for all that hang together over the pairs."""
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        apart = low < high
        if not apart.any():
            return
        target = np.arange(len(root))
        np.minimum.at(target, high[apart], low[apart])
        while (target[target] != target).any():
            target = target[target]
        root[:] = target[root]


def _pairs(
    matrix: np.ndarray, names: np.ndarray, first: int, across: np.ndarray | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of a group that share no table before `first`, as places in it;
    where two blocks meet, `across` tells them apart."""
    matrix = scaled(matrix)
    norms = np.linalg.norm(matrix, axis=1)
    for start in range(0, len(matrix), 256):
        left = slice(start, start + 256)
        cosines = matrix[left] @ matrix.T / np.outer(norms[left], norms)
        i, j = np.nonzero(cosines >= THRESHOLD)
        i += start
        ready = (i < j) if across is None else (across[i] < across[j])
        i, j = i[ready], j[ready]
        for earlier in range(first):
            if not len(i):
                break
            apart = names[i, earlier] != names[j, earlier]
            i, j = i[apart], j[apart]
        if len(i):
            yield i, j
