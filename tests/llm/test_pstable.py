import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import pstable
from clickloom.llm.queries import QUERIES

from .conftest import SF

SCHEMA = "vec_id long, embedding array<double>"


def usable(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def by_brute_force(rows):
    """Links of all pairs; the vector that stands for equal ones is the node."""
    kept = [(vec, tuple(v)) for vec, v in rows if vec is not None and usable(v)]
    node = {}
    for vec, vector in kept:
        node[vector] = min(vec, node.get(vector, vec))
    parent = {n: n for n in node.values()}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    links = {}
    for vector in node:
        links[vector] = 0
        for other in node:
            if len(other) != len(vector):
                continue
            a, b = (np.ldexp(x, -np.frexp(np.abs(x).max())[1]) for x in map(np.array, (vector, other)))
            if vector == other or a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                links[vector] += sum(v == other for _, v in kept)
                low, high = sorted((root(node[vector]), root(node[other])))
                parent[high] = low
    out = []
    for vec, v in rows:
        if vec is None or not usable(v):
            out.append((vec, 0, vec, True))
        else:
            component = root(node[tuple(v)])
            out.append((vec, links[tuple(v)] - 1, component, vec == component))
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()], key=repr)


def groups(draw, n, size, noise, length=32):
    centres = draw.standard_normal((n, length))
    spread = draw.standard_normal((n, size, length)) * noise
    return (centres[:, None, :] + spread).reshape(-1, length)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found(QUERIES["op12_pstable_hashing"](spark, SF)) == by_brute_force(rows)


@pytest.mark.parametrize("block", [1024, 5])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Groups that are linked in full, in part and in chains, also over many blocks."""
    monkeypatch.setattr(pstable, "BLOCK", block)
    draw = np.random.default_rng(8)
    made = [groups(draw, 10, 6, 0.05), groups(draw, 10, 6, 0.3), groups(draw, 1, 60, 0.2)]
    angles = np.arange(12) * 0.35  # neighbours on an arc are linked, others not
    arc = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate(made))]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(arc)]
    rows += [(2000 + i, rows[i][1]) for i in range(0, 100, 3)]  # exact copies
    expected = by_brute_force(rows)
    assert sum(n for _, n, _, _ in expected) > 1000
    assert found(pstable.linked(spark.createDataFrame(rows, SCHEMA).repartition(7))) == expected


def test_recall_at_the_threshold(spark):
    """Pairs at the least cosine, the hardest to find."""
    draw = np.random.default_rng(9)
    first = draw.standard_normal((3000, 48))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = draw.standard_normal((3000, 48))
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = 0.9001
    second = cosine * first + (1 - cosine**2) ** 0.5 * other
    a, b = pstable.buckets(first), pstable.buckets(second)
    assert (a == b).any(axis=1).mean() > 0.997


def test_odd_rows(spark):
    draw = np.random.default_rng(5)
    long = draw.standard_normal(5000)
    rows = [
        (1, [1.0, 2.0, 3.0]),
        (1, [1.0, 2.0, 3.0]),
        (2, [2.0, 4.0, 6.0]),
        (3, [1e-200, 2e-200, 3e-200]),
        (4, [1e200, 2e200, 3e200]),
        (5, [-1.0, -2.0, -3.0]),
        (6, [0.0, 0.0, 0.0]),
        (6, [-0.0, 0.0, 0.0]),
        (7, None),
        (8, []),
        (9, [1.0, None, 3.0]),
        (10, [1.0, float("nan"), 3.0]),
        (11, [float("inf"), 2.0, 3.0]),
        (None, [1.0, 2.0, 3.0]),
        (None, None),
        (12, [1.0, 2.0]),
        (13, [1.0]),
        (14, [5.0]),
        (15, long.tolist()),
        (16, (long + 0.01).tolist()),
        (17, [0.0, 1.0, 0.0]),
        (18, [-0.0, 1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = "node vec_key vector links buckets copies table bucket own block label component".split()
    frame = frame.withColumns({c: F.lit("clash") for c in clashing})
    assert found(pstable.linked(frame)) == by_brute_force(rows)


def test_empty_table(spark):
    assert pstable.linked(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_pair_rows_leave_a_task(spark):
    """A group of near copies answers with a row for each member, not for each pair."""
    draw = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(groups(draw, 1, 300, 0.02))]
    frame = spark.createDataFrame(rows, SCHEMA)
    kind = np.dtype(np.float64)
    folded = pstable._keyed(frame, kind).selectExpr("vec_key", "vec_id as node", "1L as copies", "vector")
    answers = pstable._compared(pstable._dealt(pstable._hashed(folded, kind)), kind)
    n, links = answers.agg(F.count(F.lit(1)), F.sum("links")).first()
    assert links == 300 * 299
    assert n <= 300 * pstable.TABLES
