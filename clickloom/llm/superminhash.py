"""Near duplicates by SuperMinHash signatures, banding, verification, components.

SuperMinHash gives each element a random permutation of the slots and lets its
j-th slot compete with a value in [j, j + 1). Slots of one element never clash, so
signatures of small sets vary less than with independent hashes. Levels are run
over all elements of many documents at once; a document stops at the level at
which each slot holds a value, as later levels only bring larger ones.

Documents with the same set are one class. Classes that share a band of the
signature are first compared with the smallest of their bucket, which takes as
many comparisons as rows. What that leaves open inside a bucket meets in blocks, so that no
task holds a large one. First only signatures travel: they tell which members have
an open partner at all, that is one of another component whose size and
intersection with the bucket's smallest allow a link, in the first bucket they share. The sets
of those follow. A task indexes the rarest elements of each set, of which two linked
sets must share one, and joins what it has linked at once, so that members already
together are not compared. It answers with a forest: a row for each member at
most, never one for each pair. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.components import components
from clickloom.llm.words import encoded, mapped, mixed, slices, window_hashes, word_hashes
from clickloom.operators.skew import shuffled_apart
from clickloom.session import stored

SHINGLE = 5
BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
#: Links: PERCENT * size of the union at most 100 * size of the intersection.
PERCENT = 85
#: Members of a bucket that one task compares with each other or with as many others,
#: and elements of their sets.
BLOCK, BLOCK_ELEMENTS = 2000, 1 << 19

_EMPTY = np.uint64(2**64 - 1)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    hashes = word_hashes(encoded(text).lower().split())
    if 0 < len(hashes) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes())], np.uint64)
    return np.unique(window_hashes(hashes, SHINGLE))


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """A row of 16-bit digests of the slots' least values for each set; an empty
    set gives a row of its own constant."""
    sizes = np.array([len(s) for s in sets])
    least = np.full(len(sets) * slots, _EMPTY)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)

    def drawn(values: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        bits = mixed(values + np.uint64((level + 1) * 0xD1342543DE82EF95 % 2**64))
        slot = ((bits >> np.uint64(32)) * np.uint64(slots - level)) >> np.uint64(32)
        height = (bits & np.uint64(0xFFFFFFFF)) | np.uint64(level << 32)
        return slot.astype(np.int64) + level, height

    first, height = drawn(flat, 0)
    np.minimum.at(least, owner * slots + first, height)
    going = _unfilled(least, slots)[owner]
    flat, owner, first = flat[going], owner[going], first[going]
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(flat), 1))
    rows = np.arange(len(flat))
    order[rows, first] = 0
    for level in range(1, slots):
        if not len(rows):
            break
        at, height = drawn(flat, level)
        slot = order[rows, at]
        order[rows, at] = order[rows, level]
        np.minimum.at(least, owner * slots + slot, height)
        going = _unfilled(least, slots)[owner]
        if not going.all():
            flat, owner, rows = flat[going], owner[going], rows[going]
    return (mixed(least) >> np.uint64(48)).astype(np.uint16).reshape(len(sets), slots)


def _unfilled(least: np.ndarray, slots: int) -> np.ndarray:
    return (least.reshape(-1, slots) == _EMPTY).any(axis=1)


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit hash of the set; null for an empty one)
    and signature of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                sets = [shingle_set(t) for t in texts]
                keys = [_key_of(s) for s in sets]
                rows = [row.tobytes() for row in superminhash(sets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(rows, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "signature"],
                )

    return mapped(
        documents.select("doc_id", "text"), run, "doc_id long, n_shingles long, set_key binary, signature binary"
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id for every row of `documents`.

    component_id is the smallest doc_id reachable over links, class_id the smallest
    with the same set. A document without words is linked with nothing. Rows that
    repeat a doc_id are returned each; their sets are compared each by itself, and those
    that stand under one class_id share a component. A row without
    doc_id takes part as a copy of rows that have one; otherwise it stands alone, with
    null as its ids, and is kept. Other columns of `documents` are not used.
    """
    return _labelled(documents).drop("set_key")


def _labelled(documents: DataFrame) -> DataFrame:
    signed = stored(signatures(documents), "signatures")
    classes = (
        signed.filter("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("class_id"),
            F.first("n_shingles").alias("size"),
            F.first("signature").alias("signature"),
        )
        .filter("class_id is not null")
    )
    classes = stored(classes, "classes")
    members = stored(_bucket_members(classes), "buckets")
    sets = _sets_of(documents, members)

    apart = members.filter("set_key <> hub.set_key")
    stars = stored(_compared(apart.select("set_key", "class_id", "hub").distinct(), sets), "stars")
    links = stars.filter(_linked()).select(F.col("class_id").alias("a"), F.col("hub_id").alias("b"))
    first = components(links)
    rest = _forest(_open_members(members, stars, first, classes), sets)
    found = components(
        first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest.select("a", "b"))
    )

    named = (
        classes.select("set_key", "class_id")
        .join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("set_key", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    )
    labelled = signed.select("doc_id", "n_shingles", "set_key").join(
        shuffled_apart(named).hint("merge"), "set_key", "left"
    )
    component = F.coalesce("component_id", "doc_id")
    return labelled.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        "set_key",
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents that near_duplicates() keeps, all columns. Rows that repeat a kept
    doc_id and its set are one; with another set each is judged by itself. Rows
    without doc_id stay."""
    judged = stored(
        _labelled(documents).filter("doc_id is not null").select("doc_id", "set_key", "kept"), "judged"
    )
    rows = judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    once, several = (rows.filter(f"kept and rows {n}").select("doc_id") for n in ("= 1", "> 1"))
    single = documents.join(once.hint("merge"), "doc_id", "left_semi").select(documents.columns)
    repeated = _with_set_key(documents.join(several.hint("merge"), "doc_id", "left_semi"))
    kept = judged.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("set_key").alias("kept_key"))
    same = (F.col("row_id") == F.col("kept_id")) & F.col("row_key").eqNullSafe(F.col("kept_key"))
    judged_alone = (
        repeated.withColumn("row_id", F.col("row.doc_id").cast("long"))
        .join(kept.hint("merge"), same, "left_semi")
        .dropDuplicates(["row_id", "row_key"])
        .select("row.*")
    )
    return single.unionByName(judged_alone).unionByName(documents.filter("doc_id is null"))


def _with_set_key(documents: DataFrame) -> DataFrame:
    """row, the whole row as one value, and row_key, the hash of its set."""
    rows = documents.select(F.struct("*").alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                keys = [_key_of(shingle_set(t)) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(keys, pa.binary())], names=["row", "row_key"]
                )

    return mapped(rows, run, T.StructType([rows.schema["row"], T.StructField("row_key", T.BinaryType())]))


def _key_of(elements: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None


def _linked():
    union = F.col("size") + F.col("hub_size") - F.col("common")
    return 100 * F.col("common") >= PERCENT * union


def _bucket_members(classes: DataFrame) -> DataFrame:
    """(band, key, set_key, class_id, size, hub, members, elements) for buckets of two
    classes or more; hub is the smallest."""
    width = 2 * ROWS
    keys = [F.substring("signature", 1 + width * b, width) for b in range(BANDS)]
    rows = classes.select(
        "set_key", "class_id", "size", F.posexplode(F.array(*keys)).alias("band", "key")
    )
    buckets = (
        rows.groupBy("band", "key")
        .agg(
            F.min(F.struct("class_id", "set_key")).alias("hub"),
            F.count(F.lit(1)).alias("members"),
            F.sum("size").alias("elements"),
        )
        .filter("members > 1")
    )
    return rows.join(shuffled_apart(buckets).hint("merge"), ["band", "key"])


def _sets_of(documents: DataFrame, members: DataFrame) -> DataFrame:
    """(set_key, elements) of the classes that have any candidate; the elements packed."""
    wanted = members.select(F.col("class_id").alias("wanted_id"), "set_key").distinct()
    texts = documents.select(F.col("doc_id").cast("long").alias("wanted_id"), "text")
    # a shuffle at every size: what is broadcast while it is small would grow unevenly
    met = texts.join(wanted.hint("merge"), "wanted_id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                # where a doc_id has several texts, each key is one of them
                keys = part.column("set_key").to_pylist()
                sets = [shingle_set(t) for t in texts]
                own = [(k, s.tobytes()) for k, s in zip(keys, sets) if _key_of(s) == k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[n] for x in own], pa.binary()) for n in (0, 1)],
                    names=["set_key", "elements"],
                )

    return stored(mapped(met, run, "set_key binary, elements binary"), "sets")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sizes of the full sets of each class and its hub, and of their intersection."""
    left = sets.withColumnRenamed("elements", "left")
    right = sets.select(F.col("set_key").alias("hub_key"), F.col("elements").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[tuple[int, int, int]] = []
            for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                own, other = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(own, other, assume_unique=True))
                counts.append((len(own), len(other), common))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * 3
            keys = [batch.column(c) for c in ("set_key", "class_id", "hub_key", "hub_id")]
            yield pa.RecordBatch.from_arrays(
                [*keys, *columns],
                names=["set_key", "class_id", "hub_key", "hub_id", "size", "hub_size", "common"],
            )

    pairs = pairs.select(
        "set_key", "class_id", F.col("hub.set_key").alias("hub_key"), F.col("hub.class_id").alias("hub_id")
    )
    joined = pairs.join(left.hint("merge"), "set_key").join(right.hint("merge"), "hub_key")
    joined = joined.select("set_key", "class_id", "hub_key", "hub_id", "left", "right")
    schema = "set_key binary, class_id long, hub_key binary, hub_id long, size long, hub_size long, common long"
    return mapped(joined, run, schema)


_GROUP = ["band", "key", "block", "with_block"]
_OPEN = "band int, key binary, block int, with_block int, own int, set_key binary, class_id long, component long"


def _open_members(
    members: DataFrame, stars: DataFrame, first: DataFrame, classes: DataFrame
) -> DataFrame:
    """Members of a bucket with a partner there that the comparison with its smallest
    leaves open, one row for each pair of blocks.

    A bucket of two is settled by that comparison, and so is one in a single
    component.
    """
    labels = first.withColumnRenamed("node", "class_id")
    wide = (
        members.filter("members > 2")
        .withColumn("hub_key", F.col("hub.set_key"))
        .join(labels, "class_id", "left")
        .withColumn("component", F.coalesce("component", "class_id"))
    )
    mixed_buckets = (
        wide.groupBy("band", "key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("band", "key")
    )
    shared = stars.groupBy("set_key", "hub_key").agg(F.max("common").alias("with_hub"))
    rows = (
        wide.join(shuffled_apart(mixed_buckets), ["band", "key"])
        .filter("set_key <> hub_key")  # the smallest has been compared with all
        .join(shuffled_apart(shared), ["set_key", "hub_key"])
        .join(classes.select("set_key", "signature"), "set_key")
    )
    blocks = F.greatest(
        F.ceil(F.col("members") / BLOCK), F.ceil(F.col("elements") / BLOCK_ELEMENTS)
    ).cast("int")
    own = F.pmod(F.xxhash64("set_key"), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    dealt = dealt.select(
        "band",
        "key",
        F.least("own", "other").alias("block"),
        F.greatest("own", "other").alias("with_block"),
        "own",
        "set_key",
        "class_id",
        "component",
        "size",
        "with_hub",
        "signature",
    )
    ordered = dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _OPEN.split(", ")]
        for table, ends in _groups(batches):
            open_ = np.zeros(len(table), bool)
            for a, b in zip([0, *ends], ends):
                open_[a:b] = _has_open_partner(table.slice(a, b - a))
            yield from table.select(names).filter(pa.array(open_)).combine_chunks().to_batches()

    return mapped(ordered, run, _OPEN)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Whole groups, with the ends of each; rows come ordered by group, and the last
    group of a batch may go on in the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        ends = _group_ends(batch)
        if len(ends) == 1 and (len(held) == 1 or _same_group(held[-2], batch)):
            continue
        table = pa.Table.from_batches(held)
        ends = _group_ends(table)
        yield table.slice(0, ends[-2]), ends[:-1]
        held = table.slice(ends[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, _group_ends(table)


def _same_group(before: pa.RecordBatch, after: pa.RecordBatch) -> bool:
    return all(before.column(c)[len(before) - 1] == after.column(c)[0] for c in _GROUP)


def _group_ends(table: pa.Table | pa.RecordBatch) -> list[int]:
    change = np.zeros(len(table) - 1, bool)
    for name in ("band", "block", "with_block"):
        values = table.column(name).to_numpy()
        change |= values[1:] != values[:-1]
    keys = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint64)
    change |= keys[1:] != keys[:-1]
    return [*(np.flatnonzero(change) + 1).tolist(), len(table)]


def _has_open_partner(group: pa.Table) -> np.ndarray:
    v = {
        c: group.column(c).to_numpy()
        for c in ("band", "block", "with_block", "own", "component", "size", "with_hub")
    }
    marks = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16)
    bands = np.ascontiguousarray(marks.reshape(len(group), -1)).view(np.uint64)
    size, inside = v["size"].astype(float), v["with_hub"].astype(float)
    across, band = v["block"][0] != v["with_block"][0], v["band"][0]
    out = np.zeros(len(group), bool)
    for i in range(len(group)):
        others = v["component"] != v["component"][i]
        if across:
            others &= v["own"] != v["own"][i]
        # the sizes, and what each has in common with the bucket's smallest, bound the overlap
        most = np.minimum(inside, inside[i]) + np.minimum(size - inside, size[i] - inside[i])
        others &= 100 * most >= PERCENT * (size + size[i] - most)
        j = np.flatnonzero(others)
        # of the bands they share, the first brings the pair
        out[i] = len(j) and (bands[j, :band] != bands[i, :band]).all(axis=1).any()
    return out


def _forest(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of class_ids: links that make the same components as all links of each
    group do."""
    met = members.join(sets.hint("merge"), "set_key")
    ordered = met.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in _groups(batches):
            pairs: list[tuple[int, int]] = []
            for a, b in zip([0, *ends], ends):
                pairs += _links_of_group(table.slice(a, b - a))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[n] for p in pairs], pa.int64()) for n in (0, 1)], names=["a", "b"]
            )

    return mapped(ordered, run, "a long, b long")


def _links_of_group(group: pa.Table) -> list[tuple[int, int]]:
    nodes = group.column("class_id").to_pylist()
    own = group.column("own").to_numpy()
    across = group.column("block")[0].as_py() != group.column("with_block")[0].as_py()
    sets = [np.frombuffer(e, np.uint64) for e in group.column("elements").to_pylist()]
    index = _Index(sets)
    _, label = np.unique(group.column("component").to_numpy(), return_inverse=True)
    out: list[tuple[int, int]] = []
    for i in range(len(nodes)):
        rest = index.partners(i)
        if across:
            rest = rest[own[rest] != own[i]]
        step = 1
        while True:
            rest = rest[label[rest] != label[i]]
            if not len(rest):
                break
            # a few of each component at a time: one link settles all of it
            order = np.argsort(label[rest], kind="stable")
            rest = rest[order]
            starts = np.flatnonzero(np.diff(label[rest], prepend=-1))
            place = np.arange(len(rest)) - np.repeat(starts, np.diff([*starts, len(rest)]))
            some, rest = rest[place < step], rest[place >= step]
            for j in some[index.linked(i, some)].tolist():
                if label[i] != label[j]:
                    out.append((nodes[i], nodes[j]))
                    label[label == label[j]] = label[i]
            step *= 4
    return out


class _Index:
    """The rarest elements of each set of a group. Two sets that are linked share one
    of the first (100 - PERCENT) per cent, and one more, of each, in any order of the elements."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        self.ends = np.cumsum(self.sizes)
        values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(values))
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.elements = rank[places]
        order = np.lexsort((self.elements, owner))
        self.elements = self.elements[order]
        self.seen = np.zeros(len(values), bool)
        least = -(-PERCENT * self.sizes // 100)
        inside = np.arange(len(owner)) - np.repeat(self.ends - self.sizes, self.sizes)
        rare = inside < (self.sizes - least + 1)[owner]
        by_element = np.lexsort((owner[rare], self.elements[rare]))
        self.holders = owner[rare][by_element]
        self.keys, self.starts = np.unique(self.elements[rare][by_element], return_index=True)
        self.stops = np.append(self.starts[1:], len(self.holders))
        self.firsts = self.sizes - least + 1

    def partners(self, i: int) -> np.ndarray:
        """Earlier sets that may be linked with the i-th one."""
        start = self.ends[i] - self.sizes[i]
        at = np.searchsorted(self.keys, self.elements[start : start + self.firsts[i]])
        runs = [self.holders[a:b] for a, b in zip(self.starts[at], self.stops[at]) if b - a > 1]
        if not runs:
            return np.empty(0, np.int64)
        found = np.unique(np.concatenate(runs))
        found = found[found < i]
        small, large = np.minimum(self.sizes[found], self.sizes[i]), np.maximum(self.sizes[found], self.sizes[i])
        return found[100 * small >= PERCENT * large]

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.elements[self.ends[i] - self.sizes[i] : self.ends[i]]
        self.seen[own] = True
        parts = [self.elements[self.ends[j] - self.sizes[j] : self.ends[j]] for j in others.tolist()]
        starts = np.cumsum([0, *(len(p) for p in parts[:-1])])
        common = np.add.reduceat(self.seen[np.concatenate(parts)].astype(np.int64), starts)
        self.seen[own] = False
        return 100 * common >= PERCENT * (self.sizes[i] + self.sizes[others] - common)
