"""Removal of passages that an earlier document has, by fixed-block anchors.

Every document is cut into blocks of BLOCK words side by side; their hashes are the
index. Every window of BLOCK words, at each word of each document, is probed against
it. A window of WINDOW words that two documents share covers a whole block of
either, so all shared passages lie around a probe that hits. There the hit is extended: each
window of WINDOW words that covers it is compared, by a 64-bit hash, with the same
windows of all other documents, and the union of those that an earlier document has
is a maximal exact repeat.

Probes are as many as words. They travel packed: a task gathers the windows of a
batch of documents, keeps one of each hash, and sends each part of the hash range one
row with the hashes as numbers, ordered by document. A hash that a batch has in two
documents is known to be shared there and is sent once, so a passage that is
everywhere costs a row's entry for each batch, not for each document. Where there are more
than RANGES parts, batches are cut into as many ranges of parts first, and what has come
together of a range is cut into its parts, so that rows follow the data and not batches
times parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import encoded, mapped, parts_for, slices, window_hashes, word_hashes
from clickloom.session import stored

WINDOW = 50
#: A window covers a whole block wherever it begins.
BLOCK = WINDOW // 2
#: Text whose windows a task gathers before it sends them.
BATCH_BYTES = 16 << 20

#: Pieces that a batch is cut into at most.
RANGES = 512
#: Bits in which documents with hits are marked.
SLOTS = 1 << 26

_PACKED = "part int, known long, docs binary, counts binary, keys binary, blocks binary"
_DEALT = "docs_group int, docs binary, counts binary, keys binary"
_HITS = "doc_id long, keys binary"


def without_repeats(
    documents: DataFrame, finish: Callable[[Column], Column] = lambda kept: kept
) -> DataFrame:
    """doc_id, n_words, n_removed and kept of every row of `documents`; kept is
    `finish` of the words left, joined by one space (a digest spares storing them).

    A word goes if a window of WINDOW words covers it that also begins in a document
    of smaller doc_id. Windows are judged on the input. Texts of fewer words, null
    and empty ones lose nothing. Rows that repeat a doc_id don't remove from each
    other, and a row without doc_id neither loses words nor removes any.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = parts_for(rows, 8 << 20)
    anchored = stored(_shared(rows, parts, _probes, anchors=True), "anchored")
    marked = _marked(rows, anchored)
    # only texts that may have hits are shuffled to meet them
    suspected = marked.filter("marked").select("doc_id", "text")
    columns = ["doc_id", "n_words", "n_removed"]
    untouched = _joined(marked.filter("not marked").select("doc_id", "text"))

    touched = F.col("starts").isNotNull()
    screened = stored(
        _screened(suspected, anchored, parts).select(
            "doc_id",
            "n_words",
            F.when(~touched, finish(F.col("text"))).alias("kept"),
            F.when(touched, F.col("text")).alias("text"),
            "starts",
        ),
        "screened",
    )
    suspects = screened.filter(touched).select("doc_id", "n_words", "text", "starts")
    repeated = _shared(suspects, parts, _windows, anchors=False)
    cut = _cut(suspects, repeated)
    none = F.lit(0).cast("long").alias("n_removed")
    clean = screened.filter(~touched).select("doc_id", "n_words", none, "kept")
    return (
        untouched.select("doc_id", "n_words", none, finish(F.col("text")).alias("kept"))
        .unionByName(clean)
        .unionByName(cut.select(*columns, finish(F.col("text")).alias("kept")))
    )


# ---- documents that may have hits


def _marked(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` with `marked`, true for each whose doc_id is in `found` and for few others.

    The doc_ids' hashes are marked in SLOTS bits, whatever their number, so the broadcast
    has a fixed size. With very many, more rows are marked than need be.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    slots = found.select(slot.alias("slot"))
    bits = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    placed = rows.withColumn("bucket", F.bitmap_bucket_number(slot)).withColumn(
        "place", F.bitmap_bit_position(slot)
    )
    byte = F.substring("bits", (F.col("place") / 8).cast("int") + 1, F.lit(1))
    bit = F.expr("shiftright(int(conv(hex(byte), 16, 10)), int(place % 8)) & 1")
    # bounded: SLOTS / 8 bytes
    met = placed.join(F.broadcast(bits), "bucket", "left").withColumn("byte", byte)
    return met.select("doc_id", "text", (F.coalesce(bit, F.lit(0)) == 1).alias("marked"))


def _joined(rows: DataFrame) -> DataFrame:
    """doc_id, n_words and text: the words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                words = [_words(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([b" ".join(w).decode() for w in words], pa.string()),
                    ],
                    names=["doc_id", "n_words", "text"],
                )

    return mapped(rows, run, "doc_id long, n_words long, text string")


# ---- windows that documents share

#: doc_id, the hashes of a document's windows, and which of these are blocks.
Entry = tuple[int, np.ndarray, np.ndarray]


def _shared(
    rows: DataFrame,
    parts: int,
    entries: Callable[[pa.RecordBatch, list[str]], Iterator[Entry]],
    anchors: bool,
) -> DataFrame:
    """(doc_id, keys): for each document the packed names of its windows.

    With `anchors`, of those that hit a block and that another document has too;
    without, of those that a document of smaller doc_id has.
    """

    groups = parts

    # parts of a range, and whether batches are cut into ranges first
    span = -(-parts // RANGES)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entry] = []
        size = 0
        for batch in batches:
            for part, texts in slices(batch):
                held += [e for e in entries(part, texts) if e[0] is not None and len(e[1])]
                size += sum(map(len, texts))
                if size >= BATCH_BYTES:
                    yield from _sent(held, parts, span, anchors)
                    held, size = [], 0
        yield from _sent(held, parts, span, anchors)

    def meet(table: pa.Table) -> pa.Table:
        docs, keys = [], []
        for known, packed in zip(*(table.column(c).to_pylist() for c in ("known", "keys"))):
            if known is not None:
                keys.append(np.frombuffer(packed, np.uint64))
                docs.append(np.full(len(keys[-1]), known, np.int64))
        found, of = _met(table, anchors)
        return _dealt(np.concatenate([*keys, found]), np.concatenate([*docs, of]), groups)

    def merge(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_pylist() for c in ("docs", "counts", "keys"))
        docs, keys = [], []
        for some, counts, packed in zip(*columns):
            docs.append(np.repeat(np.frombuffer(some, np.int64), np.frombuffer(counts, np.uint32)))
            keys.append(np.frombuffer(packed, np.uint64))
        found = _by_document(np.concatenate(keys), np.concatenate(docs))
        return pa.Table.from_arrays(
            [
                pa.array([doc for doc, _ in found], pa.int64()),
                pa.array([k.tobytes() for _, k in found], pa.binary()),
            ],
            names=["doc_id", "keys"],
        )

    packed = mapped(rows, gather, _PACKED)
    if span > 1:
        packed = _cut_into_parts(packed, parts, span, anchors)
    replies = packed.groupBy("part").applyInArrow(meet, _DEALT)
    return replies.groupBy("docs_group").applyInArrow(merge, _HITS)


def _dealt(keys: np.ndarray, docs: np.ndarray, groups: int) -> pa.Table:
    """Replies of a part, one row for each group of documents."""
    group = docs % groups
    order = np.lexsort((docs, group))
    keys, docs, group = keys[order], docs[order], group[order]
    out: dict[str, list] = {c: [] for c in ("docs_group", "docs", "counts", "keys")}
    bounds = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(group)]
    for a, b in zip(bounds, bounds[1:]):
        own, counts = np.unique(docs[a:b], return_counts=True)
        out["docs_group"].append(int(group[a]))
        out["docs"].append(own.tobytes())
        out["counts"].append(counts.astype(np.uint32).tobytes())
        out["keys"].append(keys[a:b].tobytes())
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays(
        [pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out)
    )


def _sent(held: list[Entry], parts: int, span: int, anchors: bool) -> Iterator[pa.RecordBatch]:
    """Rows for the parts of the hash range, or for ranges of `span` parts, one entry for
    each hash of the batch."""
    if not held:
        return
    ids = np.array(sorted({doc for doc, _, _ in held}), np.int64)
    places = np.searchsorted(ids, np.array([doc for doc, _, _ in held], np.int64))
    owner = np.repeat(places.astype(np.int32), [len(h) for _, h, _ in held])
    keys = np.concatenate([h for _, h, _ in held])
    marks = np.concatenate([m for _, _, m in held])
    order = np.argsort(keys)
    keys, marks, owner = keys[order], marks[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.append(first, len(keys)))
    least, most = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)

    # settled here: windows of two documents of the batch; the earliest one still asks
    if anchors:
        ready = np.repeat(least < most, lengths)
    else:
        ready = owner > np.repeat(least, lengths)
    found = _by_document(_named(keys[ready], parts, anchors), ids[owner[ready]])
    for start in range(0, len(found), 1000):
        some = found[start : start + 1000]
        yield _rows(
            part=[int(doc) % parts // span for doc, _ in some],
            known=[int(doc) for doc, _ in some],
            keys=[k.tobytes() for _, k in some],
        )

    own, block = keys[first], np.logical_or.reduceat(marks, first)
    place = (_part_of(own, parts) // np.uint64(span)).astype(np.int64)
    yield from _dealt_out(own, ids[least], block, place, np.uint32 if anchors and span == 1 else np.uint64)


def _dealt_out(
    keys: np.ndarray, docs: np.ndarray, marks: np.ndarray, place: np.ndarray, kind: type
) -> Iterator[pa.RecordBatch]:
    """A row for each place: its keys by document, and which of them are blocks."""
    order = np.lexsort((docs, place))
    keys, docs, marks, place = keys[order], docs[order], marks[order], place[order]
    bounds = [*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(place)]
    for a, b in zip(bounds, bounds[1:]):
        own, counts = np.unique(docs[a:b], return_counts=True)
        yield _rows(
            part=[int(place[a])],
            docs=[own.tobytes()],
            counts=[counts.astype(np.uint32).tobytes()],
            keys=[keys[a:b].astype(kind).tobytes()],
            blocks=[keys[a:b][marks[a:b]].astype(kind).tobytes()],
        )


def _cut_into_parts(packed: DataFrame, parts: int, span: int, anchors: bool) -> DataFrame:
    """Rows of ranges as rows of parts. A range's rows are dealt over tasks, which
    gather them before they cut."""
    tasks = max(1, span // 16)
    salt = F.pmod(F.xxhash64("keys"), F.lit(tasks))
    ranges = -(-parts // span)
    dealt = packed.repartition(ranges * tasks, "part", salt).sortWithinPartitions("part")
    kind = np.uint32 if anchors else np.uint64

    def cut(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if held:
            keys = np.concatenate([k for k, _, _ in held])
            docs = np.concatenate([d for _, d, _ in held])
            marks = np.concatenate([m for _, _, m in held])
            yield from _dealt_out(keys, docs, marks, _part_of(keys, parts).astype(np.int64), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, of = 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "known", "docs", "counts", "keys", "blocks"))
            for place, known, docs, counts, packed_keys, blocks in zip(*columns):
                if known is not None:
                    yield _rows(part=[known % parts], known=[known], keys=[packed_keys])
                    continue
                if place != of or size >= BATCH_BYTES:
                    yield from cut(held)
                    held, size, of = [], 0, place
                keys = np.frombuffer(packed_keys, np.uint64)
                owner = np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32))
                held.append((keys, owner, np.isin(keys, np.frombuffer(blocks, np.uint64))))
                size += keys.nbytes
        yield from cut(held)

    return mapped(dealt, run, _PACKED)


def _rows(**columns: list) -> pa.RecordBatch:
    n = len(columns["part"])
    kinds = {"part": pa.int32(), "known": pa.int64()}
    names = ["part", "known", "docs", "counts", "keys", "blocks"]
    arrays = [pa.array(columns.get(c, [None] * n), kinds.get(c, pa.binary())) for c in names]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of the hashes' upper halves."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _named(hashes: np.ndarray, parts: int, anchors: bool) -> np.ndarray:
    """Anchors only choose what is compared: part and lower half of the hash name them.
    Windows are named by the whole hash."""
    if not anchors:
        return hashes
    return (_part_of(hashes, parts) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _met(table: pa.Table, anchors: bool) -> tuple[np.ndarray, np.ndarray]:
    """Names and documents of the windows of one part that are answered."""
    kind = np.uint32 if anchors else np.uint64
    keys, docs, blocks = [np.empty(0, kind)], [np.empty(0, np.int64)], [np.empty(0, kind)]
    part = 0
    for batch in table.to_batches():
        columns = (batch.column(c).to_pylist() for c in ("part", "known", "docs", "counts", "keys", "blocks"))
        for own, known, some, counts, packed, marked in zip(*columns):
            if known is None:
                part = own
                keys.append(np.frombuffer(packed, kind))
                docs.append(np.repeat(np.frombuffer(some, np.int64), np.frombuffer(counts, np.uint32)))
                blocks.append(np.frombuffer(marked, kind))
    key, doc = np.concatenate(keys), np.concatenate(docs)
    if anchors:
        hit = _among(key, np.unique(np.concatenate(blocks)))
        key, doc = key[hit], doc[hit]
    if not len(key):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    lengths = np.diff(np.append(first, len(key)))
    least = np.repeat(np.minimum.reduceat(doc, first), lengths)
    if anchors:
        asked = least < np.repeat(np.maximum.reduceat(doc, first), lengths)
        return (np.uint64(part) << np.uint64(32)) | key[asked].astype(np.uint64), doc[asked]
    asked = least < doc
    return key[asked], doc[asked]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _by_document(keys: np.ndarray, docs: np.ndarray) -> list[tuple[int, np.ndarray]]:
    if not len(keys):
        return []
    order = np.argsort(docs, kind="stable")
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return list(zip(docs[first].tolist(), np.split(keys, first[1:])))


# ---- documents


def _words(text: str) -> list[bytes]:
    return encoded(text).split()


def _probes(part: pa.RecordBatch, texts: list[str]) -> Iterator[Entry]:
    for doc, text in zip(part.column("doc_id").to_pylist(), texts):
        words = _words(text)
        if len(words) >= WINDOW:
            probes = window_hashes(word_hashes(words), BLOCK)
            yield doc, probes, np.arange(len(probes)) % BLOCK == 0


def _windows(part: pa.RecordBatch, texts: list[str]) -> Iterator[Entry]:
    columns = (part.column(c).to_pylist() for c in ("doc_id", "starts"))
    for doc, starts, text in zip(*columns, texts):
        windows = window_hashes(word_hashes(_words(text)), WINDOW)[np.frombuffer(starts, np.uint32)]
        yield doc, windows, np.zeros(len(windows), bool)


def _screened(rows: DataFrame, anchored: DataFrame, parts: int) -> DataFrame:
    """doc_id, n_words, text and starts: the begins of the windows to compare, packed;
    null if there is none, and then `text` is the words joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                counts, out, starts = [], [], []
                for text, packed in zip(texts, part.column("keys").to_pylist()):
                    words = _words(text)
                    around = _around(words, packed, parts) if packed else np.empty(0, np.uint32)
                    counts.append(len(words))
                    starts.append(around.tobytes() if len(around) else None)
                    out.append(text if len(around) else b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(out, pa.string()),
                        pa.array(starts, pa.binary()),
                    ],
                    names=["doc_id", "n_words", "text", "starts"],
                )

    joined = rows.join(anchored.hint("merge"), "doc_id", "left").select("doc_id", "text", "keys")
    return mapped(joined, run, "doc_id long, n_words long, text string, starts binary")


def _around(words: list[bytes], packed: bytes, parts: int) -> np.ndarray:
    """Begins of the windows of WINDOW words that cover a block found by a probe."""
    n = len(words)
    if n < WINDOW:
        return np.empty(0, np.uint32)
    probes = _named(window_hashes(word_hashes(words), BLOCK), parts, anchors=True)
    places = np.flatnonzero(_among(probes, np.unique(np.frombuffer(packed, np.uint64))))
    steps = np.zeros(n + 2, np.int64)
    np.add.at(steps, np.maximum(places - (WINDOW - BLOCK), 0), 1)
    np.add.at(steps, places + 1, -1)
    return np.flatnonzero(np.cumsum(steps)[: n - WINDOW + 1] > 0).astype(np.uint32)


def _cut(suspects: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and text: the words outside repeats, joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                removed, out = [], []
                columns = (part.column(c).to_pylist() for c in ("starts", "keys"))
                for text, starts, packed in zip(texts, *columns):
                    words = _words(text)
                    keep = np.ones(len(words), bool)
                    if packed:
                        begins = np.frombuffer(starts, np.uint32)
                        windows = window_hashes(word_hashes(words), WINDOW)[begins]
                        known = np.unique(np.frombuffer(packed, np.uint64))
                        steps = np.zeros(len(words) + 1, np.int64)
                        hit = begins[_among(windows, known)].astype(np.int64)
                        steps[hit] += 1
                        steps[hit + WINDOW] -= 1
                        keep = np.cumsum(steps)[:-1] == 0
                    removed.append(len(words) - int(keep.sum()))
                    out.append(b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("n_words"),
                        pa.array(removed, pa.int64()),
                        pa.array(out, pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "text"],
                )

    joined = suspects.join(repeated.hint("merge"), "doc_id", "left")
    joined = joined.select("doc_id", "n_words", "text", "starts", "keys")
    return mapped(joined, run, "doc_id long, n_words long, n_removed long, text string")
