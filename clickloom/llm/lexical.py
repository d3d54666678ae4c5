"""Ranked lexical search: the best documents of each item by an integer BM25.

Documents are scanned once into postings of the items' terms. A task then takes its
documents in blocks. For each item the documents of a block get a bitmap of the
item's terms that they hold, and equal bitmaps are one group. The most that any
document of a group can score is the sum of its terms' largest contributions in the
block. Groups are scored by descending maximum, until no further one can reach the
item's best so far in that task; so a document whose terms can't bring it among the
best is never scored. The tasks' best meet in a window for each item.

Items are searched in groups of bounded size, each with a scan of its own, so that what
the driver and the tasks hold of the items does not grow with their table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.words import encoded, mapped, slices
from clickloom.operators.ordered import running_totals
from clickloom.session import stored

#: Documents returned for each item.
MOST = 10
#: Text of the items that are searched in one scan; a longer text has one of its own.
ITEM_BYTES = 8 << 20
#: Documents and postings of a block; a document is never split.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 2 << 20

#: ASCII letters and digits, and all beyond ASCII, make terms.
_LETTERS = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 0x20 for b in range(256)
)

_POSTINGS = "doc_id long, n_terms long, terms array<int>, counts array<int>"
_FOUND = "item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII; A-Z in lower case."""
    return encoded(text or "").translate(_LETTERS).split()


def searched(documents: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """item_id, rank, doc_id and score: the `most` best documents of each item, those
    with a score above 0.

    Equal scores go by ascending doc_id. A text without terms, or null, is no document
    and no item. Rows that repeat a doc_id are documents of their own, and each may be
    returned. A row without doc_id counts in all statistics but can't be returned. Of
    rows that repeat an item_id the smallest text counts; null is an item_id like
    others. Other columns of either table are not used.
    """
    grouped = _grouped(items)
    groups = grouped.agg(F.max("item_group")).first()[0]
    spark = documents.sparkSession
    found = spark.createDataFrame([], _FOUND)
    for group in range(0 if groups is None else groups + 1):
        # bounded: ITEM_BYTES of text and one text more
        rows = grouped.filter(F.col("item_group") == group).select("item_id", "text").collect()
        found = found.unionByName(_best(documents, _Items(rows), most))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _grouped(items: DataFrame) -> DataFrame:
    """item_id, text and item_group: consecutive items of about ITEM_BYTES of text."""
    own = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    own = own.filter("text is not null").withColumn("size", F.octet_length("text").cast("long"))
    totals = running_totals(own, ["item_id"], ["size"])
    group = F.floor(F.col("size_before") / ITEM_BYTES).cast("long")
    return stored(totals.select("item_id", "text", group.alias("item_group")), "items")


class _Items:
    """Numbered terms of some items, and each item's terms with their repeats."""

    def __init__(self, rows: list) -> None:
        self.numbers: dict[bytes, int] = {}
        self.items: list[tuple[int | None, np.ndarray, np.ndarray]] = []
        for row in sorted(rows, key=lambda r: (r.item_id is not None, r.item_id)):
            numbers = [self.numbers.setdefault(t, len(self.numbers)) for t in terms_of(row.text)]
            if numbers:
                own, repeats = np.unique(np.array(numbers, np.int64), return_counts=True)
                self.items.append((row.item_id, own, repeats.astype(np.int64)))


def _best(documents: DataFrame, items: _Items, most: int) -> DataFrame:
    """The best documents of each item in each task."""
    context = documents.sparkSession.sparkContext
    known = context.broadcast(items.numbers)  # bounded by ITEM_BYTES
    postings = stored(_postings(documents, known), "postings")
    sums = postings.agg(F.count(F.lit(1)).alias("documents"), F.sum("n_terms").alias("terms")).first()
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").count()
    in_documents = np.zeros(len(items.numbers), np.int64)
    for row in held.collect():  # bounded: one row for each term of these items
        in_documents[row.term] = row["count"]
    weights = np.floor(1000 * np.log((2 * sums.documents + 2) / (2 * in_documents + 1))).astype(np.int64)
    wanted = context.broadcast([(i, own, weights[own] * n) for i, own, n in items.items])
    n_documents, n_terms = sums.documents, sums.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [_Top(most) for _ in wanted.value]
        for block in _blocks(batches, n_documents, n_terms):
            for top, (_, own, weight) in zip(tops, wanted.value):
                _search(block, own, weight, top)
        ids = [i for top, (i, _, _) in zip(tops, wanted.value) for _ in top.docs]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(np.concatenate([np.empty(0, np.int64), *(t.docs for t in tops)])),
                pa.array(np.concatenate([np.empty(0, np.int64), *(t.scores for t in tops)])),
            ],
            names=["item_id", "doc_id", "score"],
        )

    return mapped(postings.filter("doc_id is not null"), run, _FOUND)


def _postings(documents: DataFrame, known) -> DataFrame:
    """For every document with a term: how many it has, and which of the known ones
    how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            for part, texts in slices(batch):
                totals, numbers, counts, ends = [], [], [], [0]
                for text in texts:
                    terms = terms_of(text)
                    hits = np.array([n for n in map(number, terms) if n is not None], np.int32)
                    own, repeats = np.unique(hits, return_counts=True)
                    totals.append(len(terms))
                    numbers.append(own)
                    counts.append(repeats.astype(np.int32))
                    ends.append(ends[-1] + len(own))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(totals, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(numbers), pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts), pa.int32())),
                    ],
                    names=["doc_id", "n_terms", "terms", "counts"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mapped(rows, run, _POSTINGS).filter("n_terms > 0")


class _Block:
    """Documents of a task, with the postings ordered by term."""

    def __init__(self, tables: list[pa.RecordBatch], n_documents: int, n_terms: int) -> None:
        table = pa.Table.from_batches(tables).combine_chunks()
        self.docs = table.column("doc_id").to_numpy()
        length = table.column("n_terms").to_numpy()
        lists = table.column("terms").combine_chunks()
        terms = lists.flatten().to_numpy()
        count = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(self.docs)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(terms, kind="stable")
        self.owner, count = owner[order], count[order]
        self.terms, self.starts = np.unique(terms[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(terms))
        norm = 25 + (75 * length * n_documents) // n_terms
        self.parts = (1_000_000_000 * count) // (1000 * count + 8 * norm[self.owner])
        #: The largest contribution of each term in the block.
        self.largest = np.maximum.reduceat(self.parts, self.starts) if len(terms) else self.parts


def _blocks(batches: Iterator[pa.RecordBatch], n_documents: int, n_terms: int) -> Iterator[_Block]:
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for batch in batches:
        # batches are cut so that a block of very long documents stays small too
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            held.append(part)
            docs += len(part)
            postings += len(part.column("terms").flatten())
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield _Block(held, n_documents, n_terms)
                held, docs, postings = [], 0, 0
    if docs:
        yield _Block(held, n_documents, n_terms)


class _Top:
    """The best documents so far: higher scores first, then smaller doc_ids."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.docs = self.scores = np.empty(0, np.int64)

    def least(self) -> int:
        """What a document must score to enter; equal scores may, by their doc_id."""
        return int(self.scores[-1]) if len(self.scores) == self.most else 1

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        ready = scores >= self.least()
        docs = np.concatenate([self.docs, docs[ready]])
        scores = np.concatenate([self.scores, scores[ready]])
        order = np.lexsort((docs, -scores))[: self.most]
        self.docs, self.scores = docs[order], scores[order]


def _search(block: _Block, own: np.ndarray, weight: np.ndarray, top: _Top) -> None:
    """Scores the documents of a block that may be among the item's best."""
    places = np.minimum(np.searchsorted(block.terms, own), max(len(block.terms) - 1, 0))
    there = block.terms[places] == own if len(block.terms) else np.zeros(len(own), bool)
    places, weight = places[there], weight[there]
    most = weight * block.largest[places] if len(places) else weight
    if not len(places) or most.sum() < top.least():
        return
    runs = list(zip(block.starts[places].tolist(), block.ends[places].tolist()))
    masks, groups = _masks(runs, block.owner, len(block.docs))
    bits = np.unpackbits(masks.view(np.uint8), axis=1, count=len(runs), bitorder="little")
    highest = bits.astype(np.int64) @ most
    order = np.argsort(-highest, kind="stable")
    docs_by_group = np.argsort(groups, kind="stable")
    sizes = np.bincount(groups, minlength=len(masks))
    ends = np.cumsum(sizes)
    start, step = 0, 1
    while start < len(order):
        some = order[start : start + step]
        some = some[highest[some] >= top.least()]
        if not len(some):  # descending: none of the rest can enter
            return
        docs = np.sort(np.concatenate([docs_by_group[ends[g] - sizes[g] : ends[g]] for g in some]))
        scores = np.zeros(len(docs), np.int64)
        for (a, b), w in zip(runs, weight.tolist()):
            at = a + np.searchsorted(block.owner[a:b], docs)
            hit = at < b
            hit[hit] = block.owner[at[hit]] == docs[hit]
            scores[hit] += w * block.parts[at[hit]]
        top.add(block.docs[docs], scores)
        start, step = start + step, step * 2


def _masks(runs: list[tuple[int, int]], owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct bitmaps, as rows of 64-bit numbers, and each document's."""
    wide = np.zeros((docs, (len(runs) + 63) // 64), np.uint64)
    for bit, (a, b) in enumerate(runs):
        wide[owner[a:b], bit // 64] |= np.uint64(1 << (bit % 64))
    if wide.shape[1] == 1:
        masks, groups = np.unique(wide[:, 0], return_inverse=True)
        return np.ascontiguousarray(masks[:, None]), groups
    masks, groups = np.unique(wide, axis=0, return_inverse=True)
    return np.ascontiguousarray(masks), groups.reshape(-1)
