"""Words and word hashes of whole texts, for the operators that work in numpy.

A word is a run of bytes other than space and \\x09-\\x0D, which is what
`bytes.split()` cuts at. Hashes are fixed functions of the bytes, alike on every
executor and in every run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at once in a task, and words whose hash is remembered there.
SLICE_BYTES = 1 << 20
REMEMBERED = 200_000

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each `width` consecutive values; fewer values give none.

    A rolling polynomial over the ring of 64-bit integers, then mixed.
    """
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    powers = np.full(n, _ODD, np.uint64)
    powers[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(powers), out=sums[1:])
    back = np.full(n - width + 1, _INVERSE, np.uint64)
    back[0] = 1
    return mixed((sums[width:] - sums[: n - width + 1]) * np.cumprod(back))


#: Rows that Spark hands to Python at once: batches lie outside the heap, twice.
BATCH_ROWS = 1000


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """`df.mapInArrow` in batches of BATCH_ROWS."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of about SLICE_BYTES of text, each with its texts; a text
    longer than that is a part of its own. Null is the empty text."""
    texts = batch.column(column).to_pylist()
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_BYTES or i == len(texts) - 1:
            yield batch.slice(start, i + 1 - start), [t or "" for t in texts[start : i + 1]]
            start, size = i + 1, 0


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def word_count(text):
    """Words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Beyond this Catalyst's size says only that it is not known.
UNKNOWN_BYTES = 1 << 55


def parts_for(df: DataFrame, bytes_each: int) -> int:
    """How many parts of about `bytes_each` the input makes, by Catalyst's size of
    the frame, and no fewer than the session's shuffle partitions. These alone count
    for a frame of unknown size, such as one made from an RDD."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size >= UNKNOWN_BYTES:
        return usual
    return max(usual, size // bytes_each + 1)
