"""Byte-pair encoding by forced boundaries, and decoding.

The byte pairs inside the vocabulary's tokens are gathered once. Where two
neighbouring bytes of a word form no such pair, no merge can ever reach across, so
the word is cut there, the fragments are encoded independently, and their ids are
joined. Words recur, so their ids are remembered, up to a bound.

The vocabulary is a `tokenizers` file with a BPE model over byte-level characters.
Its normalizer and word splitter are followed with `unicodedata` and `regex` for
the scripts on which all Unicode versions agree; a text with any other character
goes through the file's own normalizer and splitter.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from clickloom.llm.words import mapped, slices

#: Latin, Greek, Cyrillic, and common punctuation and currency signs.
_SETTLED = regex.compile("[\x00-ӿ‐-‧‰-⁞₠-₿]*")


#: Words whose ids a process remembers.
REMEMBERED = 400_000


def byte_characters() -> dict[int, str]:
    """Byte-level form: printable bytes stand for themselves, the others, in order,
    for the characters from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.library = Tokenizer.from_str(json.dumps(content))
        model = content["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.merges: dict[tuple[str, str], tuple[int, str]] = {
            (a, b): (rank, a + b) for rank, (a, b) in enumerate(model["merges"])
        }
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        bodies = (t.removesuffix(self.suffix) for t in self.ids)
        self.inner_pairs = {t[i : i + 2] for t in bodies for i in range(len(t) - 1)}
        self.bytewise = byte_characters()
        splitter = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(splitter)
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out = []
        for part in self.marks.split(text) if self.special else [text]:
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                out += self._part(part)
        return b"".join(out)

    def _part(self, text: str) -> list[bytes]:
        if _SETTLED.fullmatch(text):
            # the library lowers characters one by one, without a final sigma
            plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            known, out = self.known, []
            for word in self.words.findall(plain):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = self._word(
                        "".join(map(self.bytewise.__getitem__, word.encode()))
                    )
                out.append(ids)
            return out
        plain = self.library.normalizer.normalize_str(text)
        return [self._word(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def cuts(self, word: str) -> list[str]:
        """Fragments of a word in byte-level characters."""
        pairs, start, out = self.inner_pairs, 0, []
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in pairs:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def _word(self, word: str) -> bytes:
        *heads, tail = self.cuts(word)
        ids: list[int] = []
        for head in heads:
            ids += self._merged(head, False)
        ids += self._merged(tail, True)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merged(self, fragment: str, last: bool) -> list[int]:
        symbols = list(fragment)
        if last:
            symbols[-1] += self.suffix
        if len(symbols) > 200:
            return self._merged_long(symbols)
        rank, none = self.merges.get, (len(self.ids), "")
        found = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            at = found.index(best)
            symbols[at : at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = rank((symbols[at - 1], symbols[at]), none)
            if at < len(found):
                found[at] = rank((symbols[at], symbols[at + 1]), none)
        return [self.ids[s] for s in symbols]

    def _merged_long(self, symbols: list[str]) -> list[int]:
        """The same order of merges from a heap, for fragments of any length."""
        import heapq

        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        here: list[str | None] = list(symbols)
        heap: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(here):
                pair = here[i], here[after[i]]
                found = self.merges.get(pair)
                if found is not None:
                    heapq.heappush(heap, (found[0], i, *pair))

        for i in range(len(here) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if here[i] != a or j >= len(here) or here[j] != b:
                continue
            here[i], here[j] = a + b, None
            after[i] = after[j]
            if after[i] < len(here):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [self.ids[s] for s in here if s is not None]

    def decode(self, ids: bytes) -> str:
        """As the library for a file without a decoder: tokens joined by a space."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process and file."""
    return Encoder(path)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every row.

    Special tokens' strings in a text give their ids; none is added. Null and empty
    texts have no ids. Rows are independent, so ties, repeated and missing doc_ids
    need no rule; other columns are not used. `path` must be readable on every
    executor, like the installed package it belongs to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for part, texts in slices(batch):
                ids = pa.array([own.encode(t) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    rows = documents.select("doc_id", "text")
    return mapped(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The frame of encode() with the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = batch.column("ids")
            step = max(1, batch.num_rows * (1 << 20) // (ids.nbytes + 1))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                texts = [own.decode(b) for b in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"]
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return mapped(encoded, run, f"doc_id {kind}, ids binary, text string")
