import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickloom.llm import bpe
from clickloom.llm.queries import QUERIES

from .conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_query_equals_the_library(spark, texts, library):
    for r in QUERIES["op8_forced_boundary_bpe"](spark, SF).collect():
        ids = ids_of(library, texts[r.doc_id])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_random_texts(library):
    encoder, draw = bpe.Encoder(PATH), random.Random(1)
    letters = "abcthe éñßÉÇΣΑσς 0129'’sS\n\t\x85\xa0 ​\x1c\x00ſKİ가힣漢字🙂́̈'ll'Re$%٣՘࢏|!<>"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        if draw.random() < 0.1:
            text += draw.choice(["<|endoftext|>", "<|startoftext|>x", "<|end"]) + text
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(library, text), repr(text)


def test_long_words(library):
    encoder = bpe.Encoder(PATH)
    for text in ("ab" * 5000, "é" * 3000, "hello" * 2000 + "$" * 999, "the" * 67):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(library, text)


def test_no_token_reaches_over_a_cut():
    encoder = bpe.Encoder(PATH)
    word = "".join(encoder.bytewise[b] for b in "qzxqjvstringxq中文ñandü".encode())
    pieces = encoder.cuts(word)
    assert "".join(pieces) == word and len(pieces) > 1
    for left, right in zip(pieces, pieces[1:]):
        pair = left[-1] + right[0]
        assert not any(pair in token for token in encoder.ids)


def test_odd_rows(odd, empty, library):
    given = sorted(ids_of(library, r.text) for r in odd.select("text").collect())
    encoded = bpe.encode(odd, PATH)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in encoded.collect()) == given
    decoded = sorted(r.text for r in bpe.decode(encoded, PATH).collect())
    assert decoded == sorted(library.decode(i, skip_special_tokens=False) for i in given)
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
