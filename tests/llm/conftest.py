import random

import pytest
from pyspark.sql import functions as F

from clickloom.session import ship_code

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside, as columns of the input.
CLASHING = (
    "keys starts kept slice signature component_id class_id hub place part rest score "
    "lang_pred ids n_words spans row_key text_key live_spans quality sample_place next hashes"
).split()


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_code(spark)


@pytest.fixture(scope="session")
def texts(spark):
    """Texts of the smallest table by doc_id."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and
    columns whose names clash with the operators' own."""
    draw = random.Random(5)
    words = ["alpha", "bêta", "Gamma", "delta.", "the", "of", "| x", "42", "###"]

    def text(n):
        return " ".join(draw.choice(words) + str(draw.randint(0, 99)) for _ in range(n))

    long, passage = text(30_000), text(70)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "src1", 0),
        (3, " \t\n\x0b\x0c\r ", "en", "src1", 7),
        (4, "one", "en", "src1", 3),
        (5, long, "en", "src7", None),
        (6, long, "fr", None, 10),
        (7, passage, "en", "src7", 9),
        (8, f"{text(40)} {passage}\n{passage} {text(5)}", None, "src19", 9),
        (9, f"{passage}", "de", "src2", 9),
        (9, f"{passage}", "de", "src2", 9),
        (None, passage, "en", "src3", 9),
        (None, None, None, None, None),
        (10, "Ünïcode 🙂 texte  with odd spaces\n\n\nand lines\n\nand lines", "en", "x", 1),
        (11, "###\n!!!\n|||\n...", "en", "src9", 1),
    ]
    frame = spark.createDataFrame(rows, DOCUMENT)
    return frame.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)
