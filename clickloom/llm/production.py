"""Parameters of the queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Replica of the fixity audit: of each DAMAGE consecutive pages, one is altered, one
#: lost and one written a second time behind its archive.
DAMAGE, ALTERED, LOST, TWICE = 97, 5, 6, 7

#: Domains of the sources' numbers, five each, and the target weights.
DOMAINS = ("web", "books", "code", "forum")
WEIGHTS = {
    "domain": {"web": 4, "books": 3, "code": 2, "forum": 1},
    "lang": {"en": 5, "de": 2, "fr": 2},
}
#: The root's budget, per cent of all tokens.
PERCENT = 60

#: Hard negatives: every ANCHORS-th row is an anchor, every RELABELLED-th has the next label.
ANCHORS, RELABELLED, LABELS = 100, 7, 10


def owner_and_repository() -> tuple[Column, Column]:
    """Of documents: the source owns one repository for each language."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


def domain_of_source() -> Column:
    digits = F.regexp_extract("source", "^src([0-9]{1,6})$", 1)
    names = F.array(*[F.lit(d) for d in DOMAINS])
    return F.get(names, F.floor(F.when(digits != "", digits.cast("int")) / 5).cast("int"))
