"""Document fingerprints from closed syncmers.

The alphabet is words. Of the K-mers of a text, those count whose smallest inner
S-mer, by hash, is their first or their last. Whether a K-mer counts depends on
itself alone, so equal passages give equal anchors wherever they stand.

A fingerprint is the distinct anchors in text order. Two are matched by position: an
anchor of both has a place in either, and passages that stand in the same order
shift their places alike. The shift that most common anchors have, give or take a
sixteenth of the longer fingerprint, tells how much is alike in order; the same passages in
another order agree on no shift.

The next document is found on keys alone, which are put in order slice by slice; each
document then sends the one before it what that needs of it, the beginning of its
text and its fingerprint. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import stored

K, S = 6, 2
_INNER = K - S + 1
_SPACE = " \t\n\x0b\x0c\r"


def _bound(value: Column, body) -> Column:
    """`body` over a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _closed(text: Column, named) -> Column:
    """Array of `named(position, hash)` for each closed syncmer of a text."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>")
    )

    def of_words(h: Column) -> Column:
        inner = F.transform(
            F.sequence(F.lit(0), F.size(h) - S),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]),
        )

        def of_inner(s: Column) -> Column:
            def pick(first: Column, i: Column) -> Column:
                last = F.get(s, i + _INNER - 1)
                between = [F.get(s, i + j) for j in range(1, _INNER - 1)]
                # one comparison decides most places; beyond the end it is null
                opens, closes = first <= last, last <= first
                for other in between:
                    opens = (first <= other) & opens
                for other in reversed(between):
                    closes = (last <= other) & closes
                # S-mers side by side make up the K-mer
                whole = F.xxhash64(*[F.get(s, i + j) for j in range(0, K - S + 1, S)])
                return F.when(last.isNotNull() & (opens | closes), named(i, whole))

            return F.array_compact(F.transform(s, pick))

        short = F.array(named(F.lit(0), F.xxhash64(h)))
        return (
            F.when(F.size(h) >= K, _bound(inner, of_inner))
            .when(F.size(h) > 0, short)
            .otherwise(F.slice(short, 1, 0))
        )

    return _bound(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def anchors(text: Column) -> Column:
    """array<struct<position, hash>> of the text's closed syncmers, position in words.

    A text of fewer than K words has its whole sequence as the only anchor, one
    without words none.
    """
    return _closed(text, lambda i, h: F.struct(i.alias("position"), h.alias("hash")))


def fingerprint(text: Column) -> Column:
    """The distinct anchors in text order, each as 31 bits of its hash."""
    return F.array_distinct(_closed(text, lambda i, h: h.bitwiseAND(0x7FFFFFFF).cast("int")))


def printed(marks: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits for each anchor, under a leading one bit."""
    digits = F.transform(marks, lambda m: F.hex(m.cast("long").bitwiseOR(0x80000000)))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Twice the anchors that two fingerprints have in common under one shift, as a share
    of the anchors of both; two without anchors are alike."""
    both = F.size(a) + F.size(b)

    def placed(marks: Column, side: int) -> Column:
        return F.transform(
            marks, lambda m, i: F.struct(m.alias("mark"), F.lit(side).alias("side"), i.alias("at"))
        )

    def of_merged(merged: Column) -> Column:
        # an anchor of both stands twice, side by side
        shifts = F.zip_with(
            F.slice(merged, F.lit(1), F.size(merged) - 1),
            F.slice(merged, F.lit(2), F.size(merged) - 1),
            lambda x, y: F.when(x["mark"] == y["mark"], y["at"] - x["at"]),
        )
        width = F.greatest(F.lit(2), F.ceil(F.greatest(F.size(a), F.size(b)) / 8).cast("int"))
        half = F.floor(width / 2).cast("int")
        return _bound(
            F.struct(F.array_compact(shifts).alias("d"), width.alias("w"), half.alias("half")),
            lambda x: _bound(
                x["d"], lambda d: F.greatest(_longest(d, x["w"], F.lit(0)), _longest(d, x["w"], x["half"]))
            ),
        )

    merged = F.array_sort(F.concat(placed(a, 0), placed(b, 1)))
    common = F.when(both > 1, _bound(merged, of_merged)).otherwise(F.lit(0))
    return F.when(both == 0, F.lit(1.0)).otherwise(2 * common / both)


def _longest(shifts: Column, width: Column, offset: Column) -> Column:
    """How many shifts fall into the cell of `width` that holds most of them."""
    cells = F.array_sort(F.transform(shifts, lambda d: F.floor((d + offset) / width)))

    def of_cells(c: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(c)),
            lambda i: (i == 0) | (i == F.size(c)) | (F.get(c, i) != F.get(c, i - 1)),
        )
        return _bound(
            starts,
            lambda s: F.array_max(
                F.zip_with(
                    F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1), lambda x, y: y - x
                )
            ),
        )

    # mostly none or few are common
    return F.when(F.size(shifts) > 1, _bound(cells, of_cells)).otherwise(F.size(shifts))


# ---- the next document


def _preceded(keys: DataFrame) -> DataFrame:
    """`keys` (doc_id, text_key, n_chars), each once, with `before`, the key that comes
    before it; before the first comes the last."""
    ranges = keys.repartitionByRange("doc_id", "text_key").withColumn("slice", F.spark_partition_id())
    sliced = stored(ranges, "keys")
    own = F.struct("doc_id", "text_key", "n_chars")
    # one row for each slice
    along = Window.orderBy("slice")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = sliced.groupBy("slice").agg(F.max(own).alias("end"))
    carried = F.coalesce(F.lag("end").over(along), F.last("end").over(whole))
    ends = ends.select("slice", carried.alias("carried"))
    inside = Window.partitionBy("slice").orderBy("doc_id", "text_key")
    before = F.coalesce(F.lag(own).over(inside), "carried")
    return sliced.join(F.broadcast(ends), "slice").withColumn("before", before).drop("slice")


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    # an own name: both sides of the join then are one plan, whose shuffle Spark uses twice
    return documents.select(
        F.col("doc_id").cast("long").alias("row_id"),
        text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_key"),
    )


def with_next(documents: DataFrame) -> DataFrame:
    """doc_id, text, next_marks (the next document's fingerprint) and next_text of every
    row, the latter as far as edited() needs it: a quarter of the text's length.

    Documents come in the order of doc_id, then of a hash of the text; after the last comes the
    first, and rows alike in both have the same next. Null is the empty text. A row
    without doc_id has no place in the order: its next is the first. A single document
    is its own next.
    """
    rows = _keyed(documents)
    placed = rows.filter("row_id is not null")
    keys = placed.groupBy(F.col("row_id").alias("doc_id"), "text_key").agg(F.max(F.length("text")).alias("n_chars"))
    order = stored(_preceded(keys), "order")
    key = ["row_id", "text_key"]
    order = order.withColumnRenamed("doc_id", "row_id")
    met = placed.hint("merge").join(order.select(*key, "before"), key)
    # rows of a key lie together; one of them is sent
    sent = met.dropDuplicates(key).select(
        F.col("before.doc_id").alias("row_id"),
        F.col("before.text_key").alias("text_key"),
        F.substring("text", F.lit(1), F.floor(F.col("before.n_chars") / 4).cast("int")).alias("next_text"),
        fingerprint(F.col("text")).alias("next_marks"),
    )
    ordered = placed.hint("merge").join(sent.hint("merge"), key)

    loose = rows.filter("row_id is null")
    least = order.agg(F.min(F.struct(*key)).alias("least")).first().least
    if least is None:
        first = loose.sparkSession.createDataFrame([("",)], "first_text string")
    else:
        same = (F.col("row_id") == F.lit(least.row_id)) & (F.col("text_key") == F.lit(bytes(least.text_key)))
        first = placed.filter(same).limit(1).select(F.col("text").alias("first_text"))
    # bounded: the one first row
    loose = loose.join(F.broadcast(first)).select(
        "row_id",
        "text",
        F.substring("first_text", F.lit(1), F.floor(F.length("text") / 4).cast("int")).alias("next_text"),
        fingerprint(F.col("first_text")).alias("next_marks"),
    )
    both = ordered.select("row_id", "text", "next_text", "next_marks").unionByName(loose)
    return both.withColumnRenamed("row_id", "doc_id")


def edited(text: Column, other: Column) -> Column:
    """The text with its last quarter replaced by the beginning of another."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(other, F.lit(1), cut))


def compared(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness. The
    order and what else holds for odd rows, see with_next()."""
    rows = with_next(documents).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumns(
        {"marks": fingerprint(F.col("text")), "edited_marks": fingerprint(F.col("edited_text"))}
    )
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("marks")).alias("fingerprint"),
        printed(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
