"""Fixity audit of WARC replicas by Merkle trees.

A record's hash covers its bytes. Records are gathered, in order of their offset,
into ranges of RANGE bytes of their archive; a range's hash covers its records'
offsets, lengths and hashes. FAN neighbouring ranges make a node of the next level,
up to the root, which spans all archives. Two replicas are compared from the root
down, and only nodes below a difference are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import stored

ARCHIVE_RECORDS = 1000
RANGE = 1 << 16
FAN_BITS = 3


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """The WARC record of a page; missing parts are empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def archived(pages: DataFrame, held: Column | None = None) -> DataFrame:
    """archive, record_offset, record_length, page_id and digest of the record of
    every row of `pages`.

    Each archive has the pages of ARCHIVE_RECORDS consecutive ids, in order of id,
    then content; pages without id are dealt by their content over as many archives
    with negative numbers. Repeated rows are records of their own. `held` is the
    html that a replica really holds at the place of the right one, if not that.
    """
    html = F.col("html")
    record = record_text(F.col("page_id"), F.col("url"), html)
    content = F.xxhash64("url", "html")
    loose = -1 - F.pmod(content, F.lit(ARCHIVE_RECORDS))
    bytes_held = record_text(F.col("page_id"), F.col("url"), html if held is None else held)
    rows = pages.select(
        F.coalesce(F.expr(f"page_id div {ARCHIVE_RECORDS}"), loose).cast("long").alias("archive"),
        "page_id",
        content.alias("content"),
        F.octet_length(record).cast("long").alias("record_length"),
        F.sha2(bytes_held.cast("binary"), 256).alias("digest"),
    )
    along = Window.partitionBy("archive").orderBy("page_id", "record_length", "content")
    before = F.sum("record_length").over(along.rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(before, F.lit(0)).cast("long")
    return rows.withColumn("record_offset", offset).drop("content")


def numbered(records: DataFrame, bits: int) -> DataFrame:
    """Records with the number of their range among all archives' ranges."""
    own = F.shiftleft("archive", bits) + F.floor(F.col("record_offset") / RANGE)
    return records.withColumn("range_no", own.cast("long"))


def tree(records: DataFrame, levels: int) -> DataFrame:
    """level, number and hash of every node; the records carry range_no."""
    one = F.concat_ws(":", "record_offset", "record_length", "digest")
    node = records.groupBy(F.col("range_no").alias("number")).agg(
        _digest(F.array_sort(F.collect_list(F.struct("record_offset", one.alias("line"))))).alias("hash")
    )
    nodes = leaves = stored(node.select(F.lit(0).alias("level"), "number", "hash"), "ranges")
    for level in range(1, levels):
        line = F.concat_ws(":", "number", "hash").alias("line")
        leaves = stored(
            leaves.groupBy(F.shiftright("number", FAN_BITS).alias("parent"))
            .agg(_digest(F.array_sort(F.collect_list(F.struct("number", line)))).alias("hash"))
            .select(F.lit(level).alias("level"), F.col("parent").alias("number"), "hash"),
            "nodes",
        )
        nodes = nodes.unionByName(leaves)
    return nodes


def _digest(lines: Column) -> Column:
    text = F.array_join(F.transform(lines, lambda s: s["line"]), "\n")
    return F.sha2(text.cast("binary"), 256)


def audit(one: DataFrame, other: DataFrame) -> DataFrame:
    """archive, record_offset, range_no, page_id, status, digest and found_digest of
    each record on which two replicas differ.

    `one` is the master: a record only it has is `missing`, one only `other` has is
    `extra`, a record of other bytes at the same offset is `altered`. Records that
    stand at one offset more than once (a broken index) are compared as pairs. Equal
    or empty replicas give no rows.
    """
    # written first: records are placed and hashed once
    columns = ["archive", "record_offset", "record_length", "page_id", "digest"]
    one, other = (stored(r.select(columns), "records") for r in (one, other))
    most, low, high = (
        one.unionByName(other).agg(F.max("record_offset"), F.min("archive"), F.max("archive")).first()
    )
    bits = FAN_BITS
    while (most or 0) // RANGE >= 1 << bits:
        bits += FAN_BITS
    levels, lowest, highest = 1, (low or 0) << bits, ((high or 0) + 1) << bits
    while lowest >> (FAN_BITS * (levels - 1)) != highest >> (FAN_BITS * (levels - 1)):
        if levels * FAN_BITS > 63:
            break  # numbers on both sides of zero meet nowhere: two roots
        levels += 1
    one, other = (numbered(r, bits) for r in (one, other))
    trees = tree(one, levels), tree(other, levels)
    different = None
    for level in range(levels - 1, -1, -1):
        sides = [t.filter(F.col("level") == level).select("number", "hash") for t in trees]
        if different is not None:
            parent = F.shiftright("number", FAN_BITS) == F.col("parent")
            sides = [s.join(different, parent, "left_semi") for s in sides]
        met = sides[0].join(sides[1].withColumnRenamed("hash", "found"), "number", "full")
        different = stored(
            met.filter(~F.col("hash").eqNullSafe(F.col("found"))).select(F.col("number").alias("parent")),
            "different",
        )
    left, right = (
        r.join(different, F.col("range_no") == F.col("parent"), "left_semi") for r in (one, other)
    )
    key = ["archive", "record_offset", "range_no"]
    found = right.select(
        *key,
        F.col("page_id").alias("found_id"),
        F.col("record_length").alias("found_length"),
        F.col("digest").alias("found_digest"),
    )
    met = left.join(found, key, "full")
    same = F.col("digest").eqNullSafe(F.col("found_digest")) & F.col("record_length").eqNullSafe(
        F.col("found_length")
    )
    status = (
        F.when(F.col("found_digest").isNull(), "missing")
        .when(F.col("digest").isNull(), "extra")
        .otherwise("altered")
    )
    return met.filter(~same).select(
        *key,
        F.coalesce("page_id", "found_id").alias("page_id"),
        status.alias("status"),
        "digest",
        "found_digest",
    )
