"""Mixing sources to target weights by budgets handed down a tree.

The tree is domain, language, source. A node's budget goes to its children in
proportion to their weights, none above what its leaves can give in MOST_EPOCHS
passes; what a child can't take goes to its siblings. Only what no child of a node
can take stays with the node's own siblings, since the node's limit is the sum of
its leaves'. A leaf's budget is as many whole passes over its documents as fit, and
for the rest a prefix, in tokens, of one more pass in an order drawn from the seed and
the number of the pass. A token is a word here.

Budgets are worked out on one row per leaf. The prefix is found by narrowing: the
order is a hash, whose first byte and second byte choose a part of the leaf each,
and only the part in which the prefix ends is put in order, so no task holds a leaf.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.words import word_count
from clickloom.session import stored

LEVELS = ("domain", "lang", "source")
MOST_EPOCHS = 4
SEED = 20
#: Names of missing parts of a path.
NONE = "?"


def leaf_rows(documents: DataFrame, domain: Column, epochs_seed: int = SEED) -> DataFrame:
    """doc_id, the path and the tokens of every document, without the text; text_key
    tells rows without doc_id apart."""
    path = [
        F.coalesce(value.cast("string"), F.lit(NONE)).alias(name)
        for name, value in zip(LEVELS, (domain, F.col("lang"), F.col("source")))
    ]
    key = _text_key(F.col("doc_id"), F.col("text")).alias("text_key")
    return documents.select("doc_id", *path, word_count(F.col("text")).alias("n_tokens"), key)


def _text_key(doc_id: Column, text: Column) -> Column:
    return F.when(doc_id.isNull(), F.md5(text.cast("binary")))


def weight_of(level: str, weights: Mapping[str, int]) -> Column:
    """Whole numbers from 1; names that `weights` lacks have 1."""
    value = F.lit(1)
    for name, weight in weights.items():
        value = F.when(F.col(level) == name, weight).otherwise(value)
    return value.cast("long")


def handed_down(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """`nodes` (parent, name, weight, capacity, budget of the parent) with `given`.

    Children are put in order of capacity by weight; as long as one's capacity is
    below its share of what is left, it gets its capacity, the others share the rest.
    Fractions of a token are not given.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    along = by.orderBy(F.col("capacity") / F.col("weight"), name)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = along.rowsBetween(0, Window.unboundedFollowing)
    earlier = F.coalesce(F.sum("capacity").over(before), F.lit(0))
    full = F.col("capacity") * F.sum("weight").over(after) <= (F.col("budget") - earlier) * F.col("weight")
    marked = nodes.withColumn("full", full)
    # full ones come first; a later one can't be full once an earlier is not
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("full", F.min("full").over(upto))
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    return (
        marked.withColumn("taken", taken)
        .withColumn("open_weight", open_weight)
        .withColumn(
            "given",
            F.when(F.col("full"), F.col("capacity")).otherwise(
                F.expr("(budget - taken) * weight div open_weight")
            ),
        )
        .drop("full", "taken", "open_weight", "budget")
    )


def leaf_budgets(
    rows: DataFrame, percent: int, weights: Mapping[str, Mapping[str, int]], epochs: int = MOST_EPOCHS
) -> DataFrame:
    """The path, tokens and budget of each leaf; the root's budget is `percent` of all
    tokens. A leaf without tokens gets none."""
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = stored(leaves.withColumn("capacity", F.col("tokens") * epochs), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = None
    for depth, name in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight_of(name, weights.get(name, {})))
        if budgets is None:
            nodes = nodes.withColumn("budget", F.lit(total * percent // 100).cast("long"))
        else:
            nodes = nodes.join(budgets, path[:-1])
        budgets = handed_down(nodes, path[:-1], name).select(*path, F.col("given").alias("budget"))
    return leaves.select(*LEVELS, "tokens").join(budgets, list(LEVELS))


def mixed(
    documents: DataFrame,
    domain: Column,
    percent: int,
    weights: Mapping[str, Mapping[str, int]],
    epochs: int = MOST_EPOCHS,
    seed: int = SEED,
    keyed: bool = False,
) -> DataFrame:
    """doc_id, the path, n_tokens, full_epochs, partial_tokens and selected_tokens of
    every row of `documents`.

    A document whose tokens lie across the end of the prefix gives the part before
    it. Missing languages and sources are a node named `?`. A null or empty text has no
    tokens. Rows that repeat a doc_id are documents of their own, and rows alike in
    all columns stand in any order. An empty table gives no rows. With `keyed`, the
    column text_key follows, a hash of the text of rows without doc_id.
    """
    rows = stored(leaf_rows(documents, domain), "tokens")
    # written, so that Catalyst knows the size: few leaves are broadcast, and documents are
    # then not shuffled by a leaf that may hold a third of them; for many, AQE splits it
    budgets = stored(
        leaf_budgets(rows, percent, weights, epochs).select(
            *LEVELS,
            F.expr("if(tokens > 0, budget div tokens, 0)").alias("full_epochs"),
            F.expr("if(tokens > 0, budget % tokens, 0)").alias("rest"),
        ),
        "budgets",
    )
    turn = F.concat_ws(":", F.lit(str(seed)), "full_epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = stored(
        rows.join(budgets, list(LEVELS)).withColumn("place", F.md5(turn.cast("binary"))),
        "drawn",
    )
    path = list(LEVELS)
    state = drawn.withColumn("part", F.lit(""))
    for depth in (1, 2):
        # state: rows of the part in which the prefix ends, `rest` of it still to take
        inner = state.withColumn("part", F.substring("place", 1, 2 * depth))
        ends = _end(inner.groupBy(*path, "part").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest")))
        joined = inner.drop("rest").join(stored(ends, "ends"), path, "left")
        settled = joined.filter("end is null or part <> end").withColumn(
            "partial_tokens", F.when(F.col("part") < F.col("end"), F.col("n_tokens")).otherwise(F.lit(0))
        )
        out = settled if depth == 1 else out.unionByName(settled, allowMissingColumns=True)
        state = stored(joined.filter("part = end").drop("end"), "ending")
    # rows that share two bytes of a hash with the prefix's end
    along = Window.partitionBy(*path).orderBy("place", "doc_id", "n_tokens")
    earlier = F.coalesce(
        F.sum("n_tokens").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    last = state.withColumn(
        "partial_tokens",
        F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - earlier)),
    )
    columns = ["doc_id", *path, "n_tokens", "full_epochs", "partial_tokens"]
    both = out.select(*columns, "text_key").unionByName(last.select(*columns, "text_key"))
    taken = F.col("full_epochs") * F.col("n_tokens") + F.col("partial_tokens")
    more = ["text_key"] if keyed else []
    return both.select(*columns, taken.alias("selected_tokens"), *more)


def _end(parts: DataFrame) -> DataFrame:
    """The part of each leaf in which its prefix ends, and what is to take of it; at
    most 256 parts of a leaf are put in order."""
    along = Window.partitionBy(*LEVELS).orderBy("part")
    upto = F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0))
    return (
        parts.withColumn("upto", upto)
        .filter("rest > 0 and upto >= rest and upto - n < rest")
        .select(*LEVELS, F.col("part").alias("end"), F.expr("rest - (upto - n)").alias("rest"))
    )


def selected(documents: DataFrame, mixture: DataFrame) -> DataFrame:
    """The documents of which mixed(), with `keyed`, takes any token, each once, all
    columns. Rows that repeat a doc_id stay or go together, and so do rows without
    doc_id of one text."""
    drawn = mixture.filter("selected_tokens > 0").select("doc_id", "text_key").distinct()
    kept = drawn.toDF("drawn_doc", "drawn_text").hint("merge")
    doc_id, text = documents["doc_id"], documents["text"]
    same = doc_id.eqNullSafe(kept["drawn_doc"]) & _text_key(doc_id, text).eqNullSafe(kept["drawn_text"])
    return documents.join(kept, same, "left_semi").select(documents.columns)
