"""Secrets in texts, judged by how many owners a value has across the corpus.

Candidates are found with regular expressions in every text. Each candidate's value
is hashed, and the hashes are counted over distinct repositories and owners of the
whole corpus. A value that more than OWNERS owners have, or that lies in more than
REPOSITORIES repositories, whoever owns them, is a widely copied example; any other is
live-looking. The base kinds are reported either way; values of the wider kind
`owned` only while they look live. Values themselves are stored nowhere.

All of it is DataFrame functions. Positions come from the lengths of the pieces
between matches and of the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.skew import shuffled_apart
from clickloom.session import stored

#: Fixed patterns of the base kinds, in their order; failing matches are dropped
#: after matching, so that they still take their characters.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: Long tokens with letters and digits, however they are introduced.
OWNED = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
)
#: What a text must hold for a kind to be looked for: the pattern with its least length.
NEEDED = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
    "owned": OWNED,
}
KINDS = ("assign", "access", "hex", "owned")
#: A value of more owners, or in more repositories, than this is a widely copied example.
OWNERS, REPOSITORIES = 2, 10
MASK = "[secret]"


def _spans(text: Column, kind: str) -> Column:
    """array<struct<start, kind_no, end, value>> in code points, end exclusive."""
    # runs of hex digits and access keys are maximal: a match of the least length
    # begins where the run's match begins, so shorter ones need not be matched
    pattern = {
        "assign": ASSIGN,
        "access": r"AKIA[A-Z0-9]{12,}",
        "hex": r"[0-9a-f]{32,}",
        "owned": OWNED,
    }[kind]
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found
    steps = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m)
    )
    ends = F.aggregate(
        steps,
        F.array(F.lit(0)),
        lambda so_far, step: F.concat(so_far, F.array(F.element_at(so_far, -1) + step)),
    )
    spans = F.zip_with(
        F.arrays_zip(F.slice(ends, F.lit(2), F.size(found)).alias("end"), found.alias("match")),
        values,
        lambda s, v: F.struct(
            (s["end"] - F.length(s["match"])).alias("start"),
            F.lit(KINDS.index(kind)).alias("kind_no"),
            s["end"].alias("end"),
            v.alias("value"),
        ),
    )
    if kind == "assign":
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= LEAST[kind])
    return F.when(text.rlike(NEEDED[kind]), spans).otherwise(
        F.array().cast("array<struct<start:int,kind_no:int,end:int,value:string>>")
    )


def candidates(text: Column) -> Column:
    """All spans of a text; of the kind `owned` those that touch no base span."""
    base = F.concat(*[_spans(text, k) for k in KINDS[:3]])

    def apart(span: Column, others: Column) -> Column:
        return ~F.exists(others, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    both = F.transform(
        F.array(F.struct(base.alias("base"), _spans(text, "owned").alias("more"))),
        lambda s: F.concat(s["base"], F.filter(s["more"], lambda m: apart(m, s["base"]))),
    )
    return F.element_at(both, 1)


def ownership(found: DataFrame) -> DataFrame:
    """value_key, n_owners and n_repositories of (value_key, owner, repository)."""
    return (
        found.groupBy("value_key", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("value_key", "owner")
        .agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("value_key")
        .agg(
            F.count(F.lit(1)).alias("n_owners"),
            F.sum("repositories").alias("n_repositories"),
        )
    )


def judged(documents: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """row_key, doc_id and spans: one row for each row of `documents`, with an array of
    (start, kind_no, end, n_owners, n_repositories, live).

    `owner` and `repository` are expressions over the documents; a repository belongs
    to an owner, and null is an owner or repository of its own. A null or empty text
    has no spans. Rows that repeat a doc_id are judged each; a value in them counts
    for its owner and repository once.
    """
    rows = _found(documents, owner, repository, F.col("doc_id"))
    return rows.join(_verdicts(rows), "row_key", "left").select(
        "row_key", "doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")
    )


_SPANS = "array<struct<start:int,kind_no:int,end:int,n_owners:bigint,n_repositories:bigint,live:boolean>>"


def _found(documents: DataFrame, owner: Column, repository: Column, *columns: Column) -> DataFrame:
    """`columns` of the documents, owner, repository, row_key and `found`, the spans with
    hashes of their values. Written once: texts are searched once, and keys are settled."""
    found = F.transform(
        candidates(F.coalesce("text", F.lit(""))),
        lambda s: F.struct(s["start"], s["kind_no"], s["end"], F.sha2(s["value"], 256).alias("value_key")),
    )
    rows = documents.select(
        *columns,
        owner.cast("string").alias("found_owner"),
        repository.cast("string").alias("found_repository"),
        found.alias("found"),
        F.monotonically_increasing_id().alias("row_key"),
    )
    return stored(rows, "candidates")


def _verdicts(rows: DataFrame) -> DataFrame:
    """(row_key, spans) of the rows with any span."""
    each = rows.select(
        "row_key",
        F.col("found_owner").alias("owner"),
        F.col("found_repository").alias("repository"),
        F.inline("found"),
    )
    counted = ownership(each.select("value_key", "owner", "repository"))
    live = (F.col("n_owners") <= OWNERS) & (F.col("n_repositories") <= REPOSITORIES)
    span = F.struct("start", "kind_no", "end", "n_owners", "n_repositories", live.alias("live"))
    return (
        each.drop("owner", "repository")
        .join(shuffled_apart(counted), "value_key")
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_list(span)).alias("spans"))
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"], s["end"]),
        ),
        ",",
    )


def reported(judgement: DataFrame) -> DataFrame:
    """Counts and spans of each row of judged(): base kinds all, others if live."""
    base = F.filter("spans", lambda s: s["kind_no"] < 3)
    shown = F.filter("spans", lambda s: (s["kind_no"] < 3) | s["live"])

    def of_kind(no: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind_no"] == no)).cast("long")

    return judgement.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(shown).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_widespread"),
        F.array_max(F.transform("spans", lambda s: s["n_owners"])).alias("most_owners"),
        F.array_max(F.transform("spans", lambda s: s["n_repositories"])).alias("most_repositories"),
    )


def masked(documents: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """`documents` with every live-looking span replaced by MASK, and n_chars, if
    there is one, set to the new length. Widely copied examples stay. Every row is
    returned, as it is if it has no live span; only texts with a span pass through a join."""
    rows = _found(documents, owner, repository, F.struct("*").alias("row"))
    live = _verdicts(rows).select("row_key", F.filter("spans", lambda s: s["live"]).alias("live"))
    met = rows.filter("size(found) > 0").join(live, "row_key")
    text, some = F.col("row.text"), F.size("live") > 0
    changed = F.when(some, _masked(text, F.col("live"))).otherwise(text)
    columns = {c: F.col("row").getField(c) for c in documents.columns} | {"text": changed}
    if "n_chars" in columns:
        length = F.length(changed).cast(documents.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(some, length).otherwise(columns["n_chars"])
    clean = rows.filter("size(found) = 0").select("row.*")
    return clean.unionByName(met.select(*[value.alias(c) for c, value in columns.items()]))


def _masked(text: Column, spans: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(before, F.lit(MASK))))
            .otherwise(state["out"])
            .alias("out"),
        )

    return F.aggregate(
        spans,
        start,
        step,
        lambda state: F.concat(
            F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))
        ),
    )
