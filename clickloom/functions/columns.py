"""Column expressions: time parts, categories, keys, hashes and conversions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) of the price tiers; anything above is the last name.
PRICE_TIERS = (("budget", 100), ("standard", 500), ("premium", 950))
TOP_TIER = "luxury"


def wall_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, fraction dropped.

    Built from the calendar fields, so no session time zone enters.
    """
    return (
        F.unix_date(F.to_date(ts)).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def weekday(ts: Column) -> Column:
    """Day of the week with Monday = 0."""
    return F.weekday(ts)


def category_head_tail(code: Column) -> tuple[Column, Column]:
    """'a.b.c' -> ('a', 'b.c'); without a dot the second part is null."""
    parts = F.split(code, r"\.", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def category_levels(code: Column) -> tuple[Column, Column, Column]:
    """'a.b.c.d' -> ('a', 'b', 'c.d'); missing levels are null."""
    parts = F.split(code, r"\.", 3)
    return tuple(F.get(parts, F.lit(i)) for i in range(3))


def category_id(code: Column) -> Column:
    """60-bit id of a category code, the same in every run and on every node.

    Hashing needs no dictionary, hence no global sort and no lookup join.
    """
    return F.conv(F.substring(F.md5(code), 1, 15), 16, 10).cast("long")


def price_tier(
    price: Column,
    tiers: Sequence[tuple[str, float]] = PRICE_TIERS,
    top: str = TOP_TIER,
) -> Column:
    ladder = F.when(price.isNull(), None)
    for name, bound in tiers:
        ladder = ladder.when(price < bound, name)
    return ladder.otherwise(top)


def record_text(columns: Sequence[str]) -> Column:
    """One text per record that no other record can produce.

    Each value carries its length, and null is a mark no value has, so neither
    a separator inside a value nor a null can make two records look alike.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.concat_ws("|", *parts)


def record_hash(columns: Sequence[str]) -> Column:
    """64 hex characters identifying the record's content."""
    return F.sha2(record_text(columns), 256)


def record_key(columns: Sequence[str]) -> Column:
    """128-bit surrogate key. 64 bits would collide at 10^12 records."""
    return F.md5(record_text(columns))


def is_valid(required: Sequence[str]) -> Column:
    """True when every required column is present."""
    flag = F.lit(True)
    for name in required:
        flag = flag & F.col(name).isNotNull()
    return flag


def feature_key(user: Column, product: Column, session: Column) -> Column:
    """Online key; null when any part is null, so such rows can be set aside."""
    return F.concat(
        F.lit("user:"),
        user.cast("string"),
        F.lit(":product:"),
        product.cast("string"),
        F.lit(":session:"),
        session,
    )


# Texts that read as a number.
_DIGITS = r"[0-9]+(_[0-9]+)*"
_NUMBER = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_INFINITY = r"(?i)^[+]?inf(inity)?$"
_NEGATIVE_INFINITY = r"(?i)^-inf(inity)?$"
_NOT_A_NUMBER = r"(?i)^[+-]?nan$"


def number_or_zero(text: Column) -> Column:
    """Text to double; anything that is no number, or is missing, gives 0.0.

    Spark reads '1d' as a number and '1_000' as none; the wanted rule is the
    other way round, hence the patterns in front of the cast.
    """
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return (
        F.when(
            trimmed.rlike(_NUMBER),
            F.regexp_replace(trimmed, "_", "").try_cast("double"),
        )
        .when(trimmed.rlike(_INFINITY), F.lit(float("inf")))
        .when(trimmed.rlike(_NEGATIVE_INFINITY), F.lit(float("-inf")))
        .when(trimmed.rlike(_NOT_A_NUMBER), F.lit(float("nan")))
        .otherwise(F.lit(0.0))
    )


def parsed_timestamp(text: Column) -> Column:
    """Zone-less timestamp of a text, null when it is none."""
    return text.try_cast("timestamp_ntz")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
