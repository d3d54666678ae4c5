"""Sessions from gaps in event time, and per-session counts.

Ordering every event of a user in one window would put a user holding a third
of all rows into one task. Instead time is cut into slots as wide as the gap:
two events in one slot are never a gap apart, so a break can only lie between
a user's non-empty slots, and their first and last times decide it. Only the
slots are ordered, and a user has at most (time span / gap) of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import wall_seconds
from clickloom.operators.skew import shuffled_apart

SESSION_GAP_SECONDS = 6 * 3600


def session_slots(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """(user, slot) -> session number and session totals."""
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    slots = (
        events.where(F.col(ts).isNotNull() & F.col(user).isNotNull())
        .groupBy(user, _slot(ts, gap_seconds).alias("slot"))
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count(F.lit(1)).alias("slot_events"),
        )
    )
    in_order = Window.partitionBy(user).orderBy("slot")
    opens = F.col("first_ts") > F.lag("last_ts").over(in_order) + gap
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_session = Window.partitionBy(user, "session_no")
    return (
        slots.withColumn("opens", F.coalesce(opens.cast("long"), F.lit(0)))
        .withColumn("session_no", F.sum("opens").over(so_far))
        .select(
            user,
            "slot",
            "session_no",
            F.sum("slot_events").over(in_session).alias("events_in_session"),
        )
    )


def sessionize(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Adds `user_session` ('user-n') and `events_in_session` to each event.

    The slot table carries both, so the events are joined once, on (user, slot);
    a user's rows spread over their slots. Events without user or time stay,
    with a null session.
    """
    slots = session_slots(events, user, ts, gap_seconds)
    return (
        events.withColumn("slot", _slot(ts, gap_seconds))
        .join(slots, [user, "slot"], "left")
        .withColumn(
            "user_session",
            F.concat(F.col(user).cast("string"), F.lit("-"), F.col("session_no").cast("string")),
        )
        .drop("slot", "session_no")
    )


def with_session_counts(events: DataFrame, session: str = "user_session") -> DataFrame:
    """`events_in_session` for events that already carry a session.

    Counting first combines on the map side, and a join, unlike a window, can
    be split where a session holds much of the table.
    """
    counts = (
        events.where(F.col(session).isNotNull())
        .groupBy(session)
        .agg(F.count(F.lit(1)).alias("events_in_session"))
    )
    return events.join(shuffled_apart(counts), session, "left")


def _slot(ts: str, gap_seconds: int):
    return F.floor(wall_seconds(F.col(ts)) / F.lit(gap_seconds))
