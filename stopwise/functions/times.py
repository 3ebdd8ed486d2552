"""Timetable and calendar arithmetic on integer seconds.

Functions take the SQL of their argument, usually a column name.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..settings import DAY_S


def service_seconds(text: str) -> Column:
    """``H:M:S`` to seconds since service midnight; the hour may pass 23. Malformed gives null.

    The text occurs once in the expression: where it is made from other columns, several copies of that
    make a method too long to be compiled.
    """
    parts = f"transform(split(trim({text}), ':'), x -> try_cast(x AS int))"
    return F.expr(f"""transform(array({parts}), p -> CASE WHEN size(p) = 3 AND get(p, 0) >= 0
        AND get(p, 1) BETWEEN 0 AND 59 AND get(p, 2) BETWEEN 0 AND 59
        THEN get(p, 0) * 3600 + get(p, 1) * 60 + get(p, 2) END)[0]""")


def two_digits(number: str) -> str:
    """SQL of a whole number as text of two digits or more, as ``%02d`` writes it."""
    return (f"CASE WHEN {number} BETWEEN 0 AND 9 THEN concat('0', CAST({number} AS string)) "
            f"ELSE coalesce(CAST({number} AS string), 'null') END")


def same_day_seconds(service_s: str) -> Column:
    """Seconds after the midnight of the ping's own day: hours past 23 fall on the next day."""
    return F.expr(f"if({service_s} >= {DAY_S}, {DAY_S} + {service_s} % {DAY_S}, {service_s})")


def clock_text(seconds: str) -> Column:
    """Seconds since some midnight as ``HH:MM:SS`` on a 24 hour clock."""
    s = f"pmod(CAST({seconds} AS int), {DAY_S})"
    parts = (f"{s} DIV 3600", f"{s} DIV 60 % 60", f"{s} % 60")
    return F.expr(f"""CASE WHEN {seconds} IS NOT NULL
        THEN concat_ws(':', {', '.join(two_digits(p) for p in parts)}) END""")


def parse_feed_time(text: str) -> Column:
    """Feed time ``yyyy-MM-dd HH:mm:ss``; anything else gives null."""
    return F.expr(f"try_to_timestamp({text}, 'yyyy-MM-dd HH:mm:ss')")


def second_of_day_sql(epoch_s: str) -> str:
    return f"pmod({epoch_s}, {DAY_S})"


def day_start_sql(epoch_s: str) -> str:
    return f"(floor({epoch_s} / {DAY_S}) * {DAY_S})"


def calendar_features(ts: str) -> dict[str, Column]:
    """Hour, minute, weekday (Sunday is -1) and minute of the day."""
    return {
        "hour": F.expr(f"hour({ts})"),
        "minute": F.expr(f"minute({ts})"),
        "weekday": F.expr(f"dayofweek({ts}) - 2"),
        "time_of_day": F.expr(f"hour({ts}) * 60 + minute({ts})"),
    }
