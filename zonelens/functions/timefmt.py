"""Time helpers: epoch milliseconds, 12-hour snapshot windows, cut-offs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelens.functions.names import col_

__all__ = ["WINDOW_MS", "to_ms", "from_ms", "window_end_ms", "snap_tag_of_ms",
           "snap_date_of_ms", "snap_hour_of_ms", "snap_tag_from_parts",
           "cutoff_date", "pct", "ratio"]

# fixed value: snapshots are 12-hour windows named by their end
WINDOW_MS = 12 * 3600 * 1000


def to_ms(ts) -> Column:
    """Timestamp (or timestamp_ntz, read as UTC) -> epoch ms, floored."""
    return F.unix_millis(col_(ts).cast("timestamp"))


def from_ms(ms) -> Column:
    return F.timestamp_millis(col_(ms))


def window_end_ms(ms) -> Column:
    """End of the 12-hour window holding `ms`; a time on a boundary opens the next window."""
    m = col_(ms).cast("bigint")
    return m - F.pmod(m, F.lit(WINDOW_MS)) + F.lit(WINDOW_MS)


def snap_date_of_ms(ms) -> Column:
    return F.date_format(from_ms(window_end_ms(ms)), "yyyy-MM-dd")


def snap_hour_of_ms(ms) -> Column:
    return F.date_format(from_ms(window_end_ms(ms)), "HH")


def snap_tag_of_ms(ms) -> Column:
    return F.concat(F.lit("snap-"), F.date_format(from_ms(window_end_ms(ms)), "yyyy-MM-dd-HH"))


def snap_tag_from_parts(date, hour) -> Column:
    return F.concat(F.lit("snap-"), col_(date), F.lit("-"), col_(hour))


def cutoff_date(today: str, days: int) -> Column:
    """'today' minus N days as yyyy-MM-dd text (tags compare as strings)."""
    return F.date_format(F.date_sub(F.to_date(F.lit(today)), days), "yyyy-MM-dd")


def pct(part, whole, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * col_(part) / F.greatest(col_(whole), F.lit(1)), digits)


def ratio(a, b, digits: int = 2) -> Column:
    return F.round(col_(a) / F.greatest(col_(b), F.lit(1)), digits)
