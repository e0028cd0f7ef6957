"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a side is broadcast only when it is proven to hold at most this many rows
BROADCAST_MAX_ROWS = 100_000


def row_bound(df: DataFrame) -> int | None:
    """The number of rows that the plan itself proves to be the most (configuration lists,
    limits), without running it; None where it proves none."""
    rows = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(str(rows.get())) if rows.isDefined() else None


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast `df` only after checking its row count; otherwise leave the
    choice to the optimizer (sort-merge, or AQE's runtime size check).

    Use for dimension tables (provider config, top-K lists) whose size does
    not grow with the scanned data.  Where the plan proves a bound, nothing is run;
    else the check reads at most max_rows + 1 rows.  It is made on every call, so a
    table that has grown is not hinted any more.
    """
    bound = row_bound(df)
    if bound is None:
        bound = df.limit(max_rows + 1).count()
    return F.broadcast(df) if bound <= max_rows else df
