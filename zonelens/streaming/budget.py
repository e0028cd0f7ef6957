"""Time budget of a streaming run."""

from __future__ import annotations


class BudgetExceeded(TimeoutError):
    """The query was stopped because its time budget ran out; a restart resumes it."""


def finish(query, timeout_s: int | None) -> None:
    """Wait for an `availableNow` query.  When the budget runs out the query is stopped (its
    checkpoint keeps what was committed) and BudgetExceeded is raised; its own error is passed on."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise BudgetExceeded(f"stopped after {timeout_s} s; the checkpoint holds the committed batches")
    if query.exception() is not None:
        raise query.exception()
