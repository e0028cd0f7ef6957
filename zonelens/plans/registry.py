"""Query registry: name -> Spark plan over a data folder, name -> DuckDB oracle.

Every plan reads the driver tables (through `zonelens.sources.projection`)
and runs over whole tables.  List-valued results are reported as
comma-joined sorted strings so that both engines hash them alike.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def joined(c, sep: str = ",") -> "F.Column":
    """A list as one sorted comma-joined string (NULL stays NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.sort_array(col), sep)


# the queries live in these modules; importing them fills the registry
from zonelens.plans import q_archive, q_catalogue, q_files, q_ingest, q_parking, q_sql, q_stream  # noqa: E402,F401
