"""Writers: observation Parquet, JSON lines, CSV, per-provider deltas, state."""

from zonelens.sinks.writers import *  # noqa: F401,F403
