"""zonelens: DNS observation analytics on Spark.

Rolls raw DNS measurements up into per-window observations, parses
certificate-transparency entries, and answers the catalogue of questions on
top of them (hosting / name-server concentration, window-to-window changes,
certificate joins, parking-provider deltas against a permanent first-seen
state, name-server audits) with DataFrames, Spark SQL and Structured
Streaming.
"""

__version__ = "0.1.0"
