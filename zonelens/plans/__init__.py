"""Named query plans over the driver tables, each with a DuckDB oracle."""
