"""Structured Streaming forms of the rollup and of the first-seen state."""
