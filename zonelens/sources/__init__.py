"""Readers: driver tables, projections, archive views, Kafka / JSON envelopes, config."""
