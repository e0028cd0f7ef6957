"""Operators of the observation pipeline, expressed as DataFrame plans."""
