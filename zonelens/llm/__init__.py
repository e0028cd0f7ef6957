"""Operators of a training-data pipeline: language identification, exact top-k,
secret and personal-data scans, similarity joins, decontamination, repeat
removal, packing, quality sampling and language-model scoring.

Nothing else in the library imports this subpackage; it may be deleted whole.
"""
