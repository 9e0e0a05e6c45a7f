"""Operators of a training-data pipeline over documents, vectors and benchmarks.

Nothing else in ``ledgerline`` imports this subpackage.
"""
