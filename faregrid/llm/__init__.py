"""Operators for preparing training data at scale: filtering, deduplication, mixing, packing.

Self-contained: nothing else in the library imports this subpackage. Every
operator takes DataFrames and returns DataFrames; ``queries`` registers one query
per operator.
"""
