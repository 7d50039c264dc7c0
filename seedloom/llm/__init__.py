"""Operators of a training-data pipeline for language models.

Nothing else in the library imports this package; ``queries`` registers its queries.
"""
