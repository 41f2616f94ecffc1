"""Operators for training-data pipelines.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``__spark_entry__`` adds them when it can be imported.
"""
