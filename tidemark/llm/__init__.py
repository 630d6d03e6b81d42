"""Operators of a training-data pipeline: text in, filtered, packed and encoded text out.

Every operator takes and returns DataFrames and names its columns by
parameters; ``queries.py`` holds the thin registered queries. Nothing else in
the library imports this subpackage.
"""
