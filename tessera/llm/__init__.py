"""Operators of a training-data pipeline (near-duplicates, filters, tokenizers, output).

One module per operator. Each takes DataFrames and returns DataFrames; the
registered queries of ``queries.py`` derive their digest columns from them.
Nothing outside this package imports it.
"""
