"""Operators for preparing training data: scoring, filtering, near-duplicate
removal, decontamination, mixing, personal data and tokenised output.

Every operator takes DataFrames and column names, selects only the columns it
needs under names of its own (so extra columns of the input never clash), and
returns a DataFrame keyed by the caller's id column. ``queries.py`` applies
them to the driver's tables.
"""
