"""Operators for preparing training data: filters, duplicates, tokenizing, formatting.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames and selects the columns it needs, so further columns and
clashing names in its input do no harm.  A null text counts as an empty one
unless an operator says otherwise; a repeated row is judged like any other.
"""
