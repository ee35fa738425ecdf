"""Training-data operators: scoring, filtering, joining, mixing, packing and formatting of text.

Nothing else in the library imports this subpackage.  Every operator takes DataFrames, reads only
the columns it is told to read (other columns, clashing names included, are ignored) and returns a
DataFrame; each module's docstring gives the result for nulls, empty texts, ties, repeated rows and
empty tables.
"""
