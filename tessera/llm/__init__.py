"""Training-data operators: packing, mixing, extraction, deduplication, scoring.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames; ``queries`` holds the thin queries over the shared tables.
"""
