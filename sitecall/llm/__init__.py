"""Training-data operators: filtering, near-duplicate joins, scoring, mixing and packing of text corpora.

Nothing else in the library imports this subpackage.
"""
