"""Coordinate Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitecall.functions.motif import col


def span_start0(span) -> Column:
    """Start of a 1-based inclusive ``s-e`` span as a 0-based half-open start."""
    return F.split(col(span), "-", 2).getItem(0).cast("bigint") - 1


def span_end0(span) -> Column:
    """End of a ``s-e`` span (inclusive 1-based == exclusive 0-based)."""
    return F.split(col(span), "-", 2).getItem(1).cast("bigint")


def liftover_pos(strand, g_start, g_end, tx_start, gene_pos0) -> Column:
    """1-based genomic position of a 0-based transcript position.

    ``+``: g_start + offset; ``-``: g_end - offset - 1; anything else (unknown
    gene): the transcript position itself.
    """
    s = col(strand)
    off = col(gene_pos0) - col(tx_start)
    mapped = (
        F.when(s == "+", col(g_start) + off)
        .when(s == "-", col(g_end) - off - 1)
        .otherwise(col(gene_pos0))
    )
    return mapped + 1
