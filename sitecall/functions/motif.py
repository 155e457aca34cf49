"""Motif, GC and ratio Column functions.

A motif is a sequence context whose target base sits at 0-based index 15.
Everything here is a built-in Column expression, so it stays in whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the motif layout (0-based Python slices of the original):
# 3-mer = motif[14:17]; GC window = motif[4:14] + motif[17:27], always over 20.
MOTIF3_START = 15  # 1-based start of motif[14:17]
GC_LEFT_START, GC_RIGHT_START, GC_WINDOW_HALF = 5, 18, 10
GC_WINDOW = 20


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(a, b) -> Column:
    """Integral division (SQL ``div``); operands here are non-negative."""
    return F.call_function("div", col(a), col(b))


def motif3(motif) -> Column:
    """Upper-cased 3-mer around the target base."""
    return F.upper(F.substring(col(motif), MOTIF3_START, 3))


def motif3_rna(motif, max_t: int | None = None) -> Column:
    """3-mer with T -> U.  ``max_t=2`` replaces only the first two T (site filter rule)."""
    m3 = motif3(motif)
    rna = F.translate(m3, "T", "U")
    if max_t is None:
        return rna
    if max_t != 2:
        raise ValueError("only max_t=2 or None is used")
    # A 3-mer holds at most three T; only "TTT" differs from replacing all.
    return F.when(m3 == F.lit("TTT"), F.lit("UUT")).otherwise(rna)


def gc_count(motif) -> Column:
    """Count of G/C in the two 10-base flanks (case-folded)."""
    m = col(motif)
    window = F.upper(
        F.concat(
            F.substring(m, GC_LEFT_START, GC_WINDOW_HALF),
            F.substring(m, GC_RIGHT_START, GC_WINDOW_HALF),
        )
    )
    return F.length(window) - F.length(F.regexp_replace(window, "[GC]", ""))


def gc_pct(motif) -> Column:
    """GC in integer percent (multiples of 5): the exact join/group key."""
    return (gc_count(motif) * F.lit(100 // GC_WINDOW)).cast("bigint")


def gc_value(gc_pct_col) -> Column:
    """GC fraction as a double, equal to round(count / 20, 2)."""
    return col(gc_pct_col) / F.lit(100.0)


def gc_bin_pct(gc_pct_col, low: int = 20, high: int = 80) -> Column:
    """>high -> 100, <low -> 0, else unchanged (percent units)."""
    g = col(gc_pct_col)
    return F.when(g > high, F.lit(100)).when(g < low, F.lit(0)).otherwise(g).cast("bigint")


def ratio_pct2(uncon, depth) -> Column:
    """round(uncon / depth, 2) as integer hundredths: the double quotient times 100, ties to the even hundredth.

    An integer keeps the value identical on every engine; null when depth <= 0.
    """
    u, d = col(uncon).cast("double"), col(depth).cast("double")
    return F.when(d > 0, F.rint(F.try_divide(u, d) * 100).cast("bigint"))


def site_ratio(uncon, depth) -> Column:
    """uncon / depth; null when depth is 0 (ANSI division by zero would raise)."""
    return F.try_divide(col(uncon).cast("double"), col(depth).cast("double"))


def has_n(m3) -> Column:
    return F.instr(col(m3), "N") > 0


def motif_valid(m3, target_base: str = "A") -> Column:
    """3-mer of A/T/G/C only whose centre is the target base."""
    m = col(m3)
    return m.rlike("^[ATGC]+$") & (F.substring(m, 2, 1) == F.lit(target_base.upper()))
