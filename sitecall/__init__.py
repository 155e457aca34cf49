"""Spark-native engine for base-conversion sequencing sites.

Samples live in one long table ``site_counts(sample, chrom, pos, strand, motif,
uncon, depth)``; every per-library step of the original file pipeline becomes a
grouped aggregate, a join or a window over that table.  Wide per-sample columns
(``Uncon_<s>``, ``Depth_<s>``) only exist at the sinks.

Public API: functions ``DataFrame -> DataFrame`` usable with ``df.transform``.
"""

from sitecall.options import Options

__all__ = ["Options"]
