"""Join helpers: broadcast only behind a size check, shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a "small" side is shuffled instead of broadcast.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
# Bytes above which it is shuffled, as counted over its values.
DEFAULT_BROADCAST_MAX_BYTES = 64 << 20


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    An eager checkpoint computes each row once.
    """
    return df.checkpoint(eager=True)


def materialise_dealt(df: DataFrame) -> DataFrame:
    """Checkpoint a frame that keeps its partitioning by key.  A plan that adaptive execution
    runs has no partitioning to pass on, so this one is planned without it."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def bounded_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """Checkpoint ``small``, count it, and wrap it in ``broadcast`` if it fits.

    Returns (frame, broadcast?).  The count runs on the checkpointed data, so
    the small side is computed once.
    """
    small = materialise(small)
    n = small.count()
    if n <= max_rows:
        return F.broadcast(small), True
    return small, False


def value_bytes(df: DataFrame) -> int:
    """Bytes of all values: the text of strings and binaries, the JSON text of nested ones, 8 for any other."""
    sizes = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.simpleString()
        if kind.startswith(("array", "struct", "map")):
            c = F.octet_length(F.to_json(F.struct(c)))
        elif kind in ("string", "binary"):
            c = F.octet_length(c)
        else:
            c = F.lit(8)
        sizes.append(F.coalesce(c, F.lit(0)).cast("bigint") + 16)
    total = sizes[0]
    for c in sizes[1:]:
        total = total + c
    return df.agg(F.sum(total)).first()[0] or 0


def sized_side(small: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Checkpoint ``small``, add up the bytes of its values, and wrap it in ``broadcast`` if they fit."""
    small = materialise(small)
    if value_bytes(small) <= max_bytes:
        return F.broadcast(small), True
    return small, False


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Equi-join where ``small`` is expected to be small but is not trusted to be."""
    side, _ = bounded_broadcast(small, max_rows)
    return big.join(side, on=on, how=how)


def literal_map(mapping: dict, key_type: str = "string", value_type: str = "bigint"):
    """A map literal Column for config-sized lookups (samples -> rank, group, ...)."""
    if not mapping:
        return F.create_map().cast(f"map<{key_type},{value_type}>")
    items = []
    for k, v in mapping.items():
        items.extend([F.lit(k), F.lit(v)])
    return F.create_map(*items).cast(f"map<{key_type},{value_type}>")
