"""Oracle comparison used by the tests (mirrors the driver's check).

Both results are brought to pandas, columns sorted by name, doubles rounded,
rows sorted; then row count, column names and values must agree.
"""

from __future__ import annotations

import math
import os

import pandas as pd

from sitecall.fixtures import TABLES


def duckdb_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm_value(v, digits: int):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm_value(v.item(), digits)
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm_value(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm_value(x, digits) for x in v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_value(x, digits)) for k, x in v.items()))
    return v


def normalise(pdf: pd.DataFrame, digits: int = 6) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm_value(v, digits) for v in rec))
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return rows


_SPARK_TYPES = {"int": "int32", "bigint": "int64", "double": "float64", "string": "str", "boolean": "bool",
                "smallint": "int16", "tinyint": "int8", "float": "float32"}
_DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
               "SMALLINT": "int16", "TINYINT": "int8", "FLOAT": "float32"}


def schema_diff(spark_df, relation) -> dict:
    """Columns whose Spark and DuckDB types differ (e.g. int vs BIGINT, HUGEINT or DECIMAL leaks)."""
    s = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    d = {c: _DUCK_TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_df, oracle_sql: str, sf_dir: str, digits: int = 6, check_types: bool = True) -> tuple[bool, str]:
    """Run the Spark DataFrame and the DuckDB SQL; return (equal, message)."""
    con = duckdb_connect(sf_dir)
    if check_types:
        diff = schema_diff(spark_df, con.sql(oracle_sql))
        if diff:
            return False, f"column types differ: {diff}"
    left = spark_df.toPandas()
    right = con.execute(oracle_sql).fetchdf()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row count differs: spark {len(left)} vs oracle {len(right)}"
    a, b = normalise(left, digits), normalise(right, digits)
    if a != b:
        for i, (x, y) in enumerate(zip(a, b)):
            if x != y:
                return False, f"first differing row #{i}: spark {x} vs oracle {y} (cols {sorted(left.columns)})"
    return True, f"{len(left)} rows equal"
