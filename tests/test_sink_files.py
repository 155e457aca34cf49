"""K1: what the sink of the merged sites leaves on disk (F6 of FINDINGS_r04)."""

import glob
import gzip
import os
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq


def _tables(folder: str) -> str:
    """60 lineitem rows and their parts, several rows a site."""
    import datetime

    n = 60
    rows = {
        "l_orderkey": list(range(1, n + 1)), "l_partkey": [i % 12 + 1 for i in range(n)], "l_suppkey": [i % 7 + 1 for i in range(n)],
        "l_linenumber": pa.array([i % 5 + 1 for i in range(n)], pa.int32()), "l_quantity": [float(i % 50 + 1) for i in range(n)],
        "l_extendedprice": [1.0] * n, "l_discount": [0.0] * n, "l_tax": [0.0] * n, "l_returnflag": ["N"] * n,
        "l_linestatus": ["O" if i % 2 else "F" for i in range(n)], "l_shipdate": pa.array([datetime.datetime(2000, 1, 1)] * n, pa.timestamp("us")),
    }
    pq.write_table(pa.table(rows), f"{folder}/lineitem.parquet")
    pq.write_table(pa.table({"p_partkey": list(range(1, 13)), "p_name": ["x"] * 12, "p_size": pa.array([1] * 12, pa.int32())}), f"{folder}/part.parquet")
    return folder


def test_sites_are_gzip_files_in_coordinate_order(spark, tmp_path):
    from sitecall.plans.source_queries import sink_tsv_gz

    out = sink_tsv_gz(spark, _tables(str(tmp_path)))
    folder = os.path.dirname(urlparse(out.inputFiles()[0]).path)
    parts = sorted(glob.glob(f"{folder}/part-*"))
    assert folder.endswith(".gz") and parts and all(p.endswith(".gz") for p in parts)
    lines = []
    for p in parts:
        with gzip.open(p, "rt") as f:
            head, *body = f.read().splitlines()
            assert head.startswith("Chrom\tPos\tStrand")
            lines += [(c, int(pos), strand) for c, pos, strand, *_ in (x.split("\t") for x in body)]
    assert len(lines) > 10 and lines == sorted(lines) and len(lines) == out.count()
