"""Malformed input fails instead of vanishing; sizes above the cap are counted."""

import pytest
from pyspark.sql import functions as F

from sitecall.operators import reads
from sitecall.sources import files


def _write(tmp_path, *lines):
    p = tmp_path / "s.tsv"
    p.write_text("\n".join("\t".join(x) for x in lines) + "\n")
    return str(p)


HEAD = ("chrom", "pos", "strand", "motif", "u0", "u1", "u2", "m0", "m1", "m2")


def test_malformed_count_fails(spark, tmp_path):
    path = _write(tmp_path, HEAD, ("1", "5", "+", "AACAA", "1", "1", "1", "1", "1x", "1"))
    with pytest.raises(Exception, match="(?i)malformed|1x"):
        files.scan_pileup(spark, path).collect()


def test_columns_are_found_by_name(spark, tmp_path):
    """Another order and further columns, file by file; a legacy file beside them, whose later lines start with chrom too."""
    (tmp_path / "a.tsv").write_text("chrom\tpos\tstrand\tmotif\tu0\tm0\tu1\tm1\tu2\tm2\n1\t5\t+\tAACAA\t0\t9\t1\t9\t0\t0\n")
    (tmp_path / "b.tsv").write_text("chrom\tnote\tpos\tstrand\tmotif\tu0\tu1\tu2\tm0\tm1\tm2\nchromX\tn\t6\t-\tAAAAA\t1\t2\t3\t4\t5\t6\n")
    want = {("a", "1", 5, "+", "AACAA", 1, 10), ("b", "chromX", 6, "-", "AAAAA", 5, 16)}
    assert {tuple(r) for r in files.scan_pileup(spark, str(tmp_path)).collect()} == want
    (tmp_path / "c.tsv").write_text("1\t7\t+\tTTTTT\t9\t9\t2\t8\t1\t1\nchromX\t8\t+\tTTTTT\t9\t9\t3\t7\t1\t1\n")
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "d e%.tsv").write_text("1\t9\t+\tTTTTT\t0\t0\t1\t2\t0\t0\n")
    auto = files.scan_pileup_auto(spark, str(tmp_path))
    assert auto._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert {tuple(r) for r in auto.collect()} == want | {("c", "1", 7, "+", "TTTTT", 2, 8), ("c", "chromX", 8, "+", "TTTTT", 3, 7), ("d e%", "1", 9, "+", "TTTTT", 1, 2)}
    with pytest.raises(ValueError, match="no header"):
        files.scan_pileup(spark, str(tmp_path))


def test_missing_column_and_short_line_fail(spark, tmp_path):
    with pytest.raises(ValueError, match="without m2"):
        files.scan_pileup(spark, _write(tmp_path, HEAD[:-1], ("1", "5", "+", "AACAA", "0", "1", "1", "1", "1")))
    path = _write(tmp_path, HEAD, ("1", "5", "+", "AACAA", "0", "1", "1", "1", "1"))
    with pytest.raises(Exception, match="malformed line"):
        files.scan_pileup(spark, path).collect()


def test_sample_from_flat_file_names(spark, tmp_path):
    (tmp_path / "s1_run1.json").write_text('{"input": 5, "output": 4, "filtering_statistics": {"percent_trimmed": 2.5}}')
    assert files.trim_report_json(spark, str(tmp_path / "*.json")).first()["sample"] == "s1"
    for name in ("s1.genome.log", "s2.log"):
        (tmp_path / name).write_text("Total reads processed: 1,200\nDuplicates removed: 200\nTotal Unique Reads: 1,000\nDeduplication rate: 16.67%\n")
    got = {tuple(r)[:5] for r in files.dedup_log_parse(spark, str(tmp_path / "*.log")).select("sample", "reftype", "total_reads", "duplicates", "unique_reads").collect()}
    assert got == {("s1", "genome", 1200, 200, 1000), ("s2", "unknown", 1200, 200, 1000)}


def test_large_insert_sizes_are_counted(spark):
    rows = [("s", "g", 67, 150), ("s", "g", 67, -1000), ("s", "g", 67, 5000), ("s", "g", 67, 7000)]
    got = reads.insert_size_hist(spark.createDataFrame(rows, "sample string, reftype string, flag int, isize int"))
    assert {r["isize"]: r["pairs"] for r in got.collect()} == {150: 1, 1000: 1, 1001: 2}
    assert got.agg(F.sum("pairs")).first()[0] == 4


def test_sample_mapping(spark, tmp_path):
    """Fallbacks, pairing by the number of files, groups, a batch's own mapping; no samples is an error."""
    (tmp_path / "c.json").write_text('{"adapter": "ACGT", "samples": {"7": {"data": [{"R1": "a.fq"}, {"R1": "b.fq", "R2": "c.fq"}], "group": "g"}, "x": {"libtype": "L", "adapter": "TT", "data": [{"R1": "d.fq"}]}}}')
    runs, groups = files.sample_mapping(spark, str(tmp_path / "c.json"))
    assert {tuple(r) for r in runs.collect()} == {("7", "run1", "", "ACGT", "a.fq", None, False), ("7", "run2", "", "ACGT", "b.fq", "c.fq", True), ("x", "run1", "L", "TT", "d.fq", None, False)}
    assert [tuple(r) for r in groups.collect()] == [("g", "7")]
    (tmp_path / "e.json").write_text('{"adapter": "ACGT"}')
    with pytest.raises(Exception, match="needs samples"):
        files.sample_mapping(spark, str(tmp_path / "e.json"))[0].collect()
