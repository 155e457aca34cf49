"""FASTQ and FASTA read in splits of any size equal whole reads; cut and malformed records fail."""

import gzip
import random

import pytest

from sitecall.sources import sequences


@pytest.fixture()
def split_bytes(spark):
    """Set how many bytes a split has."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def put(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


def _reads(n, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.randint(0, 9)
        seq = "".join(rng.choice("ACGTN") for _ in range(k))
        qual = "".join(rng.choice("@+I#5") for _ in range(k))  # qualities may start like a header or a separator
        out.append((f"r{i}", seq, qual))
    return out


def _text(reads):
    return "".join(f"@{n} x y\n{s}\n+{n if i % 3 == 0 else ''}\n{q}\n" for i, (n, s, q) in enumerate(reads))


@pytest.mark.parametrize("size", [3, 33, 100, 257, 1 << 20])
def test_any_split_size_equals_a_whole_read(spark, tmp_path, split_bytes, size):
    n = 6 if size < 30 else 40
    want = {}
    for k in range(2):
        reads = _reads(n, k)
        (tmp_path / f"f{k}.fastq").write_text(_text(reads) + "\n" * k)
        want[f"f{k}.fastq"] = reads
    split_bytes(size)
    rows = sequences.scan_reads(spark, str(tmp_path)).collect()
    for name, reads in want.items():
        assert sorted((r["name"], r["seq"], r["qual"]) for r in rows if r["file"].endswith(name)) == sorted(reads)
    assert len(rows) == 2 * n


def test_gzip_is_one_split(spark, tmp_path, split_bytes):
    reads = _reads(500)
    with gzip.open(tmp_path / "f.fastq.gz", "wt") as f:
        f.write(_text(reads))
    split_bytes(200)
    assert sorted((r["name"], r["seq"], r["qual"]) for r in sequences.scan_reads(spark, str(tmp_path)).collect()) == sorted(reads)


@pytest.mark.parametrize("size", [50, 1 << 20])
@pytest.mark.parametrize("tail", ["@last\nACGT\n+\n", "@last\nACGT\n", "@last\n", "@last\nACGT\n+\nII\n", "last\nACGT\n+\nIIII\n", "@last\nACGT\n-\nIIII\n"])
def test_cut_or_malformed_records_fail(spark, tmp_path, split_bytes, tail, size):
    (tmp_path / "f.fastq").write_text(_text(_reads(9)) + tail)
    split_bytes(size)
    with pytest.raises(Exception, match="cut"):
        sequences.scan_reads(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("size, tile, margin", [(11, 50, 15), (40, 7, 3), (300, 50, 15), (1 << 20, 1000, 15)])
def test_tiles_equal_the_records(spark, tmp_path, split_bytes, size, tile, margin):
    rng = random.Random(5)
    records = {f"c{i}": "".join(rng.choice("ACGTacgt") for _ in range(n)) for i, n in enumerate((0, 1, 7, 49, 50, 51, 333))}
    items = list(records.items())
    for k, part in enumerate((items[:4], items[4:])):
        text = "".join(f">{name} some text\n" + "".join(seq[i : i + 20] + "\n" for i in range(0, len(seq), 20)) for name, seq in part)
        (tmp_path / f"f{k}.fa").write_text(text + "\n")
    split_bytes(size)
    rows = sequences.fasta_tiles(spark, str(tmp_path), tile, margin).collect()
    want = {}
    for name, seq in records.items():
        padded = "N" * margin + seq + "N" * (tile + margin)
        for t in range(-(-len(seq) // tile)):
            want[name, t] = (len(seq), padded[t * tile : (t + 1) * tile + 2 * margin])
    assert {(r["name"], r["tile"]): (r["length"], r["bases"]) for r in rows} == want
    assert len(rows) == len(want) and {r["description"] for r in rows} == {"some text"}


def test_bases_before_a_header_fail(spark, tmp_path):
    (tmp_path / "f.fa").write_text("ACGT\n>a\nAC\n")
    with pytest.raises(Exception, match="before the first header"):
        sequences.fasta_tiles(spark, str(tmp_path)).collect()


def test_transcript_sequences_equal_brute_force(spark, tmp_path):
    rng = random.Random(8)
    genome = {c: "".join(rng.choice("ACGT") for _ in range(400)) for c in ("a", "b")}
    (tmp_path / "g.fa").write_text("".join(f">{c}\n{s}\n" for c, s in genome.items()))
    rows, want = [], {}
    for i in range(60):
        chrom, strand = rng.choice("ab"), rng.choice("+-")
        cuts = sorted(rng.sample(range(1, 401), 2 * rng.randint(1, 4)))
        spans = list(zip(cuts[::2], cuts[1::2]))
        spans = spans[::-1] if strand == "-" else spans
        rows.append((f"g{i}", chrom, strand, ",".join(f"{a}-{b}" for a, b in spans)))
        seq = ""
        for a, b in spans:
            part = genome[chrom][a - 1 : b]
            seq += part if strand == "+" else part[::-1].translate(str.maketrans("ACGT", "TGCA"))
        want[f"g{i}"] = seq
    rows.append(("none", "zzz", "+", "1-5"))
    want["none"] = ""
    tiles = sequences.fasta_tiles(spark, str(tmp_path), 16, 3)
    got = sequences.transcript_sequences(spark.createDataFrame(rows, "gene_id string, chrom string, strand string, spans string"), tiles, 16, 3)
    assert {r["gene_id"]: r["seq"] for r in got.collect()} == want
