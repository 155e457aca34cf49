"""End-to-end run of the site pipeline on the smallest fixtures."""

from pyspark.sql import functions as F

from sitecall import fixture_files as ff
from sitecall import fixtures as fx
from sitecall.operators import background, gapped
from sitecall.options import Options
from sitecall.plans import pipeline, reads_pipeline
from sitecall.session import unique_scratch
from sitecall.sources import sequences


def test_run_sites_end_to_end(spark, sf):
    design = pipeline.SampleDesign(("s0", "s1", "s2", "s3"), (0, 1, 1, 1), fx.GROUPS)
    out = pipeline.run_sites(
        spark, fx.load(spark, sf, "site_counts"), fx.load(spark, sf, "transcript_counts"),
        fx.load(spark, sf, "transcripts"), design, unique_scratch(spark, "pipeline"),
    )
    sites = spark.read.csv(out["sites"], sep="\t", header=True)
    assert {"Chrom", "Pos", "Strand", "GeneName", "GenePos", "Motif", "Depth_s1"} <= set(sites.columns)
    merged = spark.read.parquet(out["merged"])
    assert sites.count() == merged.select("chrom", "pos", "strand").distinct().count()
    filtered = spark.read.csv(out["filtered"], sep="\t", header=True)
    assert {"p_s1", "Ratio_s1", "Background_s1", "GC", "motif3"} <= set(filtered.columns)
    assert spark.read.parquet(out["model"] + "/params").count() > 0
    groups = spark.read.parquet(out["grouped"])
    assert {r["group"] for r in groups.select("group").distinct().collect()} <= {"g1", "g2"}


def test_run_reads_end_to_end(spark, sf):
    """Entry A: alignments of three reference types to sites, calls and all report tables."""
    tile = 500
    cols = ["sample", "run", "reftype", "read_id", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual", "yf", "zf", "umi", "isize", "qlen", "sclen", "xm", "ns", "nc", "strand"]

    def aligned(name, reftype):
        a = fx.load(spark, sf, name)
        for c, v in (("run", "run1"), ("mapq", 30), ("umi", "AC"), ("isize", 200), ("xm", 0), ("ns", 0), ("nc", 0), ("qual", None), ("read_id", None)):
            if c not in a.columns:
                a = a.withColumn(c, F.monotonically_increasing_id().cast("string") if c == "read_id" else F.lit(v))
        a = a.withColumn("ns", F.lit(1).cast("long")).withColumn("nc", F.lit(0).cast("long")).withColumn("qlen", F.length("seq").cast("long")).withColumn("sclen", F.lit(0).cast("long"))
        return a.withColumn("reftype", F.lit(reftype)).withColumn("strand", F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+")).select(*cols)

    genome = aligned("sam_records", "genome")
    aln = genome.unionByName(aligned("tx_sam_records", "transcript")).unionByName(aligned("probe_sam_records", "genes"))
    tiles = {"genome": sequences.fasta_tiles(spark, ff.genome_fasta_files(spark, sf), tile), "genes": sequences.fasta_tiles(spark, ff.probe_fasta_files(spark, sf), tile)}
    spans = fx.load(spark, sf, "transcripts")
    tiles["transcript"] = sequences.sequence_tiles(sequences.transcript_sequences(spans, tiles["genome"], tile).select(F.col("gene_id").alias("name"), "seq"), tile)
    inputs = reads_pipeline.ReadInputs(aln, tiles, spans, fx.load(spark, sf, "trim_reports"), tile)
    design = pipeline.SampleDesign(("s0", "s1", "s2", "s3"), (1, 1, 1, 1))
    opts = Options(skip_samples=("s0",), groups=fx.GROUPS, group_min_depth=2, fallback_params=(2e-4, 8.0, 0.03, 10.0, 0.4))
    out = reads_pipeline.run_reads(spark, inputs, design, unique_scratch(spark, "reads-pipeline"), opts)
    kept = spark.read.parquet(out["dedup"])
    counts = spark.read.parquet(out["pileup"])
    want = gapped.pileup_counts(kept.where("reftype = 'genome'"), tiles["genome"], tile=tile)
    got = counts.where("reftype = 'genome'").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and counts.where("reftype = 'transcript'").count() > 0
    sites = spark.read.csv(out["sites"], sep="\t", header=True)
    keys = [(r["Chrom"], int(r["Pos"]), r["Strand"]) for r in sites.select("Chrom", "Pos", "Strand").collect()]
    assert keys == sorted(keys) and len(keys) > 100  # in coordinate order
    assert {r["g"] for r in spark.read.parquet(out["grouped"]).selectExpr("group as g").distinct().collect()} == {"g1", "g2"}
    merged = spark.read.parquet(out["merged"])
    lone = merged.groupBy("chrom", "pos", "strand").agg(F.collect_set("sample").alias("s")).where(F.array_contains("s", "s0") & (F.size("s") == 1))
    assert lone.where("strand <> '.'").count() == 0  # a skipped sample only annotates
    for name in ("hierarchy", "duplicates", "spike", "motif_genome", "motif_transcript", "heatmap", "ratio_histogram", "depth_histogram", "summary"):
        lines = [r["value"] for r in spark.read.text(out[name]).collect()]
        assert lines[0] == f"# id: {name}" and len(lines) > 4, name


def test_fallback_parameters_are_an_option(spark):
    points = spark.createDataFrame([("s", "AAA", 40, 0.1, 0.4, 5), ("s", "AAA", 50, 0.2, 0.5, 5)], "sample string, motif3 string, gc_bin long, ratio double, gc double, count long")
    row = background.fit_background(points, (2e-4, 7.0, 0.1, 9.0, 0.5)).first()
    assert (row["status"], row["a"], row["b"], row["e"]) == ("few_points", 2e-4, 7.0, 0.5)
