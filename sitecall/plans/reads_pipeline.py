"""Entry A from alignments to reports, composed from the operators.

    out = reads_pipeline.run_reads(spark, inputs, design, out_dir, opts)

accepted records -> deduplicated records (written) -> pileups of both reference types (written) -> site counts ->
``pipeline.run_sites`` (merged sites, calls, group tests) -> report tables. Every table between two steps is written
once under ``out_dir`` and read back, so that a lost executor costs one step and no plan runs twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecall.operators import gapped, report, sites
from sitecall.operators import reads as rd
from sitecall.options import Options
from sitecall.plans import pipeline
from sitecall.sources import sequences, sinks

REFTYPES = ("genome", "transcript")


@dataclass(frozen=True)
class ReadInputs:
    """``alignments``: sample, run, reftype and the columns of ``scan_alignments``, all runs and reference types;
    ``tiles``: reference type -> reference tiles (``fasta_tiles``), genome and transcript at least, genes with the spike-in
    probes if there are any; ``transcripts``: the spans table; ``trim_reports``: sample, run, report, or None."""

    alignments: DataFrame
    tiles: dict[str, DataFrame]
    transcripts: DataFrame
    trim_reports: DataFrame | None = None
    tile: int = sequences.TILE
    margin: int = sequences.MARGIN


def _stored(spark: SparkSession, df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    df.write.mode("overwrite").partitionBy(*by).parquet(path) if by else df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def deduplicated(inputs: ReadInputs, opts: Options = Options()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted records, kept records, duplicate sets) of every reference type."""
    split = rd.accept_reject_split(inputs.alignments, rd.stage_accept(opts))
    accepted = split.where("ok").drop("ok", "tags", "ops")
    kept, sets = rd.dedup_alignments(accepted)
    return accepted, kept, sets


def pileups(kept: DataFrame, inputs: ReadInputs, opts: Options = Options()) -> DataFrame:
    """Six-count pileups of all reference types but the contamination."""
    out = None
    for reftype in REFTYPES:
        p = gapped.pileup_counts(kept.where(F.col("reftype") == reftype), inputs.tiles[reftype], opts.ref_base, opts.mut_base, tile=inputs.tile, margin=inputs.margin)
        p = p.withColumn("reftype", F.lit(reftype))
        out = p if out is None else out.unionByName(p)
    return out


def run_reads(spark: SparkSession, inputs: ReadInputs, design: pipeline.SampleDesign, out_dir: str, opts: Options = Options()) -> dict[str, str]:
    """Write all outputs of ``run_sites``, the deduplicated records, the pileups and the report tables; returns their paths."""
    design = design.with_options(opts)
    out = {n: f"{out_dir}/{n}" for n in ("dedup", "sets", "pileup")} | {n: f"{out_dir}/report/{n}.tsv" for n in (
        "hierarchy", "duplicates", "spike", "motif_genome", "motif_transcript", "heatmap", "ratio_histogram", "depth_histogram", "summary")}
    accepted, kept, sets = deduplicated(inputs, opts)
    sets = _stored(spark, sets, out["sets"])
    kept = _stored(spark, kept, out["dedup"], ["reftype"])
    counts = _stored(spark, pileups(kept, inputs, opts), out["pileup"], ["reftype"])
    long = sites.depth_gt0(sites.uncon_depth_from_tiers(counts)).select("reftype", "sample", "chrom", "pos", "strand", "motif", "uncon", "depth")
    genome, transcript = (long.where(F.col("reftype") == t).drop("reftype") for t in REFTYPES)
    out |= pipeline.run_sites(spark, genome, transcript, inputs.transcripts, design, out_dir, opts)

    def put(name: str, title: str, table: DataFrame, order: Sequence[str]) -> None:
        sinks.sink_report_tsv(table, out[name], [f"# id: {name}", f"# section_name: '{title}'", "# plot_type: 'table'"], order_by=order)

    put("duplicates", "Duplicates by library", rd.dedup_report(sets), ["sample", "reftype"])
    if inputs.trim_reports is not None:
        trim = inputs.trim_reports.select("sample", report.json_first_number("report", "input").alias("input"), report.json_first_number("report", "output").alias("output"))
        stages = rd.stage_counts(trim, rd.read_count_r1(accepted), rd.read_count_r1(kept))
        table = report.read_hierarchy(report.stage_counts_wide(stages)).join(report.trimmed_pct_of_samples(inputs.trim_reports), "sample", "left")
        put("hierarchy", "Where the reads went", table, ["sample"])
    else:
        out.pop("hierarchy")
    if "genes" in inputs.tiles:
        spike = gapped.spike_counts(kept.where("reftype = 'genes'"), inputs.tiles["genes"], tile=inputs.tile, margin=inputs.margin)
        put("spike", "Spike-in probes", report.spike_table(spike), ["sample", "rate"])
    else:
        out.pop("spike")
    for reftype in REFTYPES:
        motifs = report.motif_conversion(long.where(F.col("reftype") == reftype), opts.target_base).withColumnRenamed("m3", "motif")
        put(f"motif_{reftype}", f"Unconverted by motif, {reftype}", report.motif_table_wide(motifs, design.ordered), ["motif"])
    merged = spark.read.parquet(out["merged"])
    put("heatmap", "Unconverted by sample and motif", report.heatmap_ratio(merged, opts.target_base), ["sample", "motif"])
    put("summary", "Sites by sample", report.site_summary(merged), ["sample"])
    for name, title, table in zip(("ratio_histogram", "depth_histogram"), ("Sites by ratio", "Sites by depth"), report.histograms_wide(merged, design.ordered)):
        put(name, title, table, ["bin"])
    return out
