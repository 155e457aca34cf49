"""End-to-end plans (entries B, C, D of SURVEY §3) composed from the operators,
writing the pipeline's outputs through the sinks.  ``reads_pipeline`` starts before them, at alignments (entry A).

    from sitecall.plans import pipeline
    out = pipeline.run_sites(spark, genome_long, transcript_long, transcripts, cfg, out_dir)

Inputs are long per-sample site counts (e.g. from ``sources.files.scan_pileup``)
and the transcript spans table.  The merged site table is written once and read
back, so calling and group tests start from a lineage-free table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecall.operators import calling, groups, liftover, merge, sites
from sitecall.options import Options
from sitecall.sources import sinks

KEYS = list(sites.SITE_KEYS)


@dataclass(frozen=True)
class SampleDesign:
    samples: Sequence[str]
    requires: Sequence[int]
    groups: Sequence[tuple[str, Sequence[str]]] = field(default_factory=tuple)

    def with_options(self, opts: Options) -> SampleDesign:
        """Samples that the options skip only annotate; the options' groups hold where the design has none."""
        requires = [0 if s in opts.skip_samples else r for s, r in zip(self.samples, self.requires)]
        return SampleDesign(self.samples, requires, self.groups or opts.groups)

    @property
    def ordered(self) -> list[str]:
        return [s for s, _ in merge.merge_order(self.samples, self.requires)]


def merged_sites(genome_long: DataFrame, transcript_long: DataFrame, transcripts: DataFrame,
                 design: SampleDesign, opts: Options = Options()) -> DataFrame:
    """Entry C: merge each reference type, lift transcript sites, union, re-aggregate (long)."""
    ex = liftover.exon_offsets(transcripts)
    # dealt by gene, whose sites are bounded by its length: the merge and a join with the exons by gene then share one shuffle and sort
    tx = merge.merge_site_counts(transcript_long.repartition("chrom"), design.samples, design.requires, opts.merge_min_depth)
    # the genome merge shares the merged-site partitioning: one shuffle of the genome rows
    return liftover.merge_lifted_with_genome(liftover.liftover_sites(tx, ex), genome_long, design.samples, design.requires,
                                             opts.merge_min_depth, opts.merged_min_depth)


def merged_sites_wide(merged_long: DataFrame, design: SampleDesign) -> DataFrame:
    w = sites.to_wide(merged_long, design.ordered, KEYS, site_cols=("gene_names", "gene_pos", "motif"))
    return w.select(
        F.col("chrom").alias("Chrom"), F.col("pos").alias("Pos"), F.col("strand").alias("Strand"),
        F.col("gene_names").alias("GeneName"), F.col("gene_pos").alias("GenePos"), F.col("motif").alias("Motif"),
        *[c for s in design.ordered for c in (f"Uncon_{s}", f"Depth_{s}")],
    )


def call(merged_long: DataFrame, opts: Options = Options(), design: SampleDesign | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entry B: (called long rows, fit points, fit parameters).  Treated-library pooling
    runs only when the design has ``-p-`` libraries (or when no design is given)."""
    pool = True if design is None else any(calling.POOL_MARK in s for s in design.samples)
    return calling.call_sites(merged_long, KEYS, opts, pool=pool)


def group_tests(merged_long: DataFrame, design: SampleDesign, opts: Options = Options()) -> DataFrame:
    """Entry D: pooled replicate groups with the binomial test (all groups in one job)."""
    spark = merged_long.sparkSession
    pooled = groups.pool_groups(merged_long, groups.group_table(spark, design.groups), KEYS)
    return groups.group_test(pooled, opts.group_min_depth, opts.group_error_rate)


def run_sites(spark: SparkSession, genome_long: DataFrame, transcript_long: DataFrame, transcripts: DataFrame,
              design: SampleDesign, out_dir: str, opts: Options = Options()) -> dict[str, str]:
    """Write sites.tsv.gz and filtered.tsv (wide, in coordinate order, 8-digit scientific floats), the model,
    and grouped/<group> Parquet; returns the output paths."""
    design = design.with_options(opts)
    out = {
        "merged": f"{out_dir}/merged.parquet",
        "sites": f"{out_dir}/sites.tsv.gz",
        "filtered": f"{out_dir}/filtered.tsv",
        "model": f"{out_dir}/model",
        "grouped": f"{out_dir}/grouped",
    }
    merged_sites(genome_long, transcript_long, transcripts, design, opts).write.mode("overwrite").parquet(out["merged"])
    merged = spark.read.parquet(out["merged"])
    sinks.sink_tsv(merged_sites_wide(merged, design), out["sites"], order_by=["Chrom", "Pos", "Strand"])
    called, points, params = call(merged, opts, design)
    wide = calling.called_wide(called, design.ordered, KEYS, site_cols=("gene_names", "gene_pos", "motif", "motif3", "gc_pct"))
    sinks.sink_tsv_sci(wide.orderBy(*KEYS), out["filtered"])
    sinks.sink_model(points, params, out["model"])
    if design.groups:
        tested = group_tests(merged, design, opts)
        sinks.sink_parquet_groups(tested, out["grouped"])
    return out
