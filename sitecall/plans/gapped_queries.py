"""Registered queries on gapped alignments and sequence files: S6-S9 forms, A1, A15, J11, O6."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecall import fixture_files as ff
from sitecall import fixtures as fx
from sitecall.operators import gapped
from sitecall.operators import liftover as lo
from sitecall.plans import read_queries as rq
from sitecall.plans import sqltext as q
from sitecall.plans.registry import register
from sitecall.sources import files as src
from sitecall.sources import sequences

#: The fixture genome is small: short tiles, so that reads and exons cross them.
TILE = 500


def _genome(spark, sf):
    return sequences.fasta_tiles(spark, ff.genome_fasta_files(spark, sf), tile=TILE)


# ---- oracle parts: a CIGAR as one row an operation, then one row a base; the genome as one string a chromosome ----

OPS = "regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]')"


def ops_cte(src_name: str) -> str:
    """rid, columns of ``src_name``, i, op, n, qo, ro: operations with offsets as window sums."""
    return f"""
select *, coalesce(sum(case when op in ('M', 'I', 'S', '=', 'X') then n end) over w, 0)::bigint as qo, coalesce(sum(case when op in ('M', 'D', 'N', '=', 'X') then n end) over w, 0)::bigint as ro
from (select *, x[-1] as op, x[:-2]::bigint as n from (select *, unnest({OPS}) as x, unnest(range(len({OPS}))) as i from {src_name}))
window w as (partition by rid order by i rows between unbounded preceding and 1 preceding)"""


GENOME_SQL = ("genome", "select chrom, string_agg(bases, '' order by seg) as seq from genome_segments group by chrom")

_COUNTED = "(flag & 3844) = 0 and seq <> '*'"

_PAIRS_SQL = f"""
select p.*, substr(g.seq, x + 1, 1) as rb, substr(repeat('N', 15) || g.seq || repeat('N', 15), x + 1, 31) as around from (
 select rid, sample, chrom, minus, tier, pos - 1 + ro + k as x, substr(seq, qo + k + 1, 1) as qb from (select *, unnest(range(n)) as k from ops where op in ('M', '=', 'X'))
) p join genome g on g.chrom = p.chrom and x < length(g.seq)"""

_PILEUP_SQL = """
select sample, chrom, cast(x + 1 as bigint) as pos, case when minus then '-' else '+' end as strand,
 case when minus then reverse(translate(around, 'ACGT', 'TGCA')) else around end as motif,
 """ + ", ".join(f"cast(count_if(tier = {t} and qb = case when minus then '{c}' else '{b}' end) as bigint) as {p}{t}"
                 for p, b, c in (("u", "A", "T"), ("m", "G", "C")) for t in (0, 1, 2)) + """
from pairs where rb = case when minus then 'T' else 'A' end group by sample, chrom, x, minus, around"""


@register(
    "pileup_counts", "A1",
    fx.with_fixtures(["sam_records", "genome_segments"], _PILEUP_SQL, [
        ("recs", "select row_number() over () as rid, sample, chrom, pos, cigar, seq, ((flag & 16) <> 0) <> ((flag & 129) = 129) as minus, "
                 f"case when yf + zf < 5 then 0 when zf <= 2 then 1 else 2 end as tier from sam_records where {_COUNTED}"),
        ("ops", ops_cte("recs")), GENOME_SQL, ("pairs", _PAIRS_SQL)]),
)
def pileup_counts(spark, sf):
    """A1: six-count pileup of gapped alignments on both strands, against a tiled reference read from FASTA."""
    return gapped.pileup_counts(fx.load(spark, sf, "sam_records"), _genome(spark, sf), tile=TILE)


_PROBE_REF = " ".join(f"when {k} then '{v}'" for k, v in fx.PROBES.items())


@register(
    "spike_counts", "A15",
    fx.with_fixtures(["probe_sam_records"], "select sample, rate, x = 17 as is_signal, rb as ref_base, qb as read_base, count(*) as n from "
                     "(select sample, rate, pos - 1 + ro + k as x, substr(ref_seq, pos + ro + k, 1) as rb, substr(seq, qo + k + 1, 1) as qb from "
                     "(select *, unnest(range(n)) as k from ops where op in ('M', '=', 'X'))) where x < 53 group by all", [
        ("recs", f"select *, row_number() over () as rid, case rate {_PROBE_REF} end as ref_seq from (select *, {rq._RATE_SQL.format(c='chrom')} as rate from probe_sam_records) "
                 "where starts_with(chrom, 'probe_') and yf + zf >= 5 and (flag & 4) = 0"),
        ("ops", ops_cte("recs"))]),
)
def spike_counts(spark, sf):
    """Aligned base pairs on the spike-in probes by CIGAR, the signal base apart."""
    tiles = sequences.fasta_tiles(spark, ff.probe_fasta_files(spark, sf), tile=TILE)
    return gapped.spike_counts(fx.load(spark, sf, "probe_sam_records"), tiles, tile=TILE)


# ---- J11 / O6: position by position, then run lengths ----
_LIFT = [
    ("exons", q.exons_cte("transcripts")),
    ("recs", "select row_number() over () as rid, * from tx_sam_records where (flag & 4) = 0"),
    ("ops", ops_cte("recs")),
    ("steps", "select rid, chrom as gene, i, k, op, case when op in ('M', 'D', '=', 'X') then pos - 1 + ro + k else pos - 1 + ro end as tx "
              "from (select *, unnest(range(n)) as k from ops)"),
    ("lens", "select gene_name, max(tx_end) as tx_len, any_value(ex_strand) as strand, any_value(ex_chrom) as chrom from exons group by gene_name"),
    ("onto", "select s.rid, i, k, l.strand, case when tx < tx_len then op when op = 'D' then null when op = 'H' then 'H' else 'S' end as op, "
             "case when op in ('M', 'D', '=', 'X') then case when l.strand = '+' then e.g_start + (tx - e.tx_start) else e.g_end - (tx - e.tx_start) - 1 end end as g "
             "from steps s join lens l on l.gene_name = s.gene left join exons e on e.gene_name = s.gene and tx >= e.tx_start and tx < e.tx_end"),
    ("lined", "select *, row_number() over (partition by rid order by case when strand = '+' then i else -i end, case when strand = '+' then k else -k end) as o from onto where op is not null"),
    ("gaps", "select *, g - last_value(g ignore nulls) over (partition by rid order by o rows between unbounded preceding and 1 preceding) - 1 as gap, "
             "lag(op) over (partition by rid order by o) as prev from lined"),
    ("runs", "select *, sum(case when gap > 0 or prev is null or prev <> op then 1 else 0 end) over (partition by rid order by o) as run from gaps"),
    ("parts", "select rid, run, op, count(*) as n, max(coalesce(gap, 0)) as gap, min(g) as g, bool_or(op in ('M', '=', 'X')) as hit from runs group by rid, run, op"),
    ("lifted", "select rid, string_agg(case when gap > 0 then gap || 'N' else '' end || n || op, '' order by run) as cigar, min(g) + 1 as pos, "
               "count_if(gap > 0) + 1 as n_blocks from parts group by rid having bool_or(hit)"),
    ("lift", "select sample, read_id, r.chrom as gene, n.chrom, cast(l.pos as bigint) as pos, case when n.strand = '+' then flag else xor(flag, 16) end as flag, l.cigar, "
             "case when n.strand = '+' then seq else reverse(translate(seq, 'ACGT', 'TGCA')) end as seq, case when n.strand = '+' then qual else reverse(qual) end as qual, "
             "case when (flag & 16 <> 0) = (n.strand = '+') then '-' else '+' end as strand, cast(n_blocks as bigint) as n_blocks, yf, zf "
             "from recs r join lifted l using (rid) join lens n on n.gene_name = r.chrom"),
]


def _lifted(spark, sf):
    return gapped.lift_alignments(fx.load(spark, sf, "tx_sam_records"), lo.exon_offsets(fx.load(spark, sf, "transcripts")))


register("alignment_liftover", "J11", fx.with_fixtures(["transcripts", "tx_sam_records"], "select * from lift", _LIFT))(_lifted)


@register(
    "union_lifted", "O6",
    fx.with_fixtures(
        ["transcripts", "tx_sam_records", "sam_records"],
        "select sample, read_id, gene, chrom, pos, flag, cigar, seq, qual, strand, yf, zf from lift union all "
        "select sample, read_id, null, chrom, pos, flag, cigar, seq, qual, case when (flag & 16) <> 0 then '-' else '+' end, yf, zf from sam_records where reftype = 'genome' and (flag & 4) = 0", _LIFT),
)
def union_lifted(spark, sf):
    """Lifted transcript alignments plus genome alignments, spliced ones included, coordinate-sorted."""
    cols = ["sample", "read_id", "chrom", "pos", "flag", "cigar", "seq", "qual", "strand", "yf", "zf"]
    g = fx.load(spark, sf, "sam_records").where("reftype = 'genome' and (flag & 4) = 0")
    g = g.withColumn("strand", F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+")).select(*cols)
    return gapped.union_lifted(_lifted(spark, sf).select(*cols, "gene"), g)


# ---- sources ----
@register(
    "fasta_tiles", "S6",
    fx.with_fixtures(["genome_segments"],
                     "select chrom as name, 'synthetic' as description, length(seq)::bigint as length, t as tile, "
                     f"rpad(substr(repeat('N', 15) || seq, t * {TILE} + 1, {TILE + 30}), {TILE + 30}, 'N') as bases "
                     f"from (select *, unnest(range((length(seq) + {TILE - 1}) // {TILE})) as t from genome)", [GENOME_SQL]),
)
def fasta_tiles(spark, sf):
    """Chromosomes read as fixed tiles with a margin, none of them one value."""
    return _genome(spark, sf)


_TX_SEQ = (
    "select t.gene_id, t.chrom, t.strand, t.spans, coalesce(string_agg(case when t.strand = '-' then reverse(translate(substr(g.seq, a, b - a + 1), 'ACGT', 'TGCA')) "
    "else substr(g.seq, a, b - a + 1) end, '' order by i), '') as seq from (select *, split_part(s, '-', 1)::bigint as a, split_part(s, '-', 2)::bigint as b from "
    "(select *, unnest(string_split(spans, ',')) as s, unnest(range(len(string_split(spans, ',')))) as i from transcripts)) t "
    "left join genome g on g.chrom = t.chrom group by all"
)


@register("transcript_sequences", "S7", fx.with_fixtures(["transcripts", "genome_segments"], _TX_SEQ, [GENOME_SQL]))
def transcript_sequences(spark, sf):
    """Exon bases of every transcript from the genome's tiles, reverse complemented on the reverse strand."""
    return sequences.transcript_sequences(fx.load(spark, sf, "transcripts"), _genome(spark, sf), tile=TILE)


@register("scan_reads_plain", "S8", fx.with_fixtures(["reads"], "select sample, run, mate, read_id as name, seq, qual from reads"))
def scan_reads_plain(spark, sf):
    """Uncompressed FASTQ read in splits that cut records."""
    r = sequences.scan_reads(spark, ff.plain_fastq_files(spark, sf))
    return r.select(*[src.path_partition(c).alias(c) for c in ("sample", "run", "mate")], "name", "seq", "qual")
