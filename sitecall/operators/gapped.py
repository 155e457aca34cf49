"""Gapped alignments: pileup and spike-in counting by CIGAR (A1, A15) and lifting with introns.

An alignment's aligned stretches are cut at the tiles of the reference and joined to them by (chromosome, tile), so
that no read carries more reference than lies under it; a reference of checked size is broadcast, a larger one is
joined by a shuffle whose hot tiles adaptive execution can split. Bases are counted in the task that holds the
joined rows and summed below the one shuffle of counts. CIGARs are parsed once for each distinct one that a worker meets.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitecall.functions.cigar import MATCH_OPS, QUERY_OPS, REF_OPS, operations, reverse_complement
from sitecall.operators.basecount import PILEUP_CELLS, piece_partials, pileup_partials
from sitecall.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, sized_side
from sitecall.operators.pileup import MOTIF_HALF, default_tier, probe_rate, read_min_support
from sitecall.operators.reads import DUP, PAIRED, QCFAIL, READ2, REVERSE, SECONDARY, SUPPLEMENTARY, UNMAP, bit
from sitecall.options import SIGNAL_POS
from sitecall.sources.sequences import MARGIN, TILE

_COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A"}


def fragment_strand(flag="flag") -> Column:
    """Strand of the sequenced fragment: that of a first mate or single read, the opposite of a second mate's."""
    second = bit(flag, PAIRED) & bit(flag, READ2)
    return F.when(bit(flag, REVERSE) != second, F.lit("-")).otherwise(F.lit("+"))


def counted_records(aln: DataFrame, skip: int = UNMAP | SECONDARY | SUPPLEMENTARY | QCFAIL | DUP) -> DataFrame:
    """Records without any of the flag bits in ``skip`` and with a stored sequence."""
    return aln.where(~bit("flag", skip) & F.col("seq").isNotNull() & (F.col("seq") != "*"))


@lru_cache(maxsize=1 << 16)
def _stretches(cigar: str) -> tuple[tuple[int, int, int], ...]:
    """(query offset, reference offset, length) of the aligned stretches; adjoining ones are one."""
    out: list[tuple[int, int, int]] = []
    q = r = 0
    for n, op in operations(cigar):
        if op in MATCH_OPS:
            if out and out[-1][0] + out[-1][2] == q and out[-1][1] + out[-1][2] == r:
                out[-1] = (*out[-1][:2], out[-1][2] + n)
            else:
                out.append((q, r, n))
        q += n * (op in QUERY_OPS)
        r += n * (op in REF_OPS)
    return tuple(out)


def _cut_batches(passed: list[str], tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            which, tiles, places, parts = [], [], [], []
            for i, (cigar, pos, seq) in enumerate(zip(*(rb.column(c).to_pylist() for c in ("cigar", "pos", "seq")))):
                for q, r, n in _stretches(cigar) if cigar and cigar != "*" else ():
                    low = pos - 1 + r
                    while n > 0:
                        t, at = divmod(low, tile)
                        m = min(n, tile - at)
                        which.append(i)
                        tiles.append(t)
                        places.append(at)
                        parts.append(seq[q : q + m])
                        low, q, n = low + m, q + m, n - m
            taken = [rb.column(c).take(pa.array(which, pa.int64())) for c in passed]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(tiles, pa.int64()), pa.array(places, pa.int64()), pa.array(parts, pa.string())], [*passed, "tile", "at", "seq"])

    return run


def reference_side(tiles: DataFrame, broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """The tiles as a join side (_name, _tile, length, bases as bytes, which are cut without a walk over characters)."""
    side, _ = sized_side(tiles.select(F.col("name").alias("_name"), F.col("tile").alias("_tile"), "length", F.col("bases").cast("binary").alias("bases")), broadcast_max_bytes)
    return side


def reference_pieces(aln: DataFrame, side: DataFrame, passed: Sequence[str], tile: int = TILE, margin: int = MARGIN) -> DataFrame:
    """``passed`` and, for every aligned stretch in every tile: chrom, tile, at (0-based in the tile), ref (bytes), seq.

    ``aln``: chrom, pos (1-based), cigar, seq; ``side``: as from ``reference_side``, tiles with ``margin`` more bases on
    either side. Read bases past the reference's end are left out.
    """
    src = aln.select(*passed, "chrom", "pos", "cigar", "seq")
    kept = [*passed, "chrom"]
    schema = T.StructType([src.schema[c] for c in kept]).add("tile", "long").add("at", "long").add("seq", "string")
    b = src.mapInArrow(_cut_batches(kept, tile), schema)
    x = b.join(side, (F.col("chrom") == F.col("_name")) & (F.col("tile") == F.col("_tile")))
    left = (F.col("length") - F.col("tile") * tile - F.col("at")).cast("int")
    x = x.where((left > 0) & (F.length("seq") > 0)).withColumn("seq", F.substring("seq", F.lit(1), left))
    ref = F.substring("bases", (F.col("at") + 1 + margin).cast("int"), F.length("seq"))
    return x.select(*kept, "tile", "at", ref.alias("ref"), "seq")


# A1 -------------------------------------------------------------------------
def pileup_counts(aln: DataFrame, tiles: DataFrame, ref_base: str = "A", mut_base: str = "G", tier: Column | None = None,
                  tile: int = TILE, margin: int = MARGIN, broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Six-count pileup of gapped alignments at the reference's ``ref_base``, on both strands.

    u<t> counts reads that show ``ref_base`` (unconverted), m<t> those that show ``mut_base`` (converted), for tier t.
    On the strand "-" the complements are compared and the motif is reverse complemented. Input: sample, chrom, pos,
    flag, cigar, seq, yf, zf; unmapped, secondary, supplementary, failed and duplicate records are passed over.
    Output: sample, chrom, pos, strand, motif (31 bases, N beyond the reference), u0 u1 u2 m0 m1 m2. Motifs are cut
    from the tiles once the counts of a site are one row.
    """
    ref_base, mut_base = ref_base.upper(), mut_base.upper()
    tier = default_tier() if tier is None else tier
    side = reference_side(tiles, broadcast_max_bytes)
    rows = counted_records(aln).select("sample", "chrom", "pos", "cigar", "seq", tier.alias("tier"), fragment_strand().alias("strand"))
    pieces = reference_pieces(rows, side, ["sample", "tier", "strand"], tile, margin)
    c = pileup_partials(pieces, tile, {"+": (ref_base, mut_base), "-": (_COMPLEMENT[ref_base], _COMPLEMENT[mut_base])})
    g = c.groupBy("sample", "chrom", "pos", "strand").agg(*[F.sum(x).alias(x) for x in PILEUP_CELLS])
    x = g.withColumn("_t", F.expr(f"(pos - 1) div {tile}")).join(side, (F.col("chrom") == F.col("_name")) & (F.col("_t") == F.col("_tile")))
    around = F.substring("bases", (F.col("pos") - F.col("_t") * tile + margin - MOTIF_HALF).cast("int"), F.lit(2 * MOTIF_HALF + 1)).cast("string")
    motif = F.when(F.col("strand") == "+", around).otherwise(reverse_complement(around))
    return x.select("sample", "chrom", "pos", "strand", motif.alias("motif"), *PILEUP_CELLS)


# A15 ------------------------------------------------------------------------
def spike_counts(aln: DataFrame, tiles: DataFrame, prefix: str = "probe_", signal_pos: int = SIGNAL_POS,
                 tile: int = TILE, margin: int = MARGIN) -> DataFrame:
    """(sample, rate, is_signal, ref_base, read_base) -> pairs of aligned bases on the probes, by CIGAR.

    Reads whose Yf + Zf is at least the least support; ``is_signal`` marks the reference position ``signal_pos``.
    """
    rows = read_min_support(counted_records(aln, UNMAP)).where(F.col("chrom").startswith(prefix))
    pieces = reference_pieces(rows, reference_side(tiles), ["sample"], tile, margin)
    c = piece_partials(pieces, ["sample", "chrom", "tile"], tile)
    return c.groupBy("sample", probe_rate("chrom").alias("rate"), (F.col("pos") == signal_pos).alias("is_signal"), "ref_base", "read_base").agg(F.sum("n").alias("n"))


# J11 / O6 -----------------------------------------------------------------------
def binned_exons(exons: DataFrame, width: int) -> DataFrame:
    """(gene_name, bin) -> each transcript row's exons (four numbers each: tx_start, tx_end, g_start, g_end) that an alignment starting in the bin and spanning at most
    ``width`` can touch (those of the bin and the next one), with the transcript's length.

    A group holds the exons of two bins of one transcript, however long the transcript is.
    """
    ex = exons if "_tx_row" in exons.columns else exons.withColumn("_tx_row", F.lit(0))
    length = ex.groupBy("_tx_row", "gene_name").agg(F.max("tx_end").alias("tx_len")).withColumnRenamed("_tx_row", "_row").withColumnRenamed("gene_name", "_gene")
    ex = ex.join(length, (F.col("_tx_row") == F.col("_row")) & (F.col("gene_name") == F.col("_gene")))
    x = ex.select("*", F.explode(F.sequence(F.greatest(F.lit(0), F.expr(f"tx_start div {width} - 1")), F.expr(f"greatest(tx_end - 1, 0) div {width}"))).alias("bin"))
    return x.groupBy("gene_name", "ex_chrom", "ex_strand", "_tx_row", "tx_len", "bin").agg(
        F.flatten(F.transform(
            F.array_sort(F.collect_list(F.struct("tx_start", "tx_end", "g_start", "g_end"))),
            lambda e: F.array(e["tx_start"], e["tx_end"], e["g_start"], e["g_end"]))).alias("exons")
    ).drop("_tx_row")


def lift_cigar(cigar: str, start: int, exons, tx_len: int, plus: bool) -> tuple[int | None, str | None]:
    """(0-based genome start, genome CIGAR) of an alignment at the 0-based transcript position ``start``; nulls if no
    aligned base lies on the transcript.

    ``exons`` holds tx_start, tx_end, g_start, g_end of each exon in turn, by transcript position. What consumes the
    reference is cut at exon ends, a gap to the piece before becomes an intron; what lies past the transcript is clipped.
    """
    pieces: list[tuple[int, str, int | None]] = []  # length, operation, lowest genome position
    at, k = start, 0
    for n, op in operations(cigar):
        if op not in REF_OPS:
            pieces.append((n, "S" if op == "I" and at >= tx_len else op, None))
            continue
        end = at + n
        while at < min(end, tx_len):
            while k < len(exons) and exons[k + 1] <= at:
                k += 4
            stop = min(end, exons[k + 1])
            low = exons[k + 2] + at - exons[k] if plus else exons[k + 3] - (stop - exons[k])
            pieces.append((stop - at, op, low))
            at = stop
        if at < end and op in MATCH_OPS:
            pieces.append((end - at, "S", None))
        at = end
    if not any(low is not None and op in MATCH_OPS for _, op, low in pieces):
        return None, None
    out: list[list] = []
    first = last = None
    for n, op, low in pieces if plus else reversed(pieces):
        if low is not None:
            if last is not None and low > last:
                out.append([low - last, "N"])
            first, last = low if first is None else first, low + n
        if out and out[-1][1] == op:
            out[-1][0] += n
        else:
            out.append([n, op])
    return int(first), "".join(f"{n}{op}" for n, op in out)


def _lift_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        columns = (pdf[c] for c in ("cigar", "_s", "exons", "tx_len", "ex_strand"))
        got = [lift_cigar(c, s, e.tolist(), n, strand == "+") for c, s, e, n, strand in zip(*columns)]
        pdf = pdf.drop(columns=["cigar", "exons", "tx_len"])
        pdf["_low"] = pd.array([x[0] for x in got], dtype="Int64")
        pdf["cigar"] = [x[1] for x in got]
        yield pdf[pdf["cigar"].notna()]


def lift_alignments(tx_aln: DataFrame, exons: DataFrame, broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, least_width: int = 1000) -> DataFrame:
    """Transcript alignments in genome coordinates, introns as ``N``, all other columns as they were.

    Input: chrom (the gene), pos, flag, cigar, seq, qual and any others; ``exons`` as from ``exon_offsets``. Output: the
    same columns with chrom, pos and cigar of the genome, on "-" exons with sequence, qualities and operations turned
    round and the reverse flag flipped, and gene, strand (of the record), n_blocks (exons touched) besides. Alignments
    of unknown genes, unmapped ones and those wholly past the transcript are dropped; bases past its end are soft
    clipped. A gene listed twice lifts an alignment twice.

    An alignment meets only the exons of the bin it starts in and the next: an equi-join on (gene, bin), broadcast when
    the bytes allow it and else shuffled, where adaptive execution can split a hot gene. Bins are as wide as the
    longest alignment at least, so that two always do.
    """
    others = [c for c in tx_aln.columns if c not in ("chrom", "pos", "flag", "cigar", "seq", "qual", "strand", "gene", "n_blocks", "ops")]
    a = tx_aln.where(~bit("flag", UNMAP)).select(*others, F.col("chrom").alias("gene"), (F.col("pos").cast("bigint") - 1).alias("_s"), "flag", "cigar", "seq", "qual")
    # no alignment spans more than all its operations together
    numbers = F.transform(F.regexp_extract_all("cigar", F.lit("([0-9]+)")), lambda n: n.cast("bigint"))
    longest = a.select("cigar").distinct().agg(F.max(F.aggregate(numbers, F.lit(0).cast("bigint"), lambda x, y: x + y))).first()[0]
    width = max(least_width, longest or 0)
    side, _ = sized_side(binned_exons(exons, width), broadcast_max_bytes)
    x = a.join(side, (F.col("gene") == F.col("gene_name")) & (F.expr(f"_s div {width}") == F.col("bin"))).drop("gene_name", "bin")
    schema = T.StructType([f for f in x.schema.fields if f.name not in ("cigar", "exons", "tx_len")]).add("_low", "long").add("cigar", "string")
    x = x.mapInPandas(_lift_batches, schema)
    minus = F.col("ex_strand") != "+"
    flag = F.when(minus, F.col("flag").bitwiseXOR(F.lit(REVERSE))).otherwise(F.col("flag"))
    return x.select(
        *others, "gene", F.col("ex_chrom").alias("chrom"), (F.col("_low") + 1).alias("pos"), flag.alias("flag"), "cigar",
        F.when(minus, reverse_complement("seq")).otherwise(F.col("seq")).alias("seq"), F.when(minus, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"),
        F.when(flag.bitwiseAND(F.lit(REVERSE)) != 0, F.lit("-")).otherwise(F.lit("+")).alias("strand"),
        (F.regexp_count("cigar", F.lit("N")) + 1).cast("bigint").alias("n_blocks"),
    )


def union_lifted(lifted: DataFrame, genome: DataFrame, keys: Sequence[str] = ("sample", "chrom", "pos", "read_id", "flag", "cigar")) -> DataFrame:
    """Lifted and genome alignments as one coordinate-sorted table; columns of one side only are null on the other."""
    return lifted.unionByName(genome, allowMissingColumns=True).orderBy(*keys)
