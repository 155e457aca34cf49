"""Stand-in inputs derived by SQL from the driver's TPC-H-like tables.

Each derivation is one SQL template run by Spark (``spark.sql`` with the
parquet tables as DataFrame arguments) and inlined by the DuckDB oracle as a
CTE.  Derivations only produce rows in the schema a job expects; they do none
of the job's work.  All of them read whole tables (no id subsets, no modulo
filters): their size grows with the scale factor.

Spark materialises a derivation once per session and scale-factor directory as
Parquet under the shared checkpoint folder, so queries read it like any other
input table. Tables of reads and their alignments (``AS_READ``), one row or two of
lineitem's, are derived while they are read instead: a copy of their strings costs
more than all else, and columns that a query leaves out are not spelt.

Rules that spell a string base by base (``LETTERS``) repeat in their two
numbers.  DuckDB gets them as one long expression; Spark takes whole strings
from a small table of all of them, as the compiler leaves a method of hundreds
of substrings to the interpreter. Those that follow the genome (``STRETCHES``)
are cut from a table of its letters; numbers that the table leaves out, null or
below zero, follow the rule itself.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from sitecall.session import scratch_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Five 53-base spike-in probes of our own: a common head, NNANN around the signal base, a barcode a rate, a common tail.
_BARCODES = {0: "CCTTGGAACT", 25: "GATTACCAGA", 50: "TGAGGCTTCA", 75: "ACCGATATGC", 100: "CGTACTAGGT"}
PROBES = {rate: f"GCATTGACGTCAATCNNANN{barcode}TTCAGCATTGGCAAGTCTGCATT" for rate, barcode in _BARCODES.items()}
MOTIF_LEN = 31
TARGET_INDEX = 15

# Sample design used by the registered queries.
SAMPLES = ("s0", "s1", "s2", "s3")
REQUIRED = ("s1", "s2", "s3")
OPTIONAL = ("s0",)
GROUPS = (("g1", ("s0", "s1")), ("g2", ("s2", "s3")))
POOLED_RENAME = {"s2": "s1-p-1", "s3": "s1-p-2"}


def seq_expr(a: str, b: str, n: int, alphabet: str = "ACGT", mult: int = 3, fixed: dict[int, str] | None = None) -> str:
    """n characters drawn from ``alphabet`` by a fixed rule of (a, b), but for the places in ``fixed``."""
    k = len(alphabet)
    parts = [
        f"'{fixed[i]}'" if fixed and i in fixed
        else f"substr('{alphabet}', cast((({a}) * {mult * (2 * i + 3)} + {i * i * 7} + ({b}) * 11) % 97 % {k} + 1 as int), 1)"
        for i in range(n)
    ]
    return "concat(" + ", ".join(parts) + ")"


def seq_words(n: int, alphabet: str = "ACGT", mult: int = 3, fixed: dict[int, str] | None = None) -> list[str]:
    """The strings of ``seq_expr`` for a, b = 0 .. 96, at a * 97 + b: its rule repeats from there on."""
    k = len(alphabet)
    at = [(mult * (2 * i + 3), i * i * 7, (fixed or {}).get(i)) for i in range(n)]
    return ["".join(c or alphabet[(a * m + add + b * 11) % 97 % k] for m, add, c in at) for a in range(97) for b in range(97)]


def seq_lookup(words: str, a: str, b: str, n: int, alphabet: str = "ACGT", mult: int = 3, fixed: dict[int, str] | None = None) -> str:
    """``seq_expr`` in Spark SQL, with the array of ``seq_words`` given as ``words``; below zero the rule itself is followed."""
    letter = f"substr('{alphabet}', cast((({a}) * {mult} * (2 * i + 3) + i * i * 7 + ({b}) * 11) % 97 % {len(alphabet)} + 1 as int), 1)"
    for i, c in (fixed or {}).items():
        letter = f"case when i = {i} then '{c}' else {letter} end"
    return (
        f"case when ({a}) >= 0 and ({b}) >= 0 then element_at({words}, cast(({a}) % 97 * 97 + ({b}) % 97 + 1 as int)) "
        f"when ({a}) is not null and ({b}) is not null then array_join(transform(sequence(0, {n - 1}), i -> {letter}), '') end"
    )


def motif_expr(a: str, b: str) -> str:
    """31-character motif; 'A' at index 15, other bases from (a, b)."""
    return seq_expr(a, b, MOTIF_LEN, mult=1, fixed={TARGET_INDEX: "A"})


def probe_read_expr(ref: str, ok: str, ln: str, rate: str) -> str:
    """53-base read aligned base-for-base to ``ref`` (ungapped)."""
    parts = []
    for i in range(len(PROBES[0])):
        r = f"substr({ref}, {i + 1}, 1)"
        sig = f"when {r} = 'A' and {i} = 17 then (case when (({ok}) * 37 + ({ln}) * 11) % 100 < {rate} then 'A' else 'G' end) "
        parts.append(
            "(case "
            + (sig if i == 17 else "")
            + f"when {r} = 'A' then (case when (({ok}) * 7 + {i}) % 50 = 0 then 'A' else 'G' end) "
            f"when {r} = 'C' then (case when (({ok}) + {i * 3}) % 200 = 0 then 'T' else 'C' end) "
            f"else {r} end)"
        )
    return "concat(" + ", ".join(parts) + ")"


def probe_words() -> list[str]:
    """The reads of ``probe_read_expr`` but for the signal base: by rate, for ok = 0 .. 199, which repeat, and ok = null."""
    def letter(r: str, ok: int | None, i: int) -> str:
        if r == "A":
            return "A" if ok is not None and (ok * 7 + i) % 50 == 0 else "G"
        if r == "C":
            return "T" if ok is not None and (ok + i * 3) % 200 == 0 else "C"
        return r

    return ["".join(letter(r, ok, i) for i, r in enumerate(ref)) for ref in PROBES.values() for ok in (*range(200), None)]


def probe_read_lookup(words: str, ref: str, ok: str, ln: str, rate: str) -> str:
    """``probe_read_expr`` in Spark SQL, with the array of ``probe_words`` given as ``words``."""
    places = " ".join(f"when {r} then {k}" for k, r in enumerate(PROBES))
    word = f"element_at({words}, cast((case {rate} {places} end) * 201 + coalesce(pmod({ok}, 200), 200) + 1 as int))"
    signal = f"case when (({ok}) * 37 + ({ln}) * 11) % 100 < {rate} then 'A' else 'G' end"
    return f"case when {ref} is not null then concat(substr({word}, 1, 17), {signal}, substr({word}, 19)) end"


# ---------------------------------------------------------------- templates
# ``{lineitem}`` etc. are table placeholders; ``//`` is integer division; the names in LETTERS stand for spelt strings.

_SITE_COUNTS = """
select sample, chrom, pos, strand, {motif} as motif, depth, uncon from (
 select sample, chrom, pos, strand, any_value(sk) as sk, cast(sum(q) as bigint) as depth,
  cast(sum(case when pos % 17 = 0 then (q * (40 + ok % 20)) // 100 when ok % 29 = 0 then q // 10 else 0 end) as bigint) as uncon
 from (select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
   concat('chr', cast(l_suppkey % 5 + 1 as varchar(8))) as chrom, l_partkey as pos,
   case when l_linestatus = 'O' then '+' else '-' end as strand, cast(l_quantity as bigint) as q,
   l_orderkey as ok, l_suppkey % 5 as sk from {lineitem}) x
 group by sample, chrom, pos, strand) y
"""

_ALIGNMENTS = """
select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
 concat('run', cast(l_orderkey % 2 + 1 as varchar(8))) as run,
 concat('r', cast(l_orderkey as varchar(20)), '_', cast(l_suppkey % 3 as varchar(20))) as read_id,
 case when l_partkey % 10 = 0 then 'contamination' when l_partkey % 10 = 1 then 'genes'
      when l_partkey % 10 < 7 then 'transcript' else 'genome' end as reftype,
 concat('chr', cast(l_suppkey % 5 + 1 as varchar(8))) as chrom, l_partkey as pos,
 case when l_linestatus = 'O' then '+' else '-' end as strand,
 cast(case (l_orderkey + l_linenumber) % 12 when 0 then 4 when 1 then 355 when 2 then 147 when 3 then 163 when 4 then 1123
      when 5 then 2147 when 6 then 0 when 7 then 16 when 8 then 83 else 99 end as bigint) as flag,
 cast(40 + l_partkey % 80 as bigint) as qlen, cast(l_suppkey % 20 as bigint) as sclen,
 cast(case when l_linenumber = 7 then null else l_linenumber % 7 end as bigint) as xm,
 cast(l_suppkey % 6 as bigint) as ns, cast(l_partkey % 9 as bigint) as nc,
 concat(substr('ACGT', cast(l_orderkey % 4 + 1 as int), 1), substr('ACGT', cast(l_suppkey % 4 + 1 as int), 1)) as umi,
 cast(l_quantity * 8 as bigint) as isize, cast(l_quantity as bigint) as mapq
from {lineitem}
"""

# Aligner output for the clipped reads: one record a fragment, by its id; some are unmapped or rejected.
_READ_ALIGNMENTS = _ALIGNMENTS.replace(
    "concat('r', cast(l_orderkey as varchar(20)), '_', cast(l_suppkey % 3 as varchar(20)))",
    "concat('f', cast(l_orderkey as varchar(20)), '_', cast(l_linenumber as varchar(8)))",
)

_TRANSCRIPTS = """
select concat('G', cast(p_partkey as varchar(20))) as gene_id,
 concat('chr', cast(p_partkey % 5 + 1 as varchar(8))) as chrom,
 case when p_partkey % 2 = 0 then '+' else '-' end as strand,
 case when p_partkey % 2 = 0
  then concat(cast(p_partkey * 7 + 1 as varchar(20)), '-', cast(p_partkey * 7 + 60 as varchar(20)), ',',
              cast(p_partkey * 7 + 101 as varchar(20)), '-', cast(p_partkey * 7 + 160 as varchar(20)))
  else concat(cast(p_partkey * 7 + 101 as varchar(20)), '-', cast(p_partkey * 7 + 160 as varchar(20)), ',',
              cast(p_partkey * 7 + 1 as varchar(20)), '-', cast(p_partkey * 7 + 60 as varchar(20))) end as spans
from {part}
"""

_TRANSCRIPT_COUNTS = """
select sample, chrom, pos, '+' as strand, {motif} as motif, depth, uncon from (
 select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
  concat(case when l_suppkey % 10 = 0 then 'U' else 'G' end, cast(l_partkey as varchar(20))) as chrom,
  l_partkey as g, cast(l_suppkey % 100 + l_linenumber * 5 as bigint) as pos,
  cast(sum(cast(l_quantity as bigint)) as bigint) as depth,
  cast(sum(case when l_partkey % 17 = 0 then cast(l_quantity as bigint) - 1 else 0 end) as bigint) as uncon
 from {lineitem} group by 1, 2, 3, 4) z
"""

_PROBE_READS = """
select sample, concat('probe_', cast(rate as varchar(8))) as reference, read_id, ref_seq, {seq} as seq, yf, zf from (
 select *, case rate {cases} end as ref_seq
 from (select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample, (l_suppkey % 5) * 25 as rate,
   concat('r', cast(l_orderkey as varchar(20)), '_', cast(l_suppkey as varchar(20)), '_', cast(l_linenumber as varchar(8))) as read_id,
   l_orderkey as ok, l_linenumber as ln, cast(l_partkey % 12 as bigint) as yf, cast(l_suppkey % 4 as bigint) as zf
  from {lineitem}) a) b
""".replace("{cases}", " ".join(f"when {k} then '{v}'" for k, v in PROBES.items()))

# Six-count header layout of the same sites: tiers spread over 0/1/2.  Sites at
# pos % 11 = 0 carry only tier-0 counts (depth 0 after P1), pos % 13 = 0 get an
# N inside the 3-mer, pos % 19 = 0 a non-target centre base.
_PILEUP_TIERS = """
select sample, chrom, pos, strand,
 case when pos % 13 = 0 then concat(substr(motif, 1, 14), 'N', substr(motif, 16))
      when pos % 19 = 0 then concat(substr(motif, 1, 15), 'C', substr(motif, 17))
      else motif end as motif,
 case when pos % 11 = 0 then uncon else uncon % 5 end as u0,
 case when pos % 11 = 0 then 0 else uncon - uncon // 3 end as u1,
 case when pos % 11 = 0 then 0 else uncon // 3 end as u2,
 case when pos % 11 = 0 then depth - uncon else (depth - uncon) % 7 end as m0,
 case when pos % 11 = 0 then 0 else (depth - uncon) - (depth - uncon) // 2 end as m1,
 case when pos % 11 = 0 then 0 else (depth - uncon) // 2 end as m2
from {site_counts}
"""

QUAL_ALPHABET = "56789:;<=>?@ABCDEFGHI"
ADAPTER = "AGATCGGAAGAGC"  # public Illumina universal adapter prefix
READ_LEN = 60

# Raw reads (before clipping): every lineitem row is one fragment; the samples
# with odd line numbers are paired-end (an R2 row per fragment).  R1 carries a
# 3' adapter after an insert of 6-55 bases unless orderkey % 3 = 0.
_READS = """
select sample, run, 'R1' as mate, read_id,
 substr(concat(substr(b1, 1, ins), case when has_ad then '{adapter}' else '' end, b1), 1, {n}) as seq, q1 as qual
from (select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
  concat('run', cast(l_orderkey % 2 + 1 as varchar(8))) as run,
  concat('f', cast(l_orderkey as varchar(20)), '_', cast(l_linenumber as varchar(8))) as read_id,
  cast(l_quantity as bigint) + 5 as ins, l_orderkey % 3 <> 0 as has_ad,
  {b1} as b1, {q1} as q1 from {lineitem}) x
union all
select sample, run, 'R2' as mate, read_id, b2 as seq, q2 as qual
from (select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
  concat('run', cast(l_orderkey % 2 + 1 as varchar(8))) as run,
  concat('f', cast(l_orderkey as varchar(20)), '_', cast(l_linenumber as varchar(8))) as read_id,
  {b2} as b2, {q2} as q2 from {lineitem} where l_linenumber % 2 = 1) y
""".replace("{adapter}", ADAPTER).replace("{n}", str(READ_LEN))

# Trimmer JSON reports per (sample, run), pretty-printed; run2 reports a zero
# primary percentage so the fallback path is used.
_TRIM_REPORTS = """
select sample, run, n_in, n_out, concat('{', chr(10),
 '  "filtering_statistics": {', chr(10),
 '    "input": ', cast(n_in as varchar(20)), ',', chr(10),
 '    "output": ', cast(n_out as varchar(20)), ',', chr(10),
 '    "percent_trimmed": ', cast(p1 as varchar(20)), chr(10),
 '  },', chr(10),
 '  "report": {"summary": {"terminal_stats": {"percent_trimmed": ', cast(p2 as varchar(20)), '}}}', chr(10),
 '}') as report
from (select sample, run, n_in, n_out,
  cast(case when run = 'run2' then 0 else round(100.0 * n_short / n_in, 2) end as decimal(10, 2)) as p1,
  cast(round(100.0 * n_disc / n_in, 2) as decimal(10, 2)) as p2
 from (select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
   concat('run', cast(l_orderkey % 2 + 1 as varchar(8))) as run,
   cast(count(*) as bigint) as n_in, cast(sum(case when l_quantity > 3 then 1 else 0 end) as bigint) as n_out,
   sum(case when l_quantity < 10 then 1 else 0 end) as n_short, sum(case when l_discount > 0.05 then 1 else 0 end) as n_disc
  from {lineitem} group by 1, 2) a) b
"""

# Dedup tool logs per (sample, reference type), numbers with thousands
# separators; (s0, contamination) has no total line and must be skipped.
_DEDUP_LOGS = """
select sample, reftype, concat('Deduplicating alignments', chr(10),
 case when sample = 's0' and reftype = 'contamination' then '' else concat('Total reads processed: ', fmt_thousands(total), chr(10)) end,
 'Duplicates removed: ', fmt_thousands(dups), chr(10),
 'Total Unique Reads: ', fmt_thousands(total - dups), chr(10),
 'Deduplication rate: ', cast(cast(round(100.0 * dups / total, 2) as decimal(10, 2)) as varchar(20)), '%', chr(10)) as log
from (select sample, reftype, cast(count(*) as bigint) * 40 as total,
  cast(sum(case when mapq < 8 then 1 else 0 end) as bigint) * 40 as dups from {alignments} group by 1, 2) a
"""

# Alignments in transcript coordinates (for lifting whole alignments).
_TX_ALIGNMENTS = """
select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample,
 concat('a', cast(l_orderkey as varchar(20)), '_', cast(l_linenumber as varchar(8))) as read_id,
 concat(case when l_suppkey % 10 = 0 then 'U' else 'G' end, cast(l_partkey as varchar(20))) as gene,
 cast(l_suppkey % 100 + 1 as bigint) as tx_pos, cast(20 + l_quantity as bigint) as aln_len
from {lineitem}
"""

# A reference genome: every part adds 50 bases to one of five chromosomes; the base is a rule of (chromosome, 0-based position).
SEGMENT = 50


def base_rule(c: str, x: str) -> str:
    return f"substr('ACGT', cast((({x}) * 7 + ({x}) // 11 * 5 + (({x}) % 13) * (({x}) % 7) + ({c}) * 3) % 97 % 4 + 1 as int), 1)"


_GENOME_SEGMENTS = """
select concat('chr', cast(c as varchar(8))) as chrom, seg, EACH50(at := {at}; {base}) as bases
from (select cast((p_partkey - 1) % 5 + 1 as bigint) as c, cast((p_partkey - 1) // 5 as bigint) as seg from {part}) x
""".replace("{at}", f"seg * {SEGMENT} + i").replace("{base}", base_rule("c", "at"))

# Gapped alignments to that genome, one a lineitem row: clips, insertions, deletions, a splice, = and X, both strands, mates,
# unmapped, secondary and duplicate records. ``off`` is the reference offset of base i of the read, null where it has none.
_CIGARS = ("48M", "3S45M", "20M2I26M", "24M3D24M", "5S18M1I12M2D12M", "2H40M6S", "16M500N32M", "4=1X20=23M")
_SAM_OFFSET = (
    "case v when 0 then i when 1 then (case when i >= 3 then i - 3 end) when 2 then (case when i < 20 then i when i >= 22 then i - 2 end) "
    "when 3 then (case when i < 24 then i else i + 3 end) "
    "when 4 then (case when i < 5 then null when i < 23 then i - 5 when i < 24 then null when i < 36 then i - 6 else i - 4 end) "
    "when 5 then (case when i < 40 then i end) when 6 then (case when i < 16 then i else i + 500 end) else i end"
)


_QUAL_LETTER = f"substr('{QUAL_ALPHABET}', cast((ok * 3 + i * 5) % {len(QUAL_ALPHABET)} + 1 as int), 1)"
_TX_LETTER = "substr('ACGT', cast((ok * (i + 1) + i * i + ln) % 4 + 1 as int), 1)"


def _sam_base() -> str:
    """Read base i: converted A (T on the reverse strand) but for one in five, now and then N, its own letter where not aligned."""
    return (
        f"at := x0 + {_SAM_OFFSET}; ref := {base_rule('c', 'at')}; "
        "(case when at is null then substr('ACGT', cast((ok + i * 3) % 4 + 1 as int), 1) when (ok + i * 3) % 97 = 0 then 'N' "
        "when v = 7 and i = 4 then 'T' "
        "when not minus and ref = 'A' then (case when (ok * 7 + i) % 5 = 0 then 'A' else 'G' end) "
        "when minus and ref = 'T' then (case when (ok * 7 + i) % 5 = 0 then 'T' else 'C' end) else ref end)"
    )


_SAM_RECORDS = """
select sample, run, reftype, read_id, flag, case when unmapped then '*' else concat('chr', cast(c as varchar(8))) end as chrom,
 case when unmapped then 0 else x0 + 1 end as pos, mapq, case when unmapped then '*' else {cigars} end as cigar,
 case when (flag & 1) = 0 then '*' when ok % 7 = 0 then 'chr2' else '=' end as rnext,
 case when (flag & 1) = 0 then 0 else x0 + 1 + ok % 200 end as pnext, isize,
 case when ok % 50 = 0 and unmapped then '*' else substr(EACH48({read}), 1, case when v = 5 and not unmapped then 46 else 48 end) end as seq,
 case when ok % 50 = 0 then '*' else substr(EACH48({qual}), 1, case when v = 5 and not unmapped then 46 else 48 end) end as qual,
 xm, xm_text, ns, nc, umi, yf, zf
from (select *, (flag & 4) <> 0 as unmapped, ((flag & 16) <> 0) <> ((flag & 129) = 129) as minus from (
 select concat('s', cast(l_linenumber % 4 as varchar(8))) as sample, concat('run', cast(l_orderkey % 2 + 1 as varchar(8))) as run,
  case when l_partkey % 3 = 0 then 'transcript' else 'genome' end as reftype,
  concat('q', cast(l_orderkey as varchar(20)), '_', cast(l_suppkey % 3 as varchar(20))) as read_id,
  cast(case (l_orderkey + l_linenumber) % 12 when 0 then 4 when 1 then 355 when 2 then 147 when 3 then 163 when 4 then 1123
       when 5 then 2147 when 6 then 0 when 7 then 16 when 8 then 83 else 99 end as bigint) as flag,
  cast((l_partkey - 1) % 5 + 1 as bigint) as c, cast((l_partkey - 1) // 5 * 50 + l_suppkey % 50 as bigint) as x0,
  cast(l_quantity as bigint) as mapq, cast((l_orderkey + l_linenumber * 3 + l_suppkey) % 8 as bigint) as v, cast(l_orderkey as bigint) as ok,
  cast(l_quantity * 8 as bigint) as isize,
  cast(case when l_linenumber >= 6 then null else l_linenumber % 7 end as bigint) as xm, l_linenumber = 6 as xm_text,
  cast(l_suppkey % 6 as bigint) as ns, cast(l_partkey % 9 as bigint) as nc,
  concat(substr('ACGT', cast(l_orderkey % 4 + 1 as int), 1), substr('ACGT', cast(l_suppkey % 4 + 1 as int), 1)) as umi,
  cast(case when l_partkey % 31 = 0 then null else l_partkey % 12 end as bigint) as yf, cast(l_suppkey % 4 as bigint) as zf
 from {lineitem}) a) b
""".replace("{cigars}", "case v " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(_CIGARS[:-1])) + f" else '{_CIGARS[-1]}' end").replace(
    "{read}", _sam_base()).replace("{qual}", _QUAL_LETTER)


_GAP_COLUMNS = """cast((l_orderkey + l_linenumber * 3 + l_suppkey) % 8 as bigint) as v, cast(l_orderkey as bigint) as ok, cast(l_linenumber as bigint) as ln,
  concat('s', cast(l_linenumber % 4 as varchar(8))) as sample, cast(l_partkey % 12 as bigint) as yf, cast(l_suppkey % 4 as bigint) as zf"""


def _cigar_case(cigars) -> str:
    return "case v " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(cigars[:-1])) + f" else '{cigars[-1]}' end"


# Gapped alignments in transcript coordinates; some reach past the transcript's 120 bases, a tenth are of unknown genes.
TX_CIGARS = (*_CIGARS[:6], "16M40D32M", _CIGARS[7])
_TX_SAM_RECORDS = """
select sample, read_id, chrom, pos, flag, {cigars} as cigar, substr(EACH48({letter}), 1, case when v = 5 then 46 else 48 end) as seq,
 substr(EACH48({qual}), 1, case when v = 5 then 46 else 48 end) as qual, yf, zf
from (select {columns}, concat('t', cast(l_orderkey as varchar(20)), '_', cast(l_linenumber as varchar(8))) as read_id,
  concat(case when l_suppkey % 10 = 0 then 'U' else 'G' end, cast(l_partkey as varchar(20))) as chrom, cast(l_suppkey % 100 + 1 as bigint) as pos,
  cast(case l_orderkey % 3 when 0 then 0 when 1 then 16 else 4 * (l_linenumber % 2) end as bigint) as flag from {lineitem}) a
""".replace("{columns}", _GAP_COLUMNS).replace("{cigars}", _cigar_case(TX_CIGARS)).replace("{letter}", _TX_LETTER).replace("{qual}", _QUAL_LETTER)

# Gapped alignments to the spike-in probes, from their first bases on.
PROBE_CIGARS = (*_CIGARS[:6], "16M1D32M", _CIGARS[7])
_PROBE_OFFSET = _SAM_OFFSET.replace("i + 500", "i + 1")
_PROBE_READ = (
    f"at := x0 + {_PROBE_OFFSET}; ref := substr(ref_seq, cast(at + 1 as int), 1); "
    "(case when at is null then 'A' when ref = 'A' and at = 17 then (case when (ok * 37 + ln * 11) % 100 < rate then 'A' else 'G' end) "
    "when ref = 'A' then (case when (ok * 7 + i) % 50 = 0 then 'A' else 'G' end) when ref = 'C' then (case when (ok + i * 3) % 200 = 0 then 'T' else 'C' end) else ref end)"
)
_PROBE_SAM_RECORDS = """
select sample, concat(case when ok % 9 = 0 then 'rrna_' else 'probe_' end, cast(rate as varchar(8))) as chrom, x0 + 1 as pos, cast(case when ok % 13 = 0 then 4 else 0 end as bigint) as flag, {cigars} as cigar,
 substr(EACH48({read}), 1, case when v = 5 then 46 else 48 end) as seq, yf, zf
from (select *, case rate {cases} end as ref_seq from (select {columns}, (l_suppkey % 5) * 25 as rate, cast(l_partkey % 3 as bigint) as x0 from {lineitem}) a) b
""".replace("{columns}", _GAP_COLUMNS).replace("{cigars}", _cigar_case(PROBE_CIGARS)).replace("{read}", _PROBE_READ).replace(
    "{cases}", " ".join(f"when {k} then '{v}'" for k, v in PROBES.items()))


# name -> (template, base tables, fixture dependencies)
TEMPLATES = {
    "site_counts": (_SITE_COUNTS, ("lineitem",), ()),
    "alignments": (_ALIGNMENTS, ("lineitem",), ()),
    "read_alignments": (_READ_ALIGNMENTS, ("lineitem",), ()),
    "transcripts": (_TRANSCRIPTS, ("part",), ()),
    "transcript_counts": (_TRANSCRIPT_COUNTS, ("lineitem",), ()),
    "probe_reads": (_PROBE_READS, ("lineitem",), ()),
    "pileup_tiers": (_PILEUP_TIERS, (), ("site_counts",)),
    "reads": (_READS, ("lineitem",), ()),
    "trim_reports": (_TRIM_REPORTS, ("lineitem",), ()),
    "dedup_logs": (_DEDUP_LOGS, (), ("alignments",)),
    "tx_alignments": (_TX_ALIGNMENTS, ("lineitem",), ()),
    "genome_segments": (_GENOME_SEGMENTS, ("part",), ()),
    "sam_records": (_SAM_RECORDS, ("lineitem",), ()),
    "tx_sam_records": (_TX_SAM_RECORDS, ("lineitem",), ()),
    "probe_sam_records": (_PROBE_SAM_RECORDS, ("lineitem",), ()),
}


# row by row from a base table, without a shuffle: derived as they are read, not written first
AS_READ = ("reads", "read_alignments", "probe_reads", "sam_records", "tx_sam_records")

# name -> placeholder -> (a, b, and the rest of seq_expr's arguments)
_MOTIF = {"n": MOTIF_LEN, "mult": 1, "fixed": {TARGET_INDEX: "A"}}
_QUAL = {"n": READ_LEN, "alphabet": QUAL_ALPHABET, "mult": 1}
LETTERS = {
    "site_counts": {"motif": ("pos", "sk", _MOTIF)},
    "transcript_counts": {"motif": ("pos + 13 * g", "g % 5", _MOTIF)},
    "reads": {
        "b1": ("l_orderkey", "l_partkey", {"n": 80}), "q1": ("l_orderkey", "l_suppkey", _QUAL),
        "b2": ("l_orderkey + 7", "l_partkey + 3", {"n": READ_LEN}), "q2": ("l_orderkey + 5", "l_suppkey", _QUAL),
    },
}
PROBE_READ = ("ref_seq", "ok", "ln", "rate")

# ``base_rule`` repeats in its position after so many bases; its letters lie in tiles, each with as many more as a segment or read has.
PERIOD = 7 * 11 * 13 * 97
STRETCH_TILE = 256
_TILES = -(-PERIOD // STRETCH_TILE)


def _genome_letters(c: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, letters as bytes) of one chromosome, a period and a tile's stretch more."""
    x = np.arange(PERIOD + 2 * STRETCH_TILE, dtype=np.int64)
    return x, np.frombuffer(b"ACGT", dtype=np.uint8)[(x * 7 + x // 11 * 5 + (x % 13) * (x % 7) + c * 3) % 97 % 4]


def _tiles_of(letters: np.ndarray) -> list[str]:
    text = letters.tobytes().decode()
    return [text[t * STRETCH_TILE : (t + 1) * STRETCH_TILE + SEGMENT] for t in range(_TILES)]


@lru_cache(maxsize=1)
def genome_words() -> list[str]:
    """Tiles of the chromosomes 1 to 5."""
    return [w for c in range(1, 6) for w in _tiles_of(_genome_letters(c)[1])]


@lru_cache(maxsize=1)
def read_words() -> list[str]:
    """The same as reads show them: by chromosome, strand (+, -) and the k = 0 .. 4 for which the target base stays as it is where (k + position) % 5 = 0."""
    out = []
    for c in range(1, 6):
        x, letters = _genome_letters(c)
        for target, converted in ("AG", "TC"):
            for k in range(5):
                out += _tiles_of(np.where((letters == ord(target)) & ((k + x) % 5 != 0), np.uint8(ord(converted)), letters))
    return out


def _texts(letter, n: int, rows) -> str:
    return "array(" + ", ".join("'" + "".join(letter(*row, i) for i in range(n)) + "'" for row in rows) + ")"


# Stretches of a read by v, as in _SAM_OFFSET: first base, offset on the reference and length of the three aligned ones, first base and length of the
# two that are not; the first unaligned one stands before the others, the second after the first aligned one.
_SAM_ALIGNED = (
    [(0, 0, 48)], [(3, 0, 45)], [(0, 0, 20), (22, 20, 26)], [(0, 0, 24), (24, 27, 24)], [(5, 0, 18), (24, 18, 12), (36, 32, 12)], [(0, 0, 40)], [(0, 0, 16), (16, 516, 32)], [(0, 0, 48)],
)
_SAM_OTHERS = ([], [(0, 3)], [(0, 0), (20, 2)], [], [(0, 5), (23, 1)], [(0, 0), (40, 8)], [], [])


def _sam_read(words: str) -> str:
    """``_sam_base`` for all bases in Spark SQL, with the array of ``read_words`` given as ``words``."""
    def by_v(stretches, k: int, field: int) -> str:
        numbers = (str(x[k][field] if k < len(x) else 0) for x in stretches)
        return f"element_at(array({', '.join(numbers)}), cast(v + 1 as int))"

    clipped = f"element_at({_texts(lambda m, i: 'ACGT'[(m + i * 3) % 4], 48, [(m,) for m in range(4)])}, cast(ok % 4 + 1 as int))"

    def other(k: int) -> str:
        return f"substr({clipped}, {by_v(_SAM_OTHERS, k, 0)} + 1, {by_v(_SAM_OTHERS, k, 1)})"

    def aligned(k: int) -> str:
        first, offset, size = (by_v(_SAM_ALIGNED, k, field) for field in range(3))
        at = f"((x0 + {offset}) % {PERIOD})"
        as_read = f"((c - 1) * 2 + case when minus then 1 else 0 end) * 5 + pmod(ok * 7 + {first} - {at}, 5)"
        return f"substr(element_at({words}, cast(({as_read}) * {_TILES} + {at} div {STRETCH_TILE} + 1 as int)), cast({at} % {STRETCH_TILE} + 1 as int), {size})"

    bases = f"concat({other(0)}, {aligned(0)}, {other(1)}, {aligned(1)}, {aligned(2)})"
    bases = f"overlay({bases} placing case when v = 7 then 'T' else '' end from 5 for case when v = 7 then 1 else 0 end)"
    n = "cast(ok % 97 * 32 % 97 as int)"  # the base for which (ok + i * 3) % 97 = 0
    inside = " or ".join(f"{n} >= {by_v(_SAM_ALIGNED, k, 0)} and {n} < {by_v(_SAM_ALIGNED, k, 0)} + {by_v(_SAM_ALIGNED, k, 2)}" for k in range(3))
    return f"overlay({bases} placing case when {inside} then 'N' else '' end from {n} + 1 for case when {inside} then 1 else 0 end)"


def _segment(words: str) -> str:
    at = f"((seg * {SEGMENT}) % {PERIOD})"
    return f"substr(element_at({words}, cast((c - 1) * {_TILES} + {at} div {STRETCH_TILE} + 1 as int)), cast({at} % {STRETCH_TILE} + 1 as int), {SEGMENT})"


# name -> (rule of the template, numbers that the table has, text in Spark SQL by the words of that name, words)
_QUALITY = (f"EACH48({_QUAL_LETTER})", "ok >= 0", f"element_at({_texts(lambda m, i: QUAL_ALPHABET[(m * 3 + i * 5) % 21], 48, [(m,) for m in range(7)])}, cast(ok % 7 + 1 as int))")
STRETCHES = {
    "genome_segments": [(f"EACH50(at := seg * {SEGMENT} + i; {base_rule('c', 'at')})", "seg >= 0 and c >= 1 and c <= 5", _segment)],
    "sam_records": [(f"EACH48({_sam_base()})", "x0 >= 0 and ok >= 0 and c >= 1 and c <= 5 and v >= 0 and v <= 7 and minus is not null", _sam_read), _QUALITY],
    "tx_sam_records": [
        (f"EACH48({_TX_LETTER})", "ok >= 0 and ln >= 0",
         f"element_at({_texts(lambda m, k, i: 'ACGT'[(m * (i + 1) + i * i + k) % 4], 48, [(m, k) for m in range(4) for k in range(4)])}, cast(ok % 4 * 4 + ln % 4 + 1 as int))"),
        _QUALITY,
    ],
}
STRETCH_WORDS = {"genome_segments": genome_words, "sam_records": read_words}


def _deps(name: str, seen: list[str]) -> list[str]:
    for d in TEMPLATES[name][2]:
        _deps(d, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _each(text: str, form) -> str:
    """Replace ``EACH<n>(x := a; r := b; e)`` by ``form(n, [(x, a), (r, b)], e)``: the text of e for i = 0 .. n - 1, with
    the values named before it computed once."""
    while m := re.search(r"EACH(\d+)\(", text):
        depth, end = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        *named, e = (part.strip() for part in text[m.end() : end - 1].split("; "))
        text = text[: m.start()] + form(int(m[1]), [tuple(x.split(" := ", 1)) for x in named], e) + text[end:]
    return text


def _fields(e: str, names) -> str:
    """``e`` with the names i and those bound so far read from the struct s."""
    return re.sub(r"\b(" + "|".join(["i", *names]) + r")\b(?!')", r"s.\1", e)


def _each_duckdb(n: int, named, e: str) -> str:
    rows, names = f"list_transform(range({n}), lambda j: {{'i': j}})", []
    for name, value in named:
        kept = ", ".join(f"'{k}': s.{k}" for k in ["i", *names])
        rows = f"list_transform({rows}, lambda s: {{{kept}, '{name}': {_fields(value, names)}}})"
        names.append(name)
    return f"array_to_string(list_transform({rows}, lambda s: {_fields(e, names)}), '')"


def _each_spark(n: int, named, e: str) -> str:
    rows, names = f"transform(sequence(0, {n - 1}), j -> named_struct('i', j))", []
    for name, value in named:
        kept = ", ".join(f"'{k}', s.{k}" for k in ["i", *names])
        rows = f"transform({rows}, s -> named_struct({kept}, '{name}', {_fields(value, names)}))"
        names.append(name)
    return f"array_join(transform({rows}, s -> {_fields(e, names)}), '')"


def _spelt(name: str, text: str) -> str:
    """The template with its spelt strings as plain expressions."""
    for c, (a, b, rule) in LETTERS.get(name, {}).items():
        text = text.replace("{" + c + "}", seq_expr(a, b, **rule))
    return text.replace("{seq}", probe_read_expr(*PROBE_READ)) if name == "probe_reads" else text


def duckdb_sql(name: str) -> str:
    """Derivation text for DuckDB, over its pre-registered views (fixture deps as CTE names)."""
    text, tables, deps = TEMPLATES[name]
    text = _spelt(name, text)
    for t in (*tables, *deps):
        text = text.replace("{" + t + "}", t)
    text = re.sub(r"fmt_thousands\(([^()]*)\)", r"format('{:,}', \1)", text)
    return _each(text, _each_duckdb).strip()


def duckdb_ctes(*names: str) -> list[tuple[str, str]]:
    """(alias, body) pairs for the fixtures and their dependencies, in dependency order."""
    order: list[str] = []
    for n in names:
        _deps(n, order)
    return [(n, duckdb_sql(n)) for n in order]


def spark_words(name: str) -> dict[str, list[str]]:
    """The strings that ``spark_sql_text`` takes from the views ``{words_<placeholder>}``, each an array ``w`` in one row."""
    if name == "probe_reads":
        return {"words_seq": probe_words()}
    if name in STRETCH_WORDS:
        return {"words_bases": STRETCH_WORDS[name]()}
    return {f"words_{c}": seq_words(**rule) for c, (_, _, rule) in LETTERS.get(name, {}).items()}


def _words(c: str) -> str:
    return "(select w from {words_" + c + "})"


def spark_sql_text(name: str) -> str:
    text = TEMPLATES[name][0]
    for c, (a, b, rule) in LETTERS.get(name, {}).items():
        text = text.replace("{" + c + "}", seq_lookup(_words(c), a, b, **rule))
    if name == "probe_reads":
        text = text.replace("{seq}", probe_read_lookup(_words("seq"), *PROBE_READ))
    for rule, known, short in STRETCHES.get(name, ()):
        short = short if isinstance(short, str) else short(_words("bases"))
        text = text.replace(rule, f"(case when {known} then {short} else {rule} end)")
    text = text.replace(" // ", " div ").replace("varchar(8)", "string").replace("varchar(20)", "string")
    text = re.sub(r"fmt_thousands\(([^()]*)\)", r"format_number(\1, 0)", text)
    return _each(text, _each_spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _sf_key(sf_dir: str) -> str:
    return hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derivation as a lazy Spark plan (fixture dependencies are read materialised).

    Inputs are bound as session temp views with names unique to the scale-factor
    directory; the template placeholders are replaced by those names.
    """
    _, tables, deps = TEMPLATES[name]
    text = spark_sql_text(name)
    key = _sf_key(sf_dir)
    for t in tables:
        view = f"sitecall_{t}_{key}"
        table(spark, sf_dir, t).createOrReplaceTempView(view)
        text = text.replace("{" + t + "}", view)
    for t, words in spark_words(name).items():
        view = f"sitecall_{name}_{t}"
        spark.createDataFrame([(words,)], "w array<string>").createOrReplaceTempView(view)
        text = text.replace("{" + t + "}", view)
    for d in deps:
        view = f"sitecall_fx_{d}_{key}"
        load(spark, sf_dir, d).createOrReplaceTempView(view)
        text = text.replace("{" + d + "}", view)
    return spark.sql(text)


_MATERIALISED: dict[tuple, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read the derivation, writing it once per session as Parquet unless it is in ``AS_READ``."""
    if name in AS_READ:
        return derive(spark, sf_dir, name)
    app = spark.sparkContext.applicationId
    sf_key = _sf_key(sf_dir)
    key = (app, sf_key, name)
    path = _MATERIALISED.get(key)
    if path is None:
        path = scratch_path(spark, "fixtures", app, sf_key, name)
        derive(spark, sf_dir, name).write.mode("overwrite").parquet(path)
        _MATERIALISED[key] = path
    return spark.read.parquet(path)


def with_fixtures(fixture_names, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """DuckDB oracle text: ``with <fixture> as (...), <extra ctes> <body>``."""
    ctes = duckdb_ctes(*fixture_names) + list(extra or [])
    if not ctes:
        return body
    return "with " + ",\n".join(f"{alias} as (\n{text}\n)" for alias, text in ctes) + "\n" + body
