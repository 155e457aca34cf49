"""DuckDB SQL snippets used by the oracles (independent of the Spark code)."""

from __future__ import annotations

from collections.abc import Sequence


def motif3(m: str) -> str:
    return f"upper(substr({m}, 15, 3))"


def motif3_rna_all(m: str) -> str:
    return f"replace({motif3(m)}, 'T', 'U')"


def motif3_rna2(m: str) -> str:
    return f"(case when {motif3(m)} = 'TTT' then 'UUT' else replace({motif3(m)}, 'T', 'U') end)"


def gc_pct(m: str) -> str:
    w = f"upper(concat(substr({m}, 5, 10), substr({m}, 18, 10)))"
    return f"cast(5 * (length({w}) - length(regexp_replace({w}, '[GC]', '', 'g'))) as bigint)"


def gc_bin(g: str) -> str:
    return f"cast(case when {g} > 80 then 100 when {g} < 20 then 0 else {g} end as bigint)"


def ratio2(u: str, d: str) -> str:
    return f"(case when {d} > 0 then cast(round_even(cast({u} as double) / cast({d} as double) * 100, 0) as bigint) end)"


def ratio(u: str, d: str) -> str:
    return f"(case when {d} = 0 then null else cast({u} as double) / cast({d} as double) end)"


def chi2(u: str, d: str, b: str) -> str:
    """Statistic with the 1e-4 background floor and 1e-10 expected floors."""
    bb = f"greatest(0.0001::double, {b})"
    eu = f"(case when {d} * {bb} <= 0 then 1e-10 else {d} * {bb} end)"
    ec = f"(case when {d} * (1 - {bb}) <= 0 then 1e-10 else {d} * (1 - {bb}) end)"
    c = f"({d} - {u})"
    return f"(({u} - {eu}) * ({u} - {eu}) / {eu} + ({c} - {ec}) * ({c} - {ec}) / {ec})"


def call_tested(u: str, d: str, b: str) -> str:
    """True where the chi-square test runs (p < 1); false where p = 1 or unknown."""
    r = f"(case when {d} > 0 then cast({u} as double) / {d} else 0.0 end)"
    return (
        f"(case when {d} <= 10 or {d} = 0 or {r} < 0.1 or {r} = 0 then false "
        f"when {b} is null then false else {r} > greatest(0.0001::double, {b}) end)"
    )


def merge_chain(src: str, ordered: Sequence[tuple[str, bool]], min_depth: int, prefix: str = "m") -> tuple[list[tuple[str, str]], str]:
    """The literal join chain of the original merge, as CTEs; returns (ctes, final alias).

    Final columns: Chrom, Pos, Strand, Motif, Uncon_<s>, Depth_<s> (zeros for nulls).
    """
    ctes: list[tuple[str, str]] = []
    for i, (s, _) in enumerate(ordered):
        ctes.append((
            f"{prefix}_t{i}",
            f'select chrom, pos, strand, motif, uncon as "Uncon_{s}", depth as "Depth_{s}" from {src} '
            f"where sample = '{s}' and depth > 0",
        ))
    cols = [f'"Uncon_{ordered[0][0]}"', f'"Depth_{ordered[0][0]}"']
    cur = f"{prefix}_t0"
    shrunk = False
    for i, (s, req) in enumerate(ordered[1:], start=1):
        if not shrunk and not req:
            depth_cols = [c for c in cols if c.startswith('"Depth_')]
            g = "greatest(" + ", ".join(f"coalesce({c}, 0)" for c in depth_cols) + ")" if len(depth_cols) > 1 else f"coalesce({depth_cols[0]}, 0)"
            ctes.append((f"{prefix}_s{i}", f"select * from {cur} where {g} >= {min_depth}"))
            cur = f"{prefix}_s{i}"
            shrunk = True
        how = "full outer" if req else "left"
        left_cols = ", ".join(f"j.{c}" for c in cols)
        ctes.append((
            f"{prefix}_j{i}",
            f"select coalesce(j.chrom, t.chrom) as chrom, coalesce(j.pos, t.pos) as pos, "
            f"coalesce(j.strand, t.strand) as strand, coalesce(j.motif, t.motif) as motif, {left_cols}, "
            f't."Uncon_{s}", t."Depth_{s}" from {cur} j {how} join {prefix}_t{i} t '
            f"on j.chrom = t.chrom and j.pos = t.pos and j.strand = t.strand",
        ))
        cols += [f'"Uncon_{s}"', f'"Depth_{s}"']
        cur = f"{prefix}_j{i}"
    final_cols = ", ".join(f"cast(coalesce({c}, 0) as bigint) as {c}" for c in cols)
    ctes.append((
        f"{prefix}_out",
        f'select chrom as "Chrom", pos as "Pos", strand as "Strand", motif as "Motif", {final_cols} from {cur}',
    ))
    return ctes, f"{prefix}_out"


def exons_cte(src: str = "transcripts") -> str:
    """Exons with transcript offsets from the spans table (one group per transcript row)."""
    return f"""
select gene_name, ex_chrom, ex_strand, g_start, g_end,
 cast(coalesce(sum(g_end - g_start) over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as bigint) as tx_start,
 cast(sum(g_end - g_start) over (partition by rid order by idx rows between unbounded preceding and current row) as bigint) as tx_end
from (
 select rid, gene_id as gene_name, chrom as ex_chrom, strand as ex_strand, idx,
  cast(split_part(span, '-', 1) as bigint) - 1 as g_start,
  cast(substr(span, strpos(span, '-') + 1) as bigint) as g_end
 from (select rid, gene_id, chrom, strand, unnest(string_split(spans, ',')) as span,
        generate_subscripts(string_split(spans, ','), 1) as idx
       from (select row_number() over () as rid, * from {src}) r0) r1) r2
"""


def lifted_rows(tx: str, exons: str) -> str:
    """Transcript rows (chrom = gene, pos 1-based) lifted through ``exons``; extra columns pass."""
    return f"""
select coalesce(e.ex_chrom, t.chrom) as chrom,
 cast(case when e.ex_strand = '+' then e.g_start + (t.pos - 1 - e.tx_start)
           when e.ex_strand = '-' then e.g_end - (t.pos - 1 - e.tx_start) - 1
           else t.pos - 1 end + 1 as bigint) as pos,
 coalesce(e.ex_strand, '.') as strand, t.chrom as gene_name, cast(t.pos as bigint) as gene_pos, t.* exclude (chrom, pos, strand)
from {tx} t left join {exons} e on t.chrom = e.gene_name
where e.ex_chrom is null or (t.pos - 1 >= e.tx_start and t.pos - 1 < e.tx_end)
"""
