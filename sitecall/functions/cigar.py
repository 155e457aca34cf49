"""CIGAR strings as Column expressions: operations with running query and reference offsets, lengths, aligned blocks.

A CIGAR is parsed once into an array of (op, len, q, r), where q and r are the 0-based offsets at which the
operation starts in the stored sequence and on the reference, as running sums over the operations before it.
Parsing runs in Python on Arrow batches, once for each distinct CIGAR of a batch.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from sitecall.functions.motif import col

# Fixed by the SAM format: the operations that consume the stored sequence, the reference, or both.
QUERY_OPS = ("M", "I", "S", "=", "X")
REF_OPS = ("M", "D", "N", "=", "X")
MATCH_OPS = ("M", "=", "X")

_OP = re.compile("([0-9]+)([MIDNSHP=X])")
_VALID = re.compile("([0-9]+[MIDNSHP=X])+")
_OPS_TYPE = "array<struct<op: string, len: bigint, q: bigint, r: bigint>>"


def _zero() -> Column:
    return F.lit(0).cast("bigint")


@lru_cache(maxsize=1 << 16)
def operations(cigar: str) -> tuple[tuple[int, str], ...]:
    """(length, operation) of each; an error for what is no CIGAR."""
    if not _VALID.fullmatch(cigar):
        raise ValueError(f"not a CIGAR: {cigar}")
    return tuple((int(n), op) for n, op in _OP.findall(cigar))


def _distinct(cigars: pa.Array) -> tuple[list[tuple[tuple[int, str], ...]], pa.Array]:
    """(operations of the distinct CIGARs of a batch and, last, of none; number of each row's)."""
    found = cigars.dictionary_encode()
    parsed = [operations(c) if c != "*" else () for c in found.dictionary.to_pylist()]
    return [*parsed, ()], pc.fill_null(found.indices, len(parsed))


def _ops_batch(cigars: pa.Array) -> pa.Array:
    parsed, rows = _distinct(cigars)
    ends, kinds, lens, queries, refs = [0], [], [], [], []
    for ops in parsed:
        q = r = 0
        for n, op in ops:
            kinds.append(op)
            lens.append(n)
            queries.append(q)
            refs.append(r)
            q += n * (op in QUERY_OPS)
            r += n * (op in REF_OPS)
        ends.append(len(kinds))
    fields = [pa.array(kinds, pa.string()), *(pa.array(x, pa.int64()) for x in (lens, queries, refs))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["op", "len", "q", "r"])).take(rows)


def cigar_ops(cigar) -> Column:
    """array<struct<op, len, q, r>>; empty for ``*`` or null, an error for anything that is no CIGAR. A batch's distinct CIGARs are parsed once."""
    return F.arrow_udf(_ops_batch, _OPS_TYPE)(col(cigar))


def _reach_batch(cigars: pa.Array) -> pa.Array:
    parsed, rows = _distinct(cigars)
    leads, reaches = [], []
    for ops in parsed:
        lead = reach = 0
        for n, op in ops:
            if op in REF_OPS:
                reach += n
            elif op in "SH":
                lead, reach = (lead, reach + n) if reach else (lead + n, 0)
        leads.append(lead)
        reaches.append(reach)
    return pa.StructArray.from_arrays([pa.array(leads, pa.int64()), pa.array(reaches, pa.int64())], ["lead", "reach"]).take(rows)


def cigar_reach(cigar) -> Column:
    """struct<lead, reach>: clipped bases before the first base on the reference; reference bases and the clipped ones after it."""
    return F.arrow_udf(_reach_batch, "struct<lead: bigint, reach: bigint>")(col(cigar))


def ops_length(ops, kinds: tuple[str, ...]) -> Column:
    """Summed length of the operations of these kinds."""
    return F.aggregate(F.filter(col(ops), lambda x: x["op"].isin(*kinds)), _zero(), lambda acc, x: acc + x["len"])


def aligned_blocks(ops, start) -> Column:
    """array<struct<ref, query, len>> of the aligned stretches; ``start`` is the alignment's 1-based position, ref is 0-based."""
    hit = F.filter(col(ops), lambda x: x["op"].isin(*MATCH_OPS))
    return F.transform(hit, lambda x: F.struct((col(start) - 1 + x["r"]).alias("ref"), x["q"].alias("query"), x["len"].alias("len")))


def unclipped_five_prime(ops, start, reverse) -> Column:
    """1-based reference position of the read's 5' end, soft and hard clips counted as aligned."""
    o = col(ops)
    clip = ("S", "H")
    lead = F.when(F.size(o) > 0, F.aggregate(
        F.filter(o, lambda x: x["op"].isin(*clip) & (x["r"] == 0)), _zero(), lambda acc, x: acc + x["len"])).otherwise(_zero())
    span = ops_length(o, REF_OPS)
    trail = F.aggregate(F.filter(o, lambda x: x["op"].isin(*clip) & (x["r"] > 0)), _zero(), lambda acc, x: acc + x["len"])
    return F.when(col(reverse), col(start) + span - 1 + trail).otherwise(col(start) - lead)


def five_prime_of(cigar, start, reverse) -> Column:
    """``unclipped_five_prime`` of a CIGAR whose operations nobody else needs."""
    x = cigar_reach(cigar)
    return F.when(col(reverse), col(start) - 1 + x["reach"]).otherwise(col(start) - x["lead"])


def reverse_complement(seq) -> Column:
    """Reverse complement of A, C, G, T (either case); other letters stay."""
    return F.translate(F.reverse(col(seq)), "ACGTacgt", "TGCAtgca")
