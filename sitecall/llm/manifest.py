"""Merkle dataset manifest by slot pivots: one root for a table, with a proof for each of its rows.

A row's leaf is a digest of its columns. The leaves of a language, by ascending doc_id, are the lowest level of
its tree. A level is raised by grouping the nodes by their parent's number: conditional aggregates spread the
children of a parent into ``fanout`` slot columns, and the digest of the slots side by side is the parent. The
slots of a parent without a child's own slot are that child's siblings. The roots of the languages, nulls first,
are the leaves of one more tree, whose root is the manifest's.

Proofs go down again: the steps of a parent, joined to its slots, give the steps of its children. A level holds
half the nodes of the one below it, so all levels together shuffle about twice the leaves; digests travel as 32
bytes, texts never leave the scan. Every level is a staged table.

Defined cases: a null column counts as ``-``, an empty text as ``0:``; a null doc_id comes first; rows with one
doc_id are ordered by their leaf, and fully repeated rows each have a leaf of their own; a tree of one leaf is
that leaf, its proof has no steps and digests the empty text; an empty table has no rows; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import doc_columns, staged
from sitecall.llm.positions import with_positions

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
_NO_STEPS = "array<struct<left: binary, right: binary>>"


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the values side by side."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's columns, some of them replaced."""
    return digest(*[_field(changed.get(c, F.col(c))) for c in COLUMNS])


def _hex(node: Column) -> Column:
    return F.lower(F.hex(node))


def _joined(slots: list[Column]) -> Column:
    return F.concat(*[F.coalesce(s, F.lit(b"")) for s in slots]) if slots else F.lit(b"")


@dataclass
class Forest:
    """``levels[i]``: tree, n (nodes of the level below), parent, slot_0 .. (structs of node and row); ``roots``: tree, height, node."""

    leaves: DataFrame
    levels: list[DataFrame]
    roots: DataFrame


def raise_forest(leaves: DataFrame, fanout: int = FANOUT, name: str = "manifest") -> Forest:
    """``leaves``: tree, n, idx, node (binary), row (struct of what a proof is to carry)."""
    widest = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    nodes, levels, roots = leaves, [], [leaves.filter("n = 1").select("tree", F.lit(0).alias("height"), "node")]
    while widest > 1:
        item = F.struct("node", "row") if not levels else F.struct("node")
        slots = [F.max(F.when(F.col("idx") % fanout == s, item)).alias(f"slot_{s}") for s in range(fanout)]
        level = nodes.filter("n > 1").groupBy("tree", "n", F.expr(f"idx div {fanout}").alias("parent")).agg(*slots)
        level = staged(level, f"{name}-level")
        levels.append(level)
        node = F.unhex(digest(_hex(_joined([F.col(f"slot_{s}.node") for s in range(fanout)]))))
        nodes = level.select("tree", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.col("parent").alias("idx"), node.alias("node"))
        roots.append(nodes.filter("n = 1").select("tree", F.lit(len(levels)).alias("height"), "node"))
        widest = -(-widest // fanout)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Forest(leaves, levels, staged(found, f"{name}-roots"))


def prove(forest: Forest, tops: DataFrame, fanout: int = FANOUT, name: str = "manifest") -> DataFrame:
    """tree, row, node, steps, carried for each leaf; ``tops``: tree, height, steps above the root, carried (a struct)."""
    at = lambda height: tops.filter(F.col("height") == height)
    steps = None
    for height in range(len(forest.levels), 0, -1):
        here = at(height).select("tree", F.lit(0).cast("long").alias("idx"), "steps", "carried")
        above = here if steps is None else here.unionByName(steps)
        level = forest.levels[height - 1]
        on = (level["tree"] == above["tree"]) & (level["parent"] == above["idx"])
        children = []
        for s in range(fanout):
            left, right = ([F.col(f"slot_{i}.node") for i in some] for some in (range(s), range(s + 1, fanout)))
            step = F.struct(_joined(left).alias("left"), _joined(right).alias("right"))
            children.append(F.struct(
                (F.col("parent") * fanout + s).alias("idx"), F.col(f"slot_{s}").alias("item"), F.concat(F.array(step), "steps").alias("steps"),
            ))
        joined = level.join(above, on).select(level["tree"], "carried", F.explode(F.array(*children)).alias("child")).filter("child.item is not null")
        if height > 1:
            steps = staged(joined.select("tree", "child.idx", "child.steps", "carried"), f"{name}-steps")
        else:
            steps = joined.select("tree", "child.item.row", "child.item.node", "child.steps", "carried")
    lone = forest.leaves.filter("n = 1").join(at(0), "tree").select("tree", "row", forest.leaves["node"], "steps", "carried")
    return lone if steps is None else lone.unionByName(steps)


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings from the leaf up, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: _hex(F.concat(s["left"], s["right"]))), ""))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf (hex) and its steps lead to."""
    return F.aggregate(steps, leaf, lambda node, s: digest(_hex(s["left"]), node, _hex(s["right"])))


def manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``tampered`` marks rows (a condition on the columns of ``docs``; null counts as false) whose n_chars is raised
    by one before the root is recomputed from them.
    """
    rows = doc_columns(docs, *COLUMNS)
    marked = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    # a null lang sorts before every other, as trees are named n or s and the lang
    leaves = rows.select(
        F.when(F.col("lang").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("lang"))).alias("tree"),
        "doc_id", F.unhex(leaf_digest()).alias("node"),
        F.when(marked, F.unhex(leaf_digest(n_chars=F.col("n_chars") + 1))).alias("changed"), F.monotonically_increasing_id().alias("at"),
    )
    leaves = staged(leaves, "manifest-leaves")
    leaves = with_positions(leaves, "tree", [F.asc_nulls_first("doc_id"), F.col("node"), F.col("at")], "manifest-order")
    leaves = leaves.select("tree", "n", "idx", "node", F.struct("doc_id", "changed").alias("row"))
    forest = raise_forest(leaves, fanout)
    # the roots of the languages are the leaves of the upper tree
    upper = with_positions(forest.roots.withColumn("one", F.lit("")), "one", [F.col("tree")], "manifest-subroots")
    upper = upper.select(F.lit("").alias("tree"), "n", "idx", "node", F.struct(F.col("tree").alias("lang_tree"), "height").alias("row"))
    top = raise_forest(upper, fanout, "manifest-upper")
    root = top.roots.first()
    root = root["node"].hex() if root else None
    no_steps = F.array().cast(_NO_STEPS)
    above = prove(top, top.roots.select("tree", "height", no_steps.alias("steps"), F.struct("node").alias("carried")), fanout, "manifest-upper")
    tops = staged(above.select(F.col("row.lang_tree").alias("tree"), "row.height", "steps", F.struct(F.col("node").alias("subroot")).alias("carried")), "manifest-tops")
    proved = prove(forest, tops, fanout)
    leaf = _hex(F.col("node"))
    out = proved.select(
        "row.doc_id", leaf.alias("leaf"), _hex(F.col("carried.subroot")).alias("subroot"), F.lit(root).alias("root"),
        proof_digest(F.col("steps")).alias("proof_sha256"), fold(F.coalesce(_hex(F.col("row.changed")), leaf), F.col("steps")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_rows(every: int = 7) -> Column:
    """Rows whose crc32 of the decimal doc_id (a null id: of the empty text) ``every`` divides."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % every == 0


def oracle_sql() -> str:
    """The same rows in DuckDB SQL: levels and folds as recursive queries, crc32 from its bits."""
    field = lambda e: f"coalesce(strlen({e}::varchar)::varchar || ':' || {e}::varchar, '-')"
    leaf = lambda n: "sha256(" + " || ".join(field(n if c == "n_chars" else c) for c in COLUMNS) + ")"
    # reflected polynomial 0xEDB88320, eight shifts a byte
    byte = "list_transform(range(length(v)), lambda i: ascii(substr(v, i + 1, 1))::bigint)"
    shift = "list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::bigint)), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {byte}), lambda a, b: {shift}), 4294967295)"
    levels = """
  select 0 as lvl, {tree}, idx, n, node from {leaves} union all
  select lvl + 1, tree, idx // 2, (n + 1) // 2, sha256(string_agg(node, '' order by idx)) from {name} where n > 1 group by lvl, tree, idx // 2, n"""
    return f"""
with recursive d as (select doc_id, {leaf('n_chars')} as leaf, {leaf('(n_chars + 1)')} as changed, lang, coalesce(doc_id::varchar, '') as v from documents),
leaves as (select *, {crc} % 7 = 0 as bad, case when lang is null then 'n' else 's' || lang end as tree,
  row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n, leaf as node from d),
low as ({levels.format(tree='tree', leaves='leaves', name='low')}
),
sub as (select tree, lvl as height, node, row_number() over (order by tree) - 1 as idx, count(*) over () as n from low where n = 1),
top as ({levels.format(tree="'' as tree", leaves='sub', name='top')}
),
rooted as (select node as root from top where n = 1),
start as (select row_number() over () as rid, l.doc_id, l.leaf, l.bad, l.changed, l.tree, l.idx, s.node as subroot, s.height, s.idx as sidx from leaves l join sub s using (tree)),
steps as (
  select rid, o.lvl as lvl, x.node as sibling, o.idx as own from start s join low o on o.tree = s.tree and o.n > 1 and o.idx = s.idx >> o.lvl
    left join low x on x.tree = o.tree and x.lvl = o.lvl and x.idx = xor(o.idx, 1)
  union all
  select rid, s.height + o.lvl, x.node, o.idx from start s join top o on o.n > 1 and o.idx = s.sidx >> o.lvl
    left join top x on x.lvl = o.lvl and x.idx = xor(o.idx, 1)),
proofs as (select rid, sha256(coalesce(string_agg(sibling, '' order by lvl), '')) as proof_sha256 from start left join steps using (rid) group by rid),
folds as (select rid, 0::bigint as lvl, case when bad then coalesce(changed, leaf) else leaf end as node from start union all
  select f.rid, f.lvl + 1, sha256(case when s.own % 2 = 0 then f.node || coalesce(s.sibling, '') else s.sibling || f.node end)
  from folds f join steps s on s.rid = f.rid and s.lvl = f.lvl),
folded as (select rid, arg_max(node, lvl) as folded_root from folds group by rid)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified
from start join proofs using (rid) join folded using (rid) cross join rooted"""
