"""N-gram Jaccard join in metric space: exact links of documents by their sets of 5-word shingles.

The Jaccard distance is a metric, and two documents link at a distance of at most ``EPSILON``.

1. Documents with equal sets make one class, represented by its smallest id.
2. First regions. Whole documents are poor first pivots: unrelated texts are all at distance 1 from one, and the
   window around such a boundary holds everything. The first pivots are therefore the one-shingle sets: a set
   is at distance 1 - 1/n from the pivots in it and at 1 from all others. Pivots have one global order, frequent
   ones last (by a sketch of counts over all documents), and a document lies in the region of its first pivot.
   By the triangle inequality a partner within EPSILON misses at most ``n - ceil(0.8 n)`` of its n pivots, so
   two linked documents have at least ``1 + n // 10`` of the first ``n - ceil(0.8 n) + 1 + n // 10`` pivots in common;
   a document is replicated to the regions of these and to no others. Regions with one class are finished.
3. Candidate edges: pairs of regions with at most ``PAIR_LIMIT`` members are counted, and stay if they have enough
   pivots in common (those in larger regions count as common for both). Documents with enough pivots in
   larger regions are joined there by a star around one of them. The components of these edges are zones;
   links never leave a zone, and each document's set is sent to its zone once.
4. A zone of at most ``ZONE_DOCS`` documents and ``ZONE_HASHES`` shingles is joined exactly in one task. A larger
   one is split by ``PIVOTS`` of its documents as pivots: every member's distance to them is computed, it goes
   to the Voronoi region of the nearest pivot (within ``BALL``), and to every other region whose pivot is at most
   2 EPSILON farther; documents far from all pivots form a region of their own. Documents within EPSILON of a
   pivot are linked to it, so they need no comparison with each other. Regions are split again until they fit;
   where the windows hold nearly all members, blocks of members meet block by block instead.
5. Links are closed to components.

Defined cases: null text or text without words has an empty set and is linked with nothing; a text with 1 to 4
words has one shingle, its whole word sequence; rows with one id count as one document (its texts' links
together); a null id gets a null component; equal rows get equal results; an empty table gives an empty
result; other columns are ignored. Sets hold 64-bit hashes of shingles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import LOWER_AZ, as_int64, chunks, doc_columns, ids_of, local_rows, mix64, shingle_hashes, span_hashes, staged, word_spans
from sitecall.llm.components import components

SHINGLE = 5
EPSILON = 0.2
BALL = 0.6
SKETCH_BITS = 18
SLICES = 64
PAIR_LIMIT = 32
ZONE_DOCS = 256
ZONE_HASHES = 400_000
PIVOTS = 16
PIVOT_HASHES = 2_000_000  # shingles of all pivots of a round: at most 16 MB go to the executors


def linked(inter, union) -> np.ndarray:
    """Similarity of at least 0.8, in whole numbers."""
    return 100 * np.asarray(inter) >= 80 * np.asarray(union)


def _least_overlap(n):
    """Fewest shingles of a set of n that a partner shares."""
    return -(-4 * n // 5)


def _shared_pivots(n):
    """Pivots that two linked documents surely share among their first ``n - ceil(0.8 n) + this`` ones."""
    return 1 + n // 10


def _row_sets(data: np.ndarray, off: np.ndarray):
    """The sorted distinct shingle hashes of each row."""
    low = LOWER_AZ[data]
    s, e, woff = word_spans(low, off)
    h, soff = shingle_hashes(span_hashes(low, s, e), woff, SHINGLE)
    for i in range(len(off) - 1):
        x = np.sort(h[soff[i] : soff[i + 1]])
        yield x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _place(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _class_batches(batches):
    """One row a document (its set's size and 128-bit signature), and the task's sketch of shingle counts."""
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])
    none = lambda m, t: pa.nulls(m, t)
    for rb, data, off in chunks(batches, "text"):
        n, s1, s2 = [], [], []
        for x in _row_sets(data, off):
            n.append(len(x))
            s1.append(x.sum(dtype=np.uint64))
            s2.append(mix64(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            sketch += np.bincount(_place(x), minlength=len(sketch)) if len(x) > 5000 else 0
            if 0 < len(x) <= 5000:
                np.add.at(sketch, _place(x), 1)
        m = rb.num_rows
        yield pa.RecordBatch.from_arrays([ids_of(rb), pa.array(n, pa.int64()), pa.array(as_int64(np.array(s1, np.uint64))), pa.array(as_int64(np.array(s2, np.uint64))), none(m, pa.int32()), none(m, pa.binary())], schema=schema)
    parts = [p.astype("<i8").tobytes() for p in np.split(sketch, SLICES)] if sketch.any() else []
    m = len(parts)
    yield pa.RecordBatch.from_arrays([*(none(m, pa.int64()) for _ in range(4)), pa.array(range(m), pa.int32()), pa.array(parts, pa.binary())], schema=schema)


def _add_slices(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, "<i8") for c in pdf["counts"])
    return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "counts": [total.tobytes()]})


def _frequent(rows: DataFrame) -> np.ndarray:
    """Sketch places that hold a frequent shingle: clearly above what the rare ones add up to."""
    summed = rows.filter("slice is not null").select("slice", "counts").groupBy("slice").applyInPandas(_add_slices, "slice int, counts binary").collect()
    counts = np.zeros(1 << SKETCH_BITS, np.int64)  # a fixed 2 MB
    size = len(counts) // SLICES
    for r in summed:
        counts[r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(r["counts"], "<i8")
    usual = float(np.median(counts))
    return counts >= usual + max(2 * PAIR_LIMIT, 6 * usual**0.5)


def _region_batches(frequent: np.ndarray):
    """The first pivots of each document, and the size of its set."""

    def run(batches):
        for rb, data, off in chunks(batches, "text"):
            pivot, n, sig = [], [], []
            for x in _row_sets(data, off):
                m = len(x)
                k = m - _least_overlap(m) + int(_shared_pivots(m)) if m else 0
                late = frequent[_place(x)]
                first = x[:k] if not late[:k].any() else np.concatenate([x[~late], x[late]])[:k]
                pivot.append(first)
                n.append(m)
                sig.append(x.sum(dtype=np.uint64))
            count = np.array([len(p) for p in pivot])
            row = np.repeat(np.arange(rb.num_rows), count)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_int64(np.concatenate(pivot))), pa.array(as_int64(np.array(sig, np.uint64)[row])), ids_of(rb).take(pa.array(row)), pa.array(np.array(n)[row])],
                    ["pivot", "sig", "doc_id", "n"],
                )

    return run


def _candidates(rows: DataFrame, classes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Edges (a, b) between class representatives whose components hold all links."""
    members = rows.mapInArrow(_region_batches(frequent), "pivot long, sig long, doc_id long, n long")
    shared = members.groupBy("pivot").agg(F.min("sig").alias("x"), F.max("sig").alias("y")).filter("x <> y").select(F.col("pivot").alias("_pivot"))
    shared = staged(shared, "jaccard-pivots")
    # merge joins here and below: both sides grow with the corpus, so none is ever to be broadcast
    reps = classes.select(F.col("rep").alias("_rep")).distinct()
    alive = members.join(shared.hint("merge"), F.col("pivot") == F.col("_pivot")).join(reps, F.col("doc_id") == F.col("_rep"), "left_semi")
    alive = staged(alive.select("pivot", "doc_id", "n", (1 + F.floor(F.col("n") / 10)).alias("need")), "jaccard-regions")
    sizes = staged(alive.groupBy("pivot").agg(F.count("*").alias("m")).filter("m > 1").withColumnRenamed("pivot", "_pivot"), "jaccard-sizes")
    sized = staged(alive.join(sizes, F.col("pivot") == F.col("_pivot")).drop("_pivot"), "jaccard-sized")
    large = sized.filter(F.col("m") > PAIR_LIMIT)
    in_large = staged(large.groupBy("doc_id").agg(F.count("*").alias("c")), "jaccard-large").withColumnRenamed("doc_id", "_id")

    few = sized.filter(F.col("m") <= PAIR_LIMIT)
    x, y = few.alias("x"), few.alias("y")
    close = (F.col("x.doc_id") < F.col("y.doc_id")) & (5 * F.least("x.n", "y.n") >= 4 * F.greatest("x.n", "y.n"))
    pairs = x.join(y, F.col("x.pivot") == F.col("y.pivot")).filter(close)
    pairs = pairs.groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).agg(F.count("*").alias("common"), F.first(F.least("x.need", "y.need")).alias("need"))
    ca, cb = in_large.alias("ca"), in_large.alias("cb")
    pairs = pairs.join(ca, F.col("a") == F.col("ca._id"), "left").join(cb, F.col("b") == F.col("cb._id"), "left")
    pairs = pairs.filter(F.col("common") + F.coalesce(F.least("ca.c", "cb.c"), F.lit(0)) >= F.col("need")).select("a", "b")  # least() skips nulls, which only keeps more pairs

    stars = large.join(in_large.withColumnRenamed("_id", "_id2"), F.col("doc_id") == F.col("_id2")).filter(F.col("c") >= F.col("need"))
    stars = staged(stars.select("pivot", "doc_id"), "jaccard-stars")
    centres = stars.groupBy(F.col("pivot").alias("_pivot")).agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id")).alias("centre"))
    centres = staged(centres.select("_pivot", F.col("centre.doc_id").alias("b")), "jaccard-centres")
    stars = stars.join(centres, F.col("pivot") == F.col("_pivot")).filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    return pairs.union(stars).distinct()


# ---- zones ---------------------------------------------------------------------------------------


def _set_batches(batches):
    for rb, data, off in chunks(batches, "text"):
        sets = [as_int64(x) for x in _row_sets(data, off)]
        at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
        arrays = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))
        yield pa.RecordBatch.from_arrays([ids_of(rb, "zone"), ids_of(rb), pa.nulls(rb.num_rows, pa.int64()), arrays], ["zone", "doc_id", "label", "shingles"])


class _Groups:
    """Union-find over the rows of a zone."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def join_zone(ids: list[int], labels: list, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect exactly the documents of a zone that links connect; equal labels are connected already."""
    n = len(ids)
    groups, by_label, by_id = _Groups(n), {}, {}
    for i in range(n):
        if labels[i] is not None:
            groups.join(i, by_label.setdefault(labels[i], i))
        groups.join(i, by_id.setdefault(ids[i], i))
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    at = np.concatenate([[0], np.cumsum(size[order])])
    flat = np.concatenate([sets[i] for i in order]) if n else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), size[order])
    out = []
    for k in range(n - 1):
        i = int(order[k])
        if size[i] == 0:
            continue
        last = int(np.searchsorted(size[order], size[i] * 5 // 4, side="right"))  # 5 * smaller >= 4 * larger
        rest = [j for j in range(k + 1, last) if groups.root(int(order[j])) != groups.root(i)]
        if not rest:
            continue
        if len(rest) > 8:
            a, b = at[k + 1], at[last]
            part = flat[a:b]
            hit = np.minimum(np.searchsorted(sets[i], part), size[i] - 1)
            inter = np.bincount(owner[a:b][sets[i][hit] == part], minlength=n)
        else:
            inter = {j: len(np.intersect1d(sets[i], sets[int(order[j])], assume_unique=True)) for j in rest}
        for j in rest:
            o = int(order[j])
            if linked(inter[j], size[i] + size[o] - inter[j]) and groups.root(o) != groups.root(i):
                groups.join(o, i)
                out.append((ids[i], ids[o]))
    return out


def _zone_links(pdf: pd.DataFrame) -> pd.DataFrame:
    labels = [None if pd.isna(x) else int(x) for x in pdf["label"]]
    got = join_zone(pdf["doc_id"].tolist(), labels, [np.sort(np.asarray(s, np.int64)) for s in pdf["shingles"]])
    return pd.DataFrame(got, columns=["a", "b"]).astype("int64")


_MEMBER = "zone long, doc_id long, label long, shingles array<long>"
_PART = f"parent long, home boolean, {_MEMBER}"


def _pivot_labels(pivots: list[tuple[int, np.ndarray]]) -> list[int]:
    """One label for pivots that are linked with each other."""
    groups = _Groups(len(pivots))
    for i, (_, x) in enumerate(pivots):
        for j in range(i):
            inter = len(np.intersect1d(x, pivots[j][1], assume_unique=True))
            if linked(inter, len(x) + len(pivots[j][1]) - inter):
                groups.join(i, j)
    return [pivots[groups.root(i)][0] for i in range(len(pivots))]


def _split_batches(pivots: dict[int, list[tuple[int, np.ndarray]]], salt: int):
    """Distances to the zone's pivots: links (zone null, label the pivot) and the members of the new regions."""
    names = {zone: _pivot_labels(ps) for zone, ps in pivots.items()}

    def region(zone: int, j: int) -> int:
        return int(as_int64(mix64(np.array([zone & (2**64 - 1)], np.uint64) ^ mix64(np.array([salt * 1000 + j + 2], np.uint64))))[0])

    def run(batches):
        for rb in batches:
            zones, docs, labels = (ids_of(rb, c).to_pylist() for c in ("zone", "doc_id", "label"))
            sets = ids_of(rb, "shingles")
            out: list[tuple] = []
            for i, zone in enumerate(zones):
                x = np.sort(sets[i].values.to_numpy())
                ps = pivots[zone]
                inter = np.array([len(np.intersect1d(x, p, assume_unique=True)) for _, p in ps])
                union = np.array([len(x) + len(p) for _, p in ps]) - inter
                link = linked(inter, union)
                d = 1 - inter / union
                out.extend((zone, False, None, docs[i], ps[j][0], None) for j in np.flatnonzero(link) if ps[j][0] != docs[i])
                if any(p == docs[i] for p, _ in ps):
                    continue  # a pivot has met every member
                label = names[zone][int(np.flatnonzero(link)[0])] if link.any() else labels[i]
                home = int(np.argmin(d))
                slack = 1e-9
                if d[home] <= BALL:
                    # a pair of two regions meets in the one with the lower pivot
                    there = np.flatnonzero((d <= d[home] + 2 * EPSILON + slack) & (d <= BALL + EPSILON + slack) & (np.arange(len(d)) <= home))
                else:
                    there = np.flatnonzero(d <= BALL + EPSILON + slack)
                    home = -1
                    out.append((zone, True, region(zone, -1), docs[i], label, i))
                out.extend((zone, int(j) == home, region(zone, int(j)), docs[i], label, i) for j in there)
            if out:
                cols = list(zip(*out))
                shingles = sets.take(pa.array(cols[5], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.bool_()), *(pa.array(c, pa.int64()) for c in cols[2:5]), shingles], ["parent", "home", "zone", "doc_id", "label", "shingles"])

    return run


def _blocks(parts: DataFrame, dense: DataFrame, step: int) -> DataFrame:
    """Zones that pivots do not part (most members within every window): each block of open members meets each block.

    Members with the zone's one label are connected already, so their blocks meet blocks of open members only.
    """
    rows = parts.filter("home").join(dense, F.col("parent") == F.col("_parent"))
    open_one = F.col("label").isNull() | (F.col("labels") > 1)
    share = F.lit(2) * F.greatest(F.col("m") / ZONE_DOCS, F.col("hashes") / ZONE_HASHES)
    n_open = F.ceil(share * F.col("open") / F.col("m")).cast("int")
    n_done = F.ceil(share * (F.col("m") - F.col("open")) / F.col("m")).cast("int")
    rows = rows.withColumn("is_open", open_one).withColumn("no", n_open).withColumn("nd", n_done).filter("no > 0")
    mine = F.pmod(F.xxhash64("doc_id", F.lit(step)), F.when(F.col("is_open"), F.col("no")).otherwise(F.col("nd"))).cast("int")
    rows = rows.withColumn("mine", mine)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    with_open = F.transform(upto(F.col("no")), lambda c: F.struct(F.lit(0).alias("t"), F.least(c, F.col("mine")).alias("x"), F.greatest(c, F.col("mine")).alias("y")))
    with_done = F.transform(upto(F.col("nd")), lambda c: F.struct(F.lit(1).alias("t"), F.col("mine").alias("x"), c.alias("y")))
    done = F.transform(upto(F.col("no")), lambda c: F.struct(F.lit(1).alias("t"), c.alias("x"), F.col("mine").alias("y")))
    rows = rows.withColumn("to", F.explode(F.when(F.col("is_open"), F.concat(with_open, with_done)).otherwise(done)))
    return rows.select(F.xxhash64("parent", "to", F.lit(step)).alias("zone"), "doc_id", "label", "shingles")


def _resolve(members: DataFrame) -> DataFrame:
    """Links (a, b) within zones; zones that are too large are split by pivots, round after round."""
    spark = members.sparkSession
    links = local_rows(spark, [], "a long, b long")
    joined = lambda rows: rows.select("zone", "doc_id", "label", "shingles").groupBy("zone").applyInPandas(_zone_links, "a long, b long")
    for step in range(10_000):
        sizes = members.groupBy("zone").agg(
            F.count("*").alias("docs"), F.sum(F.size("shingles")).alias("hashes"), F.count(F.when(F.col("label").isNull(), 1)).alias("open"), F.countDistinct("label").alias("labels"),
        )
        sizes = sizes.filter(~((F.col("open") == 0) & (F.col("labels") <= 1)))  # else all are connected already
        fits = (F.col("docs") <= ZONE_DOCS) & (F.col("hashes") <= ZONE_HASHES) | (F.col("docs") <= 2)
        sizes = staged(sizes.withColumn("fits", fits), f"jaccard-sizes{step}").select(F.col("zone").alias("_zone"), "docs", "hashes", "open", "fits")
        here = members.join(sizes, F.col("zone") == F.col("_zone"))
        links = links.union(staged(joined(here.filter("fits")), f"jaccard-joined{step}"))
        # the pivots of as many large zones as the bound on what is sent allows, smallest zone id first
        large = sizes.filter(~F.col("fits"))
        chosen, room = [], PIVOT_HASHES
        for r in large.orderBy("_zone").limit(max(1, PIVOT_HASHES // ZONE_HASHES * PIVOTS)).collect():
            cost = PIVOTS * max(1, r["hashes"] // r["docs"])
            if chosen and cost > room:
                break
            chosen.append((r["_zone"], r["open"] == 0))
            room -= cost
        if not chosen:
            return links
        zones = F.broadcast(local_rows(spark, chosen, "_zone long, settled boolean"))  # at most PIVOT_HASHES // ZONE_HASHES * PIVOTS rows
        split = staged(members.join(zones, F.col("zone") == F.col("_zone")).drop("_zone"), f"jaccard-split{step}")
        # pivots are open members: the first of each of PIVOTS hash buckets
        able = split.filter(F.col("label").isNull() | F.col("settled"))
        picked = able.groupBy("zone", F.pmod(F.xxhash64("doc_id", F.lit(step)), F.lit(PIVOTS)).alias("k")).agg(F.min(F.struct(F.xxhash64(F.lit(step), "doc_id").alias("h"), "doc_id")).alias("p"))
        picked = picked.select(F.col("zone").alias("z"), F.col("p.doc_id").alias("d"))
        pivots: dict[int, list] = {}
        got = split.join(F.broadcast(picked), (F.col("zone") == F.col("z")) & (F.col("doc_id") == F.col("d")))
        for r in got.select("zone", "doc_id", "shingles").dropDuplicates(["zone", "doc_id"]).orderBy("zone", "doc_id").toLocalIterator():
            pivots.setdefault(r["zone"], []).append((r["doc_id"], np.sort(np.array(r["shingles"], np.int64))))
        parts = staged(split.select("zone", "doc_id", "label", "shingles").mapInArrow(_split_batches(pivots, step), _PART), f"jaccard-parts{step}")
        links = links.union(parts.filter("zone is null").select(F.col("doc_id").alias("a"), F.col("label").alias("b")))
        parts = parts.filter("zone is not null")
        one = F.col("home")
        stats = parts.groupBy("parent").agg(
            F.count("*").alias("copies"), F.count(F.when(one, 1)).alias("m"), F.sum(F.when(one, F.size("shingles"))).alias("hashes"),
            F.count(F.when(one & F.col("label").isNull(), 1)).alias("n_open"), F.countDistinct("label").alias("labels"),
        )
        stats = stats.withColumn("open", F.when(F.col("labels") > 1, F.col("m")).otherwise(F.col("n_open")))
        biggest = parts.groupBy("parent", "zone").agg(F.count("*").alias("c")).groupBy("parent").agg(F.max("c").alias("c"))
        stats = staged(stats.join(biggest, "parent"), f"jaccard-stats{step}").withColumnRenamed("parent", "_parent")
        parted = (F.col("copies") <= 2 * F.col("m")) & (F.col("c") <= 0.7 * F.col("m"))
        dense = stats.filter(~parted).select("_parent", "m", "hashes", "open", "labels")
        links = links.union(staged(joined(_blocks(parts, dense, step)), f"jaccard-dense{step}"))
        regions = parts.join(stats.filter(parted).select("_parent"), F.col("parent") == F.col("_parent"), "left_semi").select("zone", "doc_id", "label", "shingles")
        waiting = large.join(zones, "_zone", "left_anti").select("_zone")
        waiting = members.join(waiting, F.col("zone") == F.col("_zone"), "left_semi").select("zone", "doc_id", "label", "shingles")
        members = staged(regions.union(waiting), f"jaccard-members{step}")
    raise RuntimeError("zones did not get small enough")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every document."""
    rows = doc_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    kind = "doc_id long, n long, s1 long, s2 long, slice int, counts binary"
    first = staged(rows.mapInArrow(_class_batches, kind), "jaccard-classes")
    frequent = _frequent(first)
    every = first.filter("slice is null").select("doc_id", "n", "s1", "s2")
    filled = every.filter("n > 0 and doc_id is not null")
    classes = staged(filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "jaccard-reps")
    named = rows.filter("doc_id is not null")
    zones = components(_candidates(named, classes, frequent), "jaccard-zones")
    zones = zones.select(F.col("node").alias("_node"), F.col("component").alias("zone"))
    members = named.join(zones.hint("merge"), F.col("doc_id") == F.col("_node")).select("zone", "doc_id", "text").mapInArrow(_set_batches, _MEMBER)
    links = staged(_resolve(staged(members, "jaccard-sets")), "jaccard-links")
    # copies hang on their class, classes on their links
    same = filled.join(classes, ["n", "s1", "s2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.union(same), "jaccard-components")
    out = every.join(found, every["doc_id"] == found["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
