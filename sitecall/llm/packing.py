"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids with a final end id; only documents longer than a sequence are cut, into full
pieces and a last shorter one. Full pieces are sequences by themselves. The other pieces are dealt at random
into groups of about ``GROUP`` pieces, and every group is packed by ``ISLANDS`` islands, each with a population
of its own:

* a packing is a list of bins; its fitness is the mean squared fill;
* a crossover injects whole well-filled bins of one parent into the other, drops the other's bins that
  hold a document twice, and best-fits the displaced documents, longest first;
* after each epoch every island sends its best packings on to the next island of its group.

Spark holds all state: pieces and elites are tables, an epoch is one cogrouped pass over (group, island).
After the last epoch the pieces of badly filled bins of all groups are dealt into new groups and packed
again, so that groups do not each leave a half-filled bin; this repeats ``TAILS`` times.

Defined cases: null or empty text is the end id alone (length 1); rows that repeat are packed each on its
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import chunks, doc_columns, ids_of, local_rows, staged
from sitecall.llm.tokens import tokenizer_path, word_ids

CAPACITY = 2048
END_ID = 0
GROUP = 4000
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CROSSOVERS = 5
ELITES = 2
TAILS = 2
TAIL_FILL = 0.985


# ---- pieces --------------------------------------------------------------------------------------


def _piece_batches(path: str, capacity: int):
    def run(batches):
        table = word_ids(path)
        for rb, data, off in chunks(batches, "text"):
            ids, at = table.encode_rows(data, off)
            ids = np.insert(ids, at[1:], END_ID).astype("<u4")
            at = at + np.arange(len(at))
            size = np.diff(at)
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            a = at[:-1][row] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * x : 4 * (x + n)]) for x, n in zip(a.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [ids_of(rb).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    rows = doc_columns(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_piece_batches(path or tokenizer_path(), capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# ---- one island ----------------------------------------------------------------------------------


class _Bins:
    """Bins under best fit: bit r of ``open`` says that some bin has r tokens of room."""

    def __init__(self, size: list[int], capacity: int):
        self.size, self.capacity = size, capacity
        self.bins: list[list[int]] = []
        self.room: dict[int, list[int]] = {}
        self.open = 0

    def add(self, items: list[int], room: int) -> None:
        self.bins.append(items)
        self._note(len(self.bins) - 1, room)

    def _note(self, b: int, room: int) -> None:
        if room:
            self.room.setdefault(room, []).append(b)
            self.open |= 1 << room

    def put(self, item: int) -> None:
        n = self.size[item]
        fits = self.open >> n
        if not fits:
            self.add([item], self.capacity - n)
            return
        room = n + (fits & -fits).bit_length() - 1
        at = self.room[room]
        b = at.pop()
        if not at:
            self.open ^= 1 << room
        self.bins[b].append(item)
        self._note(b, room - n)


def _pack(order, size: list[int], capacity: int) -> list[list[int]]:
    out = _Bins(size, capacity)
    for i in order:
        out.put(i)
    return out.bins


def _fitness(bins: list[list[int]], size: list[int], capacity: int) -> float:
    return sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(giver: list[list[int]], taker: list[list[int]], size: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Inject some of the giver's best-filled bins whole into the taker."""
    fill = np.array([sum(size[i] for i in b) for b in giver])
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = rng.choice(good, max(1, len(good) // 6), replace=False)
    injected = {i for b in chosen for i in giver[b]}
    out = _Bins(size, capacity)
    displaced: list[int] = []
    for b in chosen:
        out.add(list(giver[b]), int(capacity - fill[b]))
    loose = np.quantile([sum(size[i] for i in b) for b in taker], 0.1)
    for b in taker:
        total = sum(size[i] for i in b)
        if total <= loose or not injected.isdisjoint(b):  # duplicates, and the worst bins, are dissolved
            displaced.extend(i for i in b if i not in injected)
        else:
            out.add(list(b), capacity - total)
    displaced.sort(key=size.__getitem__, reverse=True)
    for i in displaced:
        out.put(i)
    return out.bins


def evolve(size: list[int], elites: list[list[list[int]]], capacity: int, rng: np.random.Generator, population: int = POPULATION, crossovers: int = CROSSOVERS) -> list[tuple[float, list[list[int]]]]:
    """One epoch of one island; elites that came in join its population. Best packing first."""
    down = sorted(range(len(size)), key=size.__getitem__, reverse=True)
    people = [(_fitness(e, size, capacity), e) for e in elites]
    if not people:
        people.append((0.0, _pack(down, size, capacity)))
    while len(people) < population:
        noise = np.array(size) * rng.uniform(0.8, 1.0, len(size))
        people.append((0.0, _pack(np.argsort(-noise, kind="stable").tolist(), size, capacity)))
    people = sorted(((_fitness(p, size, capacity), p) for _, p in people), key=lambda x: -x[0])[:population]
    for _ in range(crossovers):
        if len(people) < 2 or len(people[0][1]) < 4:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        child = crossover(people[a][1], people[b][1], size, capacity, rng)
        fit = _fitness(child, size, capacity)
        if fit > people[-1][0]:
            people[-1] = (fit, child)
            people.sort(key=lambda x: -x[0])
    return people


def _as_bins(assignment) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, b in enumerate(assignment):
        out.setdefault(int(b), []).append(i)
    return list(out.values())


def _as_assignment(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for b, items in enumerate(bins):
        out[items] = b
    return out


_STATE = "grp long, island int, elite int, fitness double, assignment array<int>"


def _epoch(epoch: int, capacity: int, seed: int):
    def run(key, items, state):
        grp, island = int(key[0]), int(key[1])
        items = items.sort_values("row_no")
        size = items["length"].tolist()
        if not size:
            return pd.DataFrame({"grp": [], "island": [], "elite": [], "fitness": [], "assignment": []})
        rng = np.random.default_rng([seed, epoch, grp, island])
        state = state.sort_values(["fitness", "island", "elite"], ascending=[False, True, True])
        best = evolve(size, [_as_bins(a) for a in state["assignment"]], capacity, rng)[:ELITES]
        return pd.DataFrame({"grp": grp, "island": island, "elite": range(len(best)), "fitness": [f for f, _ in best], "assignment": [_as_assignment(p, len(size)) for _, p in best]})

    return run


def _settle(key, items, state):
    """The group's best packing as rows: row_no, grp, bin, offset, fill of its bin."""
    items = items.sort_values("row_no").reset_index(drop=True)
    best = state.sort_values(["fitness", "island", "elite"], ascending=[False, True, True])
    items["bin"] = np.asarray(best["assignment"].iloc[0], np.int64) if len(best) else 0
    by = items.groupby("bin")["length"]
    items["offset"] = by.cumsum() - items["length"]
    items["fill"] = by.transform("sum")
    return items[["row_no", "grp", "bin", "offset", "fill"]]


# ---- all groups ----------------------------------------------------------------------------------


def _pack_groups(items: DataFrame, capacity: int, seed: int, name: str) -> DataFrame:
    """row_no, length -> row_no, grp, bin, offset, fill."""
    spark = items.sparkSession
    groups = max(1, -(-items.count() // GROUP))
    items = items.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), "row_no"), F.lit(groups)))
    on_islands = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    state = local_rows(spark, [], _STATE)
    for epoch in range(EPOCHS):
        moved = state.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        came = state.unionByName(moved) if ISLANDS > 1 else state
        evolved = on_islands.groupBy("grp", "island").cogroup(came.groupBy("grp", "island")).applyInPandas(_epoch(epoch, capacity, seed), _STATE)
        state = staged(evolved, f"{name}-epoch{epoch}")
    return items.groupBy("grp").cogroup(state.groupBy("grp")).applyInPandas(_settle, "row_no long, grp long, bin long, offset long, fill long")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, seed: int = 5) -> DataFrame:
    """Every piece of every document with its sequence_id and offset."""
    pieces = staged(token_pieces(docs, path, capacity).withColumn("row_no", F.monotonically_increasing_id()), "pack-pieces")
    full = pieces.filter(F.col("length") == capacity).select("row_no", (-F.col("row_no") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = pieces.filter(F.col("length") < capacity).select("row_no", "length")
    done = full
    for tail in range(TAILS + 1):
        packed = staged(_pack_groups(todo, capacity, seed + tail, f"pack-{tail}"), f"pack-bins{tail}")
        sequence = ((F.col("grp") * (TAILS + 1) + tail) * (1 << 20) + F.col("bin")).alias("sequence_id")
        last = tail == TAILS
        good = F.lit(True) if last else F.col("fill") >= int(TAIL_FILL * capacity)
        done = done.unionByName(packed.filter(good).select("row_no", sequence, "offset"))
        if not last:
            todo = packed.filter(~good).select("row_no").join(pieces.select("row_no", "length"), "row_no")
    return pieces.join(done, "row_no").drop("row_no")
