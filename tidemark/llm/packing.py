"""Best-fit packing: a grouping genetic algorithm on islands with elite migration.

Documents longer than a sequence are cut into full pieces (the first piece may
be shorter). The pieces are dealt by a hash into regions of about
``region_items`` pieces, and every region is evolved by several islands. An
individual is a grouping: a list of bins. Crossover puts whole well-filled bins
of one parent into the other, drops the bins that hold a piece twice and
best-fits what they held besides; mutation dissolves badly filled bins. Each
island then sends its best grouping to its neighbour, evolves again with the
immigrant, and the region keeps the grouping with the fewest bins. Bins that
are not full are dissolved and their pieces go to the next round, in fewer
regions, until one region is left; so the waste is that of the last region.

Every region and island is a group of bounded size; only lengths move.

Nulls: a null text is an empty one; its piece holds the end id alone. Repeated
rows (even the same document id) are packed each for itself. An empty table
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, map_arrow, ship, slices
from tidemark.llm.tokens import encoder, ids_crc32

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, added_tokens: bool = False, keep_words: bool = True
) -> DataFrame:
    """Encode every whole text, append the end id and cut what is longer than ``capacity``.

    Without ``keep_words`` a worker forgets the words it has met when a task's input ends.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        enc, end = encoder(tokenizer, added_tokens), np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = enc.encode(part.column("text"))
                out, at = [], 0
                for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                    own = np.concatenate([ids[at : at + n], end])
                    at += n
                    first = len(own) % capacity or capacity
                    edges = [0, *range(first, len(own) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        out.append((doc_id, k, a, b - a, ids_crc32(own[a:b]), *([own[a:b].tolist()] if with_ids else [])))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names)
        if not keep_words:
            enc.forget()

    return map_arrow(rows, run, PIECES + ", ids array<long>" * with_ids)


class _Open:
    """Bins by free room, with a bit for each room that some bin has."""

    def __init__(self, capacity: int):
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, bin_no: int, room: int) -> None:
        self.at[room].append(bin_no)
        self.mask |= 1 << room

    def fullest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room of at least ``size``."""
        fits = self.mask >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        bin_no = self.at[room].pop()
        if not self.at[room]:
            self.mask ^= 1 << room
        return bin_no, room


Grouping = list[list[int]]


def best_fit(bins: Grouping, items: list[int], sizes: list[int], capacity: int) -> Grouping:
    """Add items, the longest first, each to the fullest bin that has room."""
    bins, free = [list(b) for b in bins], _Open(capacity)
    for k, b in enumerate(bins):
        free.add(k, capacity - sum(sizes[i] for i in b))
    for i in items if len(items) < 2 else sorted(items, key=sizes.__getitem__, reverse=True):
        found = free.fullest(sizes[i])
        if found is None:
            found = (len(bins), capacity)
            bins.append([])
        bins[found[0]].append(i)
        free.add(found[0], found[1] - sizes[i])
    return bins


def _fitness(bins: Grouping, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _crossover(to: Grouping, giver: Grouping, sizes, capacity, rng) -> Grouping:
    """Whole well-filled bins of ``giver`` go into ``to``; bins with a piece twice go, the rest of them is best-fitted."""
    well = sorted(giver, key=lambda b: -sum(sizes[i] for i in b))[: max(1, len(giver) // 2)]
    given = [b for b in well if rng.random() < 0.5] or well[:1]
    inside = {i for b in given for i in b}
    kept, displaced = [], []
    for b in to:
        if inside.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in inside]
    return best_fit(given + kept, displaced, sizes, capacity)


def _mutate(bins: Grouping, sizes, capacity, rng) -> Grouping:
    """Dissolve the worst-filled bins and some others."""
    order = sorted(range(len(bins)), key=lambda k: sum(sizes[i] for i in bins[k]))
    gone = {*order[: max(2, len(bins) // 50)], *rng.sample(order, min(len(order), max(1, len(bins) // 25)))}
    return best_fit([b for k, b in enumerate(bins) if k not in gone], [i for k in gone for i in bins[k]], sizes, capacity)


def evolve(sizes: list[int], capacity: int, seed: int, migrants: list[Grouping], population: int = 4, generations: int = 12) -> Grouping:
    """The best grouping after some generations, or as soon as no fewer bins are possible."""
    rng, everything = random.Random(seed), list(range(len(sizes)))
    least = -(-sum(sizes) // capacity)
    worth = lambda g: _fitness(g, sizes, capacity)
    group = list(migrants) or [best_fit([], everything, sizes, capacity)]
    while len(group) < population and min(map(len, group)) > least:
        some = rng.sample(everything, len(everything) // 4)
        rest = set(everything).difference(some)
        group.append(best_fit(best_fit([], some, sizes, capacity), sorted(rest), sizes, capacity))
    group.sort(key=worth)
    for _ in range(generations):
        if len(group[0]) <= least:
            break
        a, b = rng.sample(group, 2)
        child = _crossover(a, b, sizes, capacity, rng)
        if rng.random() < 0.5:
            child = _mutate(child, sizes, capacity, rng)
        group = sorted([*group, child], key=worth)[:population]
    return group[0]


def _grouping(bins: pd.Series) -> Grouping:
    return [list(map(int, v)) for v in pd.Series(range(len(bins))).groupby(bins.to_numpy()).groups.values()]


def _phase(capacity: int, turn: int):
    """One evolution of one island; rows of ``elite`` islands are groupings to begin with."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        region, island = key
        rows = rows.sort_values(["elite", "item"], kind="stable")
        first = rows[rows["elite"] == rows["elite"].iloc[0]].reset_index(drop=True)
        migrants = [_grouping(g["bin"]) for e, g in rows.groupby("elite") if e >= 0]
        sizes = first["length"].tolist()
        best = evolve(sizes, capacity, hash((region, island, turn)) & 0x7FFFFFFF, migrants)
        number = np.zeros(len(sizes), np.int64)
        for k, b in enumerate(best):
            number[b] = k
        fill = np.bincount(number, weights=sizes)[number].astype(np.int64)
        return first[["item", "length"]].assign(region=region, island=island, elite=island, bin=number, fill=fill, bins=len(best))

    return run


STATE = "region long, island int, elite int, item long, length long, bin long, fill long, bins long"


def _round(items: DataFrame, regions: int, islands: int, capacity: int) -> DataFrame:
    """The best grouping of every region: region, item, length, bin, fill."""
    columns = [c.split()[0] for c in STATE.split(", ")]
    start = items.select(
        F.pmod(F.xxhash64("item", F.lit(regions)), F.lit(regions)).alias("region"),
        F.explode(F.array(*(F.lit(k) for k in range(islands)))).alias("island"),
        F.lit(-1).alias("elite"),
        "item",
        "length",
        *(F.lit(0).cast("long").alias(c) for c in ("bin", "fill", "bins")),
    )
    ship(items.sparkSession)
    grown = start.groupBy("region", "island").applyInPandas(_phase(capacity, 0), STATE).select(*columns)
    if islands > 1:
        # every island's elite also goes to the next island
        sent = grown.withColumn("island", F.explode(F.array(F.col("elite"), (F.col("elite") + 1) % islands)))
        grown = sent.groupBy("region", "island").applyInPandas(_phase(capacity, 1), STATE).select(*columns)
    grown = cut(grown, "islands")
    best = grown.groupBy("region").agg(F.min(F.struct("bins", "island")).alias("best"))
    return grown.join(best, "region").filter(F.col("island") == F.col("best.island")).select("region", "item", "length", "bin", "fill")


def pack(items: DataFrame, capacity: int = 2048, region_items: int = 4096, islands: int = 2, full: float = 0.995) -> DataFrame:
    """Pack rows with a column ``length``: adds sequence_id and offset.

    Lengths must be from 1 to ``capacity``. Bins filled below ``full`` of the
    capacity are packed anew in the next round, while that makes regions fewer.
    """
    named = cut(items.withColumn("item", F.monotonically_increasing_id()), "pieces")
    open_items = named.select("item", "length").filter(F.col("length") < capacity)
    n, turn = open_items.count(), 0
    closed = named.filter(F.col("length") >= capacity).select("item", "length", F.lit(-1).alias("turn"), F.col("item").alias("region"), F.lit(0).cast("long").alias("bin"))
    regions = max(1, -(-n // region_items))
    while True:
        placed = _round(open_items, regions, islands, capacity)
        rest = placed.filter(F.col("fill") < full * capacity)
        fewer = max(1, -(-rest.count() // region_items))
        last = fewer >= regions  # regions hold a bounded number of pieces also where no bin can be filled
        shut = placed if last else placed.filter(F.col("fill") >= full * capacity)
        closed = closed.unionByName(shut.select("item", "length", F.lit(turn).alias("turn"), "region", "bin"))
        if last:
            break
        open_items, regions, turn = cut(rest.select("item", "length"), "open"), fewer, turn + 1
    closed = cut(closed, "sequences")
    bins = closed.groupBy("turn", "region", "bin").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("held"))
    numbered = bins.withColumn("sequence_id", F.monotonically_increasing_id())
    offsets = F.transform(
        F.sequence(F.lit(0), F.size("held") - 1),
        lambda k: F.struct(
            F.get(F.col("held.item"), k).alias("item"),
            F.aggregate(F.slice(F.col("held.length"), F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x).alias("offset"),
        ),
    )
    where = numbered.select("sequence_id", F.explode(offsets).alias("x")).select("sequence_id", "x.item", "x.offset")
    return named.join(cut(where, "offsets"), "item").drop("item")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False, **columns) -> DataFrame:
    """Encode, cut and pack whole documents; one row a piece."""
    return pack(pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids, **columns), capacity)
