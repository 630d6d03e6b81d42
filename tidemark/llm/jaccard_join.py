"""N-gram Jaccard join: an exact join in the metric space of shingle sets.

Jaccard distance is a metric. Documents of unrelated text are all at distance 1
from each other and from any pivot, so pivots alone tell nothing apart at the
top. The first regions therefore come from projections, where the bound is the
triangle inequality on symmetric differences: two sets within the threshold
differ in at most (1-t)/(1+t) of their summed sizes, so of more blocks of
shingles than that, at least one is the same in both. Two sets that agree in a block
are a candidate pair if their sizes and bit sketches allow the similarity (each
shingle turns one bit over, so sketches differ in no more bits than sets in
shingles); sets with a block that more than ``PAIRED`` documents have are tied to the
least of these without that test. Regions are connected components of
candidates, and every link lies inside one region.

Regions then join recursively. One that is too large for a task is split:
sampled documents are its pivots, each document goes to the Voronoi cell of its
nearest pivot, and also to every cell whose pivot is at most 2e farther away (e
the distance threshold), because a partner's nearest pivot can be at most that
much off. Cells are regions again. A region that its pivots can't split (all its
sets lie within a few e) is joined block by block. A region that fits a task is
joined exactly by counting common shingles.

Equal sets are one node throughout; links are kept as stars, so a group of g
copies costs g rows. Pairs are only formed inside a task.

Shingles are 64-bit hashes of word triples. Nulls: a null or wordless text has
the empty set, linked with nothing. Rows with a null id are dropped from
linking and get a null component. Rows that share an id are one document: its
links are those of any of its rows. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER_SPLIT_ON_BLANKS, cut, drop, map_arrow, mix64, ship, slices, spans_to_rows, words
from tidemark.llm.components import components

REGION_DOCS = 1024
REGION_SHINGLES = 2_000_000
FILTER_BITS = 1 << 22
TILE = 4096
PAIRED = 8
SKETCH_BITS = 64


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``percent`` / 100."""

    percent: int

    def differing(self, summed: int) -> int:
        """Most shingles in which linked sets of ``summed`` shingles together can differ."""
        return summed * (100 - self.percent) // (100 + self.percent)

    def larger(self, size: int) -> int:
        """Most shingles of a set linked with one of ``size``."""
        return size * 100 // self.percent

    @property
    def distance(self) -> float:
        return 1 - self.percent / 100

    def bands(self, largest: int) -> np.ndarray:
        """First size of each band of sizes; linked sets are in the same or in neighbouring bands."""
        out = [1]
        while out[-1] <= largest:
            out.append(self.larger(out[-1]) + 1)
        return np.array(out)


def shingles(texts: pa.Array, length: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``length``-word shingles (a shorter text is one)."""
    codes, vocabulary, counts = words(texts, LOWER_SPLIT_ON_BLANKS)
    hashed = pd.util.hash_array(np.array(vocabulary, object), categorize=False) if vocabulary else np.zeros(0, np.uint64)
    hashed = mix64(hashed)
    out, at = [], 0
    with np.errstate(over="ignore"):
        own = hashed[codes]
        rolled = np.zeros(max(0, len(own) - length + 1), np.uint64)
        for k in range(length):
            rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(rolled)])
        for n in counts.tolist():
            if n >= length:
                out.append(np.unique(rolled[at : at + n - length + 1]))
            elif n:
                whole = np.uint64(n)
                for x in own[at : at + n]:
                    whole = mix64(np.array([whole * np.uint64(0x9E3779B97F4A7C15) + x]))[0]
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
    return out


def block_keys(values: np.ndarray, t: Threshold, bands: np.ndarray) -> np.ndarray:
    """Keys of the set's blocks, in its own size band and the next.

    Differences spoil at most ``most`` blocks, so of the first ``most`` + 1 filled
    blocks in an order that all sets share, at least one is the same in the partner,
    and it is among the first of the one whose order ends earlier. The order is by
    shingles in the block, most first: a block of one common shingle tells nothing.
    Only sets with fewer filled blocks also give keys to their empty ones.
    """
    band = int(np.searchsorted(bands, len(values), side="right")) - 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(0x5851F42D4C957F2D)))])
        keys = []
        for b in (band, band + 1):
            most = t.differing(2 * int(bands[b + 1] - 1))
            blocks = 2 * most + 2
            edges = np.searchsorted(values >> np.uint64(32), (np.arange(blocks + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(blocks))
            weight = edges[1:] - edges[:-1]
            filled = np.flatnonzero(weight)
            place = mix64(np.arange(blocks, dtype=np.uint64) + np.uint64((b + 1) << 40))
            own = mix64(sums[edges[1:]] - sums[edges[:-1]] + place)
            if len(filled) > most:
                own = own[filled[np.lexsort((own[filled], -weight[filled]))[: most + 1]]]
            keys.append(own)
    return np.concatenate(keys).view(np.int64)


def sketch(values: np.ndarray) -> bytes:
    """Each shingle turns one bit over; of a power of two of bits, at least as many as there are shingles."""
    bits = max(SKETCH_BITS, 1 << max(0, len(values) - 1).bit_length())
    turned = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(turned.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of bytes) as they would be with ``width`` bytes."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def possible(batch: pa.RecordBatch, t: Threshold) -> np.ndarray:
    """Which rows (n_a, bits_a, n_b, bits_b) may be linked sets."""
    n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
    near = 100 * np.minimum(n_a, n_b) >= t.percent * np.maximum(n_a, n_b)
    held = {c: batch.column(c).to_pylist() for c in ("bits_a", "bits_b")}
    widths = {c: np.array([len(x) for x in held[c]], np.int64) for c in held}
    for w_a, w_b in {*zip(widths["bits_a"][near].tolist(), widths["bits_b"][near].tolist(), strict=True)}:
        rows = np.flatnonzero(near & (widths["bits_a"] == w_a) & (widths["bits_b"] == w_b))
        a, b = (folded(np.frombuffer(b"".join(held[c][i] for i in rows), np.uint8).reshape(len(rows), w), min(w_a, w_b)) for c, w in (("bits_a", w_a), ("bits_b", w_b)))
        differing = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        near[rows] = differing <= t.differing(n_a[rows] + n_b[rows])
    return near


def described(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n (set size), set_a and set_b (a 128-bit name of the set), bits (its sketch)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(part.column("text"), length)
                with np.errstate(over="ignore"):
                    names = [[int(mix64(s ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (11, 13)]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                bits = pa.array([sketch(s) for s in sets], pa.binary())
                columns = [part.column("doc_id"), sizes, pa.array(names[0], pa.int64()), pa.array(names[1], pa.int64()), bits]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_a", "set_b", "bits"])

    return map_arrow(docs, run, "doc_id long, n long, set_a long, set_b long, bits binary")


def keyed(docs: DataFrame, t: Threshold, length: int) -> DataFrame:
    """doc_id, key: one row a block of each document's set."""

    def run(batches):
        bands = t.bands(1 << 40)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(part.column("text"), length)
                keys = [block_keys(s, t, bands) if len(s) else np.zeros(0, np.int64) for s in sets]
                ids = part.column("doc_id").take(pa.array(spans_to_rows(np.array([len(k) for k in keys], np.int64))))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))], ["doc_id", "key"])

    return map_arrow(docs, run, "doc_id long, key long")


def agreements(keys: DataFrame, nodes: DataFrame, t: Threshold) -> DataFrame:
    """a, b: pairs of ``nodes`` (node, n, bits) that connect all that may be linked and share a key."""
    of_key = Window.partitionBy("key").orderBy("doc_id")
    whole = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = keys.select(
        F.col("doc_id").alias("a"),
        F.count("*").over(whole).alias("together"),
        F.min("doc_id").over(whole).alias("least"),
        F.collect_list("doc_id").over(of_key.rowsBetween(1 - PAIRED, -1)).alias("earlier"),
    )
    few = F.col("together") <= PAIRED
    others = F.when(few, F.col("earlier")).when(F.col("a") != F.col("least"), F.array("least"))
    # the least document of a key is a node if any is, as all equal sets agree; of the others only nodes are wanted
    pairs = met.filter("together > 1").select("a", F.explode(others).alias("b"), (~few).alias("sure")).filter("a != b").groupBy("a", "b").agg(F.max("sure").alias("sure"))
    pairs = cut(pairs, "pairs", release=True)
    of_a, of_b = (nodes.select(*(F.col(c).alias(f"{x}{y}") for c, x, y in (("node", "", s), ("n", "n_", s), ("bits", "bits_", s)))) for s in ("a", "b"))
    tested = map_arrow(
        pairs.filter("not sure").join(of_a, "a").join(of_b, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b"),
        lambda batches: (batch.filter(pa.array(possible(batch, t))).select(["a", "b"]) for batch in batches),
        "a long, b long",
    )
    sure = pairs.filter("sure").select("a", "b").join(of_a.select("a"), "a", "left_semi")
    out = cut(tested.unionByName(sure), "agreements", release=True)
    drop(pairs)
    return out


def needed_sets(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """doc_id, n, shingles of the wanted documents.

    One bit an id, hashed to a fixed number of bits, lets most other texts be
    skipped before anything is shuffled; an exact join follows.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    bits = np.zeros(FILTER_BITS, bool)
    marked = wanted.select(slot.alias("slot")).distinct().toArrow().column("slot").to_numpy()
    bits[marked] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches):
        flags = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            some = batch.filter(pa.array(flags[batch.column("slot").to_numpy()]))
            for part in slices(some, "text"):
                sets = shingles(part.column("text"), length)
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                    ["doc_id", "n", "shingles"],
                )

    found = map_arrow(docs.withColumn("slot", slot), run, "doc_id long, n long, shingles array<long>")
    return found.filter(F.col("n") > 0).join(wanted, "doc_id")


def linked(sets: list[np.ndarray], t: Threshold, others: int | None = None) -> list[tuple[int, int]]:
    """A spanning star of each component of the exact links among the sets.

    With ``others``, sets from that place on are only compared with those before.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    everything = np.concatenate(sets)
    values, column, times = np.unique(everything, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    common = times[column] > 1  # a shingle of one set adds to no intersection
    row, column = row[common], (np.cumsum(times > 1) - 1)[column[common]]
    width = int((times > 1).sum())
    inter = np.zeros((n, n), np.float32)
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    for a in range(0, width, TILE):
        lo, hi = np.searchsorted(column, [a, a + TILE])
        dense = np.zeros((n, min(TILE, width - a)), np.float32)
        dense[row[lo:hi], column[lo:hi] - a] = 1
        inter += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - inter
    near = 100 * inter.astype(np.float64) >= t.percent * union.astype(np.float64)
    np.fill_diagonal(near, True)
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return [(i, int(label[i])) for i in range(n) if label[i] != i]


def distances(sets: list[np.ndarray], pivots: list[np.ndarray]) -> np.ndarray:
    """Jaccard distance of every set to every pivot."""
    out = np.empty((len(sets), len(pivots)))
    for j, p in enumerate(pivots):
        for i, s in enumerate(sets):
            inter = int(np.isin(s, p, assume_unique=True).sum()) if len(s) <= len(p) else int(np.isin(p, s, assume_unique=True).sum())
            out[i, j] = 1 - inter / (len(s) + len(p) - inter)
    return out


LINKS = "a long, b long"
MEMBERS = "region long, doc_id long, n long, shingles array<long>"


def _as_sets(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.asarray(x).view(np.uint64) for x in rows["shingles"]]


def _join_whole(t: Threshold):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids = rows["doc_id"].to_numpy()
        found = linked(_as_sets(rows), t) if len(rows) > 1 else []
        return pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return run


CELLS = "region long, doc_id long, pivot long, near boolean"


def _cells(t: Threshold):
    """Cells of each document of one part of a region: a row for each pivot in its 2e window."""

    def run(part: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if part.empty or pivots.empty:
            return pd.DataFrame(columns=["region", "doc_id", "pivot", "near"])
        d = distances(_as_sets(part), _as_sets(pivots))
        i, j = np.nonzero(d <= d.min(axis=1, keepdims=True) + 2 * t.distance + 1e-9)
        out = part.iloc[i][["region", "doc_id"]].copy()
        out["pivot"] = pivots["doc_id"].to_numpy()[j]
        out["near"] = d[i, j] <= t.distance
        return out

    return run


def join_regions(members: DataFrame, t: Threshold, region_docs: int = REGION_DOCS, region_shingles: int = REGION_SHINGLES, splits: int = 4) -> DataFrame:
    """Links (a, b) that connect exactly what the links within each region connect."""
    ship(members.sparkSession)
    links, depth = [], 0
    while True:
        sizes = members.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("weight"))
        sizes = cut(sizes.withColumn("fits", (F.col("docs") <= region_docs) & (F.col("weight") <= region_shingles)), "regions")
        small = members.join(sizes.filter("fits").select("region"), "region", "left_semi")
        links.append(cut(small.groupBy("region").applyInPandas(_join_whole(t), LINKS), "region-links"))
        large = sizes.filter(~F.col("fits"))
        if large.isEmpty():
            break
        over = cut(members.join(large, "region"), "large-regions")
        if depth == splits:
            links.append(cut(_join_blocks(over, t, region_docs, region_shingles), "block-links"))
            break
        parts = F.greatest(F.ceil(F.col("docs") / region_docs), F.ceil(F.col("weight") / region_shingles))
        chance = F.pmod(F.xxhash64("doc_id", F.lit(depth)), F.lit(1 << 30)) / (1 << 30)
        # about four pivots a part, of which no region has more than 64; the one of least hash is always one
        first = over.groupBy("region").agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(depth)).alias("h"), "doc_id"))["doc_id"].alias("first"))
        is_pivot = (chance < F.least(4 * parts, F.lit(64)) / F.col("docs")) | (F.col("doc_id") == F.col("first"))
        pivots = over.join(first, "region").filter(is_pivot).select("region", "doc_id", "shingles", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
        pivots = cut(pivots, "pivots")  # its own columns, as both sides of the cogroup come from one table
        dealt = over.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), parts))
        cells = dealt.groupBy("region", "part").cogroup(pivots.groupBy("region", "part")).applyInPandas(_cells(t), CELLS)
        cells = cut(cells, "cells")
        links.append(cells.filter("near").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")))
        # a region splits if no cell holds more than half of it and the cells cost less than its blocks would
        filled = cells.groupBy("region", "pivot").agg(F.count("*").alias("c")).groupBy("region").agg(F.max("c").alias("most"), F.sum("c").alias("rows"))
        apart = (2 * F.col("most") <= F.col("docs")) & (F.col("rows") < F.col("docs") * _blocks(region_docs, region_shingles))
        splits_up = cut(filled.join(large, "region").filter(apart).select("region"), "split-regions")
        tight = over.join(splits_up, "region", "left_anti")
        links.append(cut(_join_blocks(tight, t, region_docs, region_shingles), "block-links"))
        held = over.join(splits_up, "region", "left_semi").select("region", "doc_id", "n", "shingles")
        split = cells.join(held, ["region", "doc_id"]).select(F.xxhash64("region", "pivot").alias("region"), "doc_id", "n", "shingles")
        split = cut(split, "members", release=True)
        drop(over, pivots, splits_up, *([members] if depth else []))  # the first members are the caller's
        members = split
        depth += 1
    if depth:
        drop(members)
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _blocks(region_docs: int, region_shingles: int):
    """Blocks of a region of which any two fit into one task."""
    return 2 * F.greatest(F.ceil(F.col("docs") / region_docs), F.ceil(F.col("weight") / region_shingles))


def _join_blocks(over: DataFrame, t: Threshold, region_docs: int, region_shingles: int) -> DataFrame:
    """Every pair of blocks of a region that pivots could not split is one bounded task."""
    own = over.withColumn("blocks", _blocks(region_docs, region_shingles)).withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("block")), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = own.withColumn("other", other).select(
        F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "doc_id", "n", "shingles"
    )
    return pairs.groupBy("region").applyInPandas(_join_whole(t), LINKS)


def similar(docs: DataFrame, percent: int = 90, length: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    t = Threshold(percent)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = rows.filter(F.col("doc_id").isNotNull())
    named = cut(described(rows, length), "sets")
    # equal sets are one node, named by its smallest id
    sized = named.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = cut(sized.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "classes", release=True)
    own = sized.join(classes, (sized["doc_id"] == classes["node"]) & (sized["set_a"] == classes["set_a"]) & (sized["set_b"] == classes["set_b"]), "left_semi")
    own = own.dropDuplicates(["doc_id", "set_a", "set_b"])  # an id may have several sets, and rows that come twice
    nodes = cut(own.select(F.col("doc_id").alias("node"), "n", "bits"), "nodes", release=True)
    agree = agreements(keyed(known, t, length), nodes, t)
    drop(nodes)
    regions = cut(components(agree).withColumnRenamed("component", "region").withColumnRenamed("id", "doc_id"), "candidates")
    members = cut(needed_sets(known, regions, length).select("region", "doc_id", "n", "shingles"), "members", release=True)
    drop(regions, agree)
    found = cut(join_regions(members, t), "found", release=True)
    drop(members)
    reached = cut(components(found), "components")
    labelled = classes.join(reached, F.col("node") == F.col("id"), "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("component_id")
    )
    labelled = cut(labelled, "labelled")
    return named.join(labelled, ["set_a", "set_b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
