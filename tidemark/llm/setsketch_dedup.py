"""Near duplicates by SetSketch registers: candidates by bands, a joint likelihood, then exact sets.

A document's set of shingles becomes ``REGISTERS`` registers. Each holds the least
of the set's exponential hash values on an exponential scale, cut to 16 bits:
k = floor(1 - log_b(min)). Registers merge by their maximum, and two sets have
equal registers about as often as the sets are alike, so equal bands of registers
make candidates. Of two documents, the registers that are greater, less and equal
give the likelihood of a similarity, jointly with the known sizes; pairs for which
the threshold is beyond belief go. What is left is verified on the full sets.

Equal sets are one node throughout. In each bucket of a band the smallest node is
the hub, and a node is first held against the hub it shares most bands with, so a
group of near copies costs one pair a node, however large. Buckets that then
still hold nodes of several components are searched in pairs of blocks of bounded
size, for pairs of different components only; links that connect these leave the
task, no pairs. Links are those of the full sets; a pair is missed only if
all its bands differ (about 3 in a million at the threshold, before other paths).

Nulls: a null or wordless text has the empty set, linked with nothing. A row with
a null id is linked with nothing, has no component and is kept. Rows that share
an id are documents of their own. Other columns are not read, whatever their
names. Very long texts go in slices of whole rows. An empty table gives an empty
table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER_SPLIT_ON_BLANKS, cut, drop, map_arrow, mix64, named_rows, ranges, ship, slices, words
from tidemark.llm.components import components

BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65534  # of the registers' scale; they hold 0 to TOP + 1
DOUBT = 12.0  # log likelihood that a pair may lack at the threshold (about five standard deviations)
BLOCK, BLOCK_SHINGLES = 512, 2_000_000
FILTER_BITS = 1 << 22
FACTORS = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(texts: pa.Array, length: int) -> list[np.ndarray]:
    """Distinct hashes of each text's ``length``-word shingles; a shorter text is one shingle."""
    codes, vocabulary, counts = words(texts, LOWER_SPLIT_ON_BLANKS)
    if not vocabulary:
        return [np.zeros(0, np.uint64)] * len(counts)
    own = mix64(pd.util.hash_array(np.array(vocabulary, object), categorize=False))[codes]
    out, at = [], 0
    with np.errstate(over="ignore"):
        for n in counts.tolist():
            size = min(n, length)
            rolled = np.full(n - size + 1 if n else 0, np.uint64(size))
            for k in range(size):
                rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + own[at + k : at + k + len(rolled)])
            out.append(np.unique(rolled))
            at += n
    return out


def sketch(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers of sets that lie one after another, none empty."""
    starts = np.cumsum(sizes) - sizes
    least = np.empty((len(sizes), REGISTERS), np.uint64)
    with np.errstate(over="ignore"):
        for i, factor in enumerate(FACTORS):
            least[:, i] = np.minimum.reduceat(values * factor, starts)
    uniform = ((least >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    exponential = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key a band of each row of registers."""
    with np.errstate(over="ignore"):
        keys = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :].repeat(len(registers), 0)
        cells = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
        for k in range(ROWS):
            keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
    return keys.view(np.int64)


def _log_likelihood(similarity, more, less, u, v) -> np.ndarray:
    """Of registers of which ``more`` and ``less`` of the first set's are greater and smaller; u, v: the sizes' shares."""

    def differ(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = differ(u - v * similarity), differ(v - u * similarity)
    tiny = 1e-12
    equal = np.maximum(1 - up - down, tiny)
    return more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny)) + (REGISTERS - more - less) * np.log(equal)


def estimate(more, less, n_a, n_b, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(likeliest similarity, whether the threshold is still to be believed) of pairs."""
    more, less, n_a, n_b = (np.asarray(x, np.float64) for x in (more, less, n_a, n_b))
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(u / v, v / u)
    lo, hi = np.zeros_like(most), most.copy()
    for _ in range(30):  # the likelihood has one peak
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        up = _log_likelihood(a, more, less, u, v) < _log_likelihood(b, more, less, u, v)
        lo, hi = np.where(up, a, lo), np.where(up, hi, b)
    best = (lo + hi) / 2
    lacks = _log_likelihood(best, more, less, u, v) - _log_likelihood(np.minimum(threshold, most), more, less, u, v)
    return best, (most >= threshold - 1e-12) & ((best >= threshold) | (lacks <= DOUBT))


def described(rows: DataFrame, length: int) -> DataFrame:
    """row, doc_id, n (set size), set_a and set_b (a 128-bit name of the set), registers (of non-empty sets)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = shingles(part.column("text"), length)
                sizes = np.array([len(s) for s in sets], np.int64)
                filled = [s for s in sets if len(s)]
                held = sketch(np.concatenate(filled), sizes[sizes > 0]) if filled else np.zeros((0, REGISTERS), np.uint16)
                cells = np.cumsum(sizes > 0) - 1
                registers = [held[c].tobytes() if n else None for c, n in zip(cells.tolist(), sizes.tolist(), strict=True)]
                names = [[int(mix64(s ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (11, 13)]
                columns = [part.column("row"), part.column("doc_id"), pa.array(sizes), *(pa.array(x, pa.int64()) for x in names), pa.array(registers, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n", "set_a", "set_b", "registers"])

    return map_arrow(rows, run, "row long, doc_id long, n long, set_a long, set_b long, registers binary")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def banded(nodes: DataFrame) -> DataFrame:
    """key, node: one row a band."""

    def run(batches):
        for batch in batches:
            keys = band_keys(_registers(batch.column("registers")))
            ids = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "node"])

    return map_arrow(nodes.select("node", "registers"), run, "key long, node long")


def believed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose registers leave the threshold possible."""
    x = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    y = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    met = pairs.select("a", "b").join(x, "a").join(y, "b").filter(fits)

    def run(batches):
        for batch in batches:
            a, b = _registers(batch.column("r_a")), _registers(batch.column("r_b"))
            sizes = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            _, some = estimate((a > b).sum(axis=1), (a < b).sum(axis=1), *sizes, percent / 100)
            yield batch.select(["a", "b"]).filter(pa.array(some))

    return map_arrow(met, run, "a long, b long")


def sets_of(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """node, shingles of the wanted rows; a table of bits, of fixed size, spares most other texts."""
    slot = F.pmod(F.xxhash64("row"), F.lit(FILTER_BITS)).cast("int")
    marked = wanted.select(F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)).cast("int").alias("slot")).distinct().toArrow()
    bits = np.zeros(FILTER_BITS, bool)
    bits[marked.column("slot").to_numpy()] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches):
        flags = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            some = batch.filter(pa.array(flags[batch.column("slot").to_numpy()]))
            for part in slices(some, "text", 1 << 20):
                sets = shingles(part.column("text"), length)
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], ["node", "shingles"])

    found = map_arrow(rows.select("row", "text", slot.alias("slot")), run, "node long, shingles array<long>")
    return found.join(wanted, "node", "left_semi")


def verified(pairs: DataFrame, rows: DataFrame, percent: int, length: int) -> DataFrame:
    """The pairs (a, b) that link by their full sets."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = cut(sets_of(rows, wanted, length), "full-sets")
    x, y = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s_{c}")) for c in ("a", "b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    links = pairs.join(x, "a").join(y, "b").filter(100 * common >= percent * (F.size("s_a") + F.size("s_b") - common)).select("a", "b")
    links = cut(links, "links")
    drop(sets)
    return links


def labels_of(links: DataFrame) -> DataFrame:
    return cut(components(links).withColumnRenamed("id", "node").withColumnRenamed("component", "label"), "labels")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of a node, itself if it has no link yet."""
    named = labels.select(F.col("node").alias(node), F.col("label").alias(name))
    return rows.join(named, node, "left").withColumn(name, F.coalesce(name, node))


def _differing(registers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many registers of each of ``rows`` are greater and smaller than those of every set (at most 255 registers)."""
    more, less = np.zeros((2, len(rows), len(registers)), np.uint8)
    for r in np.ascontiguousarray(registers.T):
        more += r[rows, None] > r[None, :]
        less += r[rows, None] < r[None, :]
    return more, less


def _search(percent: int):
    """Links between different components in two blocks of a bucket, as many as connect what they connect.

    Registers choose the pairs, the full sets decide.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        node, n = (group[c].to_numpy() for c in ("node", "n"))
        names, of = np.unique(group["label"].to_numpy(), return_inverse=True)
        rows = np.flatnonzero(of != np.bincount(of).argmax())  # every pair of components has one outside the largest
        registers = np.frombuffer(b"".join(group["registers"]), np.uint16).reshape(-1, REGISTERS)
        more, less = _differing(registers, rows)
        i, j = np.nonzero((of[rows, None] != of[None, :]) & (100 * np.minimum(n[rows, None], n) >= percent * np.maximum(n[rows, None], n)))
        _, some = estimate(more[i, j], less[i, j], n[rows[i]], n[j], percent / 100)
        i, j = rows[i[some]], j[some]
        sizes = np.array([len(x) for x in group["shingles"]])
        values, codes = np.unique(np.concatenate(group["shingles"].to_numpy()), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        held = np.zeros(len(values), bool)
        links = []
        for x in np.unique(i):
            others = j[i == x]
            others = others[of[others] != of[x]]
            if not len(others):
                continue
            own = codes[starts[x] : starts[x] + sizes[x]]
            held[own] = True
            met = held[codes[ranges(starts[others], sizes[others])]]
            held[own] = False
            common = np.add.reduceat(met, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
            for y in others[100 * common >= percent * (sizes[x] + sizes[others] - common)]:
                if of[y] != of[x]:
                    links.append((max(node[x], node[y]), min(node[x], node[y])))
                    of[of == of[y]] = of[x]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _leftover(buckets: DataFrame, nodes: DataFrame, rows: DataFrame, labels: DataFrame, percent: int, length: int) -> DataFrame:
    """Links that hubs did not see, in buckets of several components; equal buckets are searched once."""
    named = _labelled(buckets, labels, "node", "label").join(nodes.select("node", "n"), "node")
    of_key = named.groupBy("key").agg(
        F.count("*").alias("size"),
        F.sum("n").alias("weight"),
        F.min("label").alias("lo"),
        F.max("label").alias("hi"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    mixed = of_key.filter((F.col("size") > 2) & (F.col("lo") != F.col("hi")))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).alias("blocks")
    once = cut(mixed.groupBy("size", "weight", "x", "y").agg(F.min("key").alias("key")).select("key", blocks), "mixed-buckets")
    held = named.drop("n").join(once, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = held.withColumn("other", other).select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "label")
    dealt = cut(dealt, "dealt")
    wanted = dealt.select("node").distinct()
    sets = cut(nodes.join(sets_of(rows, wanted, length), "node"), "full-sets")
    links = cut(dealt.join(sets, "node").groupBy("key", "i", "j").applyInPandas(_search(percent), "a long, b long"), "links")
    drop(once, dealt, sets)
    return links


def near_duplicates(docs: DataFrame, percent: int = 80, length: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = named_rows(plain, "doc_id", "text", "row")
    known = rows.filter(F.col("row").isNotNull())
    sets = cut(described(rows, length), "sketches")
    filled = sets.filter((F.col("n") > 0) & F.col("row").isNotNull())
    # rows are numbered in the order of the ids, so the least of both belong together
    classes = cut(filled.groupBy("set_a", "set_b").agg(F.min("row").alias("node"), F.min("doc_id").alias("node_id")), "classes")
    # different sets of fewer shingles can't link
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    nodes = filled.filter(F.col("n") >= least).select(F.col("row").alias("node"), "n", "registers").join(classes.select("node"), "node", "left_semi")
    nodes = cut(nodes, "nodes")
    keys = banded(nodes)
    shared = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter(F.col("hub") != F.col("other")).drop("other")
    buckets = cut(keys.join(cut(shared, "hubs"), "key"), "buckets")
    spokes = buckets.filter(F.col("node") != F.col("hub")).groupBy("node", "hub").agg(F.count("*").alias("bands"))
    spokes = cut(spokes.withColumnRenamed("node", "a").withColumnRenamed("hub", "b"), "spokes")

    def of(pairs: DataFrame) -> DataFrame:
        return verified(cut(believed(pairs, nodes, percent), "believed"), known, percent, length)

    best = spokes.groupBy("a").agg(F.max_by("b", F.struct("bands", -F.col("b"))).alias("b"))
    best = cut(best, "best-hubs")
    links = of(best)
    labels = labels_of(links)
    apart = _labelled(_labelled(spokes, labels, "a", "of_a"), labels, "b", "of_b").filter(F.col("of_a") != F.col("of_b"))
    more = of(apart.select("a", "b").join(best, ["a", "b"], "left_anti"))
    links = cut(links.unionByName(more), "links")
    more = _leftover(buckets, nodes, known, labels_of(links), percent, length)
    labels = labels_of(links.unionByName(more))
    reached = labels.join(classes.select(F.col("node").alias("label"), F.col("node_id").alias("component")), "label").select("node", "component")
    named = cut(classes.join(reached, "node", "left").select("set_a", "set_b", F.coalesce("component", "node_id").alias("component")), "components")
    out = sets.drop("registers").join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("row").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("doc_id")))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
