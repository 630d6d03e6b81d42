"""Benchmark decontamination: a broadcast set of normalised item n-grams, scanned over all token windows.

Words of items and documents are lower-cased runs of letters, digits and
non-ASCII bytes. A window is ``n`` words of an item (a shorter item is one
window). Each document's words are numbered by the items' vocabulary, rolling
hashes of all its windows are looked up in the sorted set of item hashes, and
every hit is verified on the words themselves before it counts. Callers drop
the documents that were hit, or take the text with the hit spans cut out.

The items are broadcast in blocks of about ``block_words`` words; documents
are scanned once a block, so a large benchmark takes more passes and not more
memory.

Nulls: a null or wordless text has no hits, a null or wordless item no windows.
An item id that stands on several rows is one item; a null item id is the empty
string. Repeated documents are scanned each for itself. Empty tables give no
hits or no rows. Other columns of the documents are kept if ``keep`` names them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, cut, map_arrow, mix64, slices, words

# letters, digits and every byte above 127 make words; all else separates them
WORD_BYTES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))
TABLE = LOWER.translate(WORD_BYTES)
ROLL = np.uint64(0x9E3779B97F4A7C15)
BLOCK_WORDS = 200_000


class Index:
    """Windows of some items: vocabulary, sorted window hashes by window length, and the windows themselves."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        codes, vocabulary, counts = words(pa.array([t for _, t in items], pa.string()), TABLE)
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.items: dict[bytes, set[str]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        at = 0
        for (item_id, _), size in zip(items, counts.tolist(), strict=True):
            ids = codes[at : at + size].astype(np.uint32) + np.uint32(1)
            at += size
            if not size:
                continue
            length = min(n, size)
            hashes.setdefault(length, []).append(rolled(ids, length))
            for i in range(size - length + 1):
                self.items.setdefault(ids[i : i + length].tobytes(), set()).add(item_id)
        self.hashes = {length: np.unique(np.concatenate(h)) for length, h in hashes.items()}

    def numbers(self, vocabulary: list[str]) -> np.ndarray:
        """0 for words that no item has."""
        return np.fromiter((self.number.get(w, 0) for w in vocabulary), np.uint32, len(vocabulary))


def rolled(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of ``length`` ids, built from windows of halved lengths."""
    if length == 1:
        return mix64(ids)
    first = length // 2
    left, right = rolled(ids, first), rolled(ids, length - first)
    with np.errstate(over="ignore"):
        factor = np.uint64(pow(int(ROLL), length - first, 1 << 64))
        return left[: len(ids) - length + 1] * factor + right[first:]


def hits(index: Index, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """Words of each text, its hit windows as (first word, end), and the items whose windows occur."""
    codes, vocabulary, counts = words(texts, TABLE)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(counts))]
    found: list[set[str]] = [set() for _ in range(len(counts))]
    ids = index.numbers(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint32)
    ends = np.cumsum(counts)
    # how many words from each place on are known and of the same text
    stops = np.union1d(np.flatnonzero(ids == 0), ends)
    run = stops[np.searchsorted(stops, np.arange(len(ids)))] - np.arange(len(ids)) if len(ids) else np.zeros(0, int)
    for length, known in index.hashes.items():
        starts = np.flatnonzero(run >= length)
        if not len(starts):
            continue
        window = rolled(ids, length)[starts]
        place = np.minimum(np.searchsorted(known, window), len(known) - 1)
        for i in starts[known[place] == window].tolist():
            items = index.items.get(ids[i : i + length].tobytes())
            if items:
                row = int(np.searchsorted(ends, i, side="right"))
                base = int(ends[row] - counts[row])
                spans[row].append((i - base, i - base + length))
                found[row] |= items
    return counts, spans, found


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the given spans and what stands between them."""
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(TABLE))]
    at, kept = 0, []
    for a, b in spans:
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """Items as lists for the driver, each of about ``block_words`` words."""
    rows = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * block_words)))  # a word and what follows it: six bytes
    for b in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield b == blocks - 1, [(r.item_id, r.text) for r in mine.collect()]


SPANS = "array<struct<start:int,stop:int>>"


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
    clean_text: bool = False,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: n_words, hit_spans (word numbers, joined), items, and the text without the spans if asked.

    Kept columns are named ``kept_<name>``, so they cannot clash with these.
    """
    spark = docs.sparkSession
    kept = [F.col(c).alias(f"kept_{c}") for c in keep]
    state = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(SPANS).alias("hit_spans"),
        F.array().cast("array<string>").alias("items"),
        *kept,
    )
    for last, items in item_blocks(benchmark, item_id_col, item_text_col, block_words):
        shared = spark.sparkContext.broadcast(Index(items, n))

        def run(batches, shared=shared):
            for batch in batches:
                for part in slices(batch, "text"):
                    columns = dict(zip(part.schema.names, part.columns, strict=True))
                    counts, spans, found = hits(shared.value, columns["text"])
                    before = columns["hit_spans"].to_pylist()
                    spans = [joined([*new, *((s["start"], s["stop"]) for s in old)]) for new, old in zip(spans, before, strict=True)]
                    named = [sorted(x.union(old)) for x, old in zip(found, columns["items"].to_pylist(), strict=True)]
                    columns |= {
                        "n_words": pa.array(counts, pa.int64()),
                        "hit_spans": pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], part.schema.field("hit_spans").type),
                        "items": pa.array(named, part.schema.field("items").type),
                    }
                    yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

        state = map_arrow(state, run, state.schema)
        if not last:
            state = cut(state, "hits")
    if clean_text:
        cleaned = F.udf(lambda text, spans: without(text, [(s[0], s[1]) for s in spans]) if spans else text, "string")
        state = state.withColumn("clean_text", cleaned("text", "hit_spans"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return state.drop("text").withColumn("n_hit", hit).withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without any hit, with all their columns."""
    found = scan(docs, benchmark, id_col=id_col, text_col=text_col, keep=tuple(docs.columns), **options)
    return found.filter(~F.col("contaminated")).select(*(F.col(f"kept_{c}").alias(c) for c in docs.columns))
