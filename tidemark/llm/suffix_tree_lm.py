"""LM scoring: a probabilistic suffix tree over the bytes of lower-cased words.

A text is the bytes of its words, a blank after each, and one end symbol. The
tree holds contexts of up to ``depth`` bytes (windows of ``depth`` + 1 are packed
in one long). A context is kept if it occurs at least ``min_count`` times and its
next symbols are told better by its own distribution than by that of its longest
kept proper suffix: by more than ``min_gain`` in natural log likelihood over all
its occurrences. Both are counts, not shares, so the tree grows with the corpus.
The distribution of a kept context is smoothed with that of its parent. A symbol
is scored in the state that is the longest kept suffix of what stands before it.

All of it is tables in Spark. The texts are written packed, with a split
number for about ``SPLIT_BYTES`` of them each; every split's distinct windows are
counted. Grams (context and symbol) of up to ``TOP`` context bytes get their
probability from those one byte shorter, by joins of small tables. Longer contexts
end in the same ``TOP`` bytes as their suffixes, so windows are dealt by these
bytes and one task counts and tests all longer lengths of a group in a row (a
group's distinct windows are bounded by the alphabet, not by the corpus). The
probabilities of the windows then meet the splits that hold them, and each split's
texts are looked up in its own windows alone.

Beside the score stands the unigram base of the words. It goes the same way: the
distinct words of every split are counted, summed over all splits, and the sums
meet the splits that hold the words, so no task sees the vocabulary.

Nulls: a null text is an empty one, with one token, the end. Repeated rows and
null ids are scored each for itself. Without training texts the model is
uniform and the base counts are zero. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER_SPLIT_ON_BLANKS, arrow_words, cut, drop, map_arrow, partitions_for, ranges, slices, spans_to_rows, words

END = 10  # a line end: no word holds one
BLANK = 32
STEP = 512  # bytes of a piece that are scored
SLICE = 1 << 20  # bytes of text or places worked on at a time: what numpy holds stays in the cache
SPLIT_BYTES = 32 << 20  # of texts whose windows are looked up together
TOP = 3  # context bytes up to which grams are tables of their own
GROUP_ROWS = 1 << 19  # windows that are tested at a time, or one group
PACK_ROWS = 1 << 21  # windows or words that a task packs at a time
WORD_ROWS = 1 << 20  # counted words that are held before they are summed
PLAIN = {"parquet.writer.version": "PARQUET_2_0"}  # windows in order are kept as differences


def stream(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, each after ``depth`` end symbols; symbols of each text with these)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    raw = held.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if held is not None else b""
    data = np.frombuffer(raw.translate(LOWER_SPLIT_ON_BLANKS), np.uint8)
    ends = offsets[1:] - offsets[0]
    # a blank stays where a word ends before it; the last word of a text gets one
    word = data != BLANK
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    starts = (offsets[:-1] - offsets[0])[offsets[1:] > offsets[:-1]]
    before[starts] = False
    keep = word | before
    upto = np.concatenate([[0], np.cumsum(keep)])
    sizes = upto[ends] - upto[offsets[:-1] - offsets[0]]
    del upto
    open_end = np.zeros(len(texts), bool)
    some = ends > offsets[:-1] - offsets[0]
    open_end[some] = word[ends[some] - 1]
    total = sizes + open_end + depth + 1
    after = np.cumsum(total)
    body = np.ones(int(total.sum()), bool)  # all but what a text gets before and behind its own bytes
    body[((after - total)[:, None] + np.arange(depth)).ravel()] = False
    body[after - 1] = False
    body[after[open_end] - 2] = False
    out = np.full(len(body), END, np.uint8)
    out[body] = data[keep]
    out[after[open_end] - 2] = BLANK
    return out, total


def codes(symbols: np.ndarray, total: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the stream, windows there as numbers), ``SLICE`` places at a time; windows lie within one text."""
    whole = np.ones(len(symbols), bool)
    whole[(np.cumsum(total)[:, None] - 1 - np.arange(depth)).ravel()] = False
    for a in range(0, len(symbols) - depth, SLICE):
        b = min(a + SLICE, len(symbols) - depth)
        code = symbols[a:b].astype(np.int64)
        for k in range(1, depth + 1):
            code <<= 8
            code |= symbols[a + k : b + k]
        yield a + np.flatnonzero(whole[a:b]), code[whole[a:b]]


def windows(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct windows of ``depth`` + 1 symbols as numbers, how often each occurs)."""
    found = [np.unique(code, return_counts=True) for _, code in codes(*stream(texts, depth), depth)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return found[0] if len(found) == 1 else merged([w for w, _ in found], [n for _, n in found])


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of several tables, with the sums of their counts."""
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")  # runs in order: merged, not sorted
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def placed_texts(docs: DataFrame, training: Column, id_col: str, text_col: str) -> DataFrame:
    """split, learned, texts: the rows as compressed Arrow tables (doc_id, learned, text) of a split, and how many are for training."""

    def run(batches):
        task, held, split = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                learned = pc.sum(part.column("learned")).as_py()
                columns = [pa.array([task << 32 | split]), pa.array([learned], pa.int64()), pa.array([blob(pa.Table.from_batches([part]))], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["split", "learned", "texts"])
                held += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if held >= SPLIT_BYTES:
                    held, split = 0, split + 1

    columns = (F.col(id_col).cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("learned"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(docs.select(*columns), run, "split long, learned long, texts binary")


def split_windows(texts: DataFrame, depth: int) -> DataFrame:
    """split, window, n: the distinct windows of every split, and how often training texts hold them."""

    def run(batches):
        split, found, counts = None, [], []

        def close():
            window, n = merged(found, counts)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(window), split)), pa.array(window), pa.array(n)], ["split", "window", "n"])

        for of, part in unpacked_texts(batches):
            if found and of != split:
                yield close()
                found, counts = [], []
            split = of
            for learned in (True, False):
                texts = part.column("text").filter(pc.equal(part.column("learned"), learned))
                if len(texts):
                    code, n = windows(texts, depth)
                    found.append(code)
                    counts.append(n * learned)
            if sum(map(len, found[1:])) > max(SLICE, len(found[0])):  # slices of a split have most windows in common
                found, counts = map(list, zip(merged(found, counts), strict=True))
        if found:
            yield close()

    return map_arrow(texts.select("split", "texts"), run, "split long, window long, n long")


def gram_probabilities(counted: DataFrame, depth: int, min_count: int, min_gain: float, smooth: float) -> DataFrame:
    """gram (context of ``depth`` bytes and next symbol), p: the model's probability of each of the windows.

    ``counted`` has each window with its number in training texts, which may be 0.
    """
    whole = cut(counted.select(F.col("window").alias("gram"), "n"), "grams", release=True)
    top = min(TOP, depth)
    tables = {}  # by context length
    for size in range(top, -1, -1):
        shorter = F.col("gram").bitwiseAND((1 << 8 * (size + 1)) - 1)
        tables[size] = cut(tables.get(size + 1, whole).groupBy(shorter.alias("gram")).agg(F.sum("n").alias("n")), "grams")
    symbols = tables[0].agg(F.sum("n")).first()[0] or 0
    found = tables[0].select("gram", ((F.col("n") + 0.5) / F.lit(symbols + 128.0)).alias("p"))
    of_context = Window.partitionBy("context")  # at most 256 rows
    for size in range(1, top + 1):
        rows = _with_shorter(tables[size], found, size)
        rows = rows.select("gram", "n", "p", F.shiftright("gram", 8).alias("context"))
        gained = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / F.col("p"))).otherwise(0.0)
        rows = rows.select("gram", "n", "p", F.sum("n").over(of_context).alias("total"), F.sum(gained).over(of_context).alias("told"))
        total = F.col("total")
        keep = (total >= max(1, min_count)) & (F.col("told") - total * F.log(F.greatest(total, F.lit(1))) > min_gain)
        own = (F.col("n") + smooth * F.col("p")) / (total + smooth)
        found = cut(rows.select("gram", F.when(keep, own).otherwise(F.col("p")).alias("p")), "probabilities")
    if depth > top:
        suffix = F.shiftright(F.col("gram").bitwiseAND((1 << 8 * (top + 1)) - 1), 8)
        rows = _with_shorter(whole, found, top + 1).select("gram", "n", "p", suffix.alias("suffix"))
        rows = rows.repartition(partitions_for(counted.sparkSession), "suffix").sortWithinPartitions("suffix")

        def run(batches):
            held, rows, enough = [], 0, GROUP_ROWS
            for batch in batches:
                held.append(batch)
                rows += len(batch)
                if rows < enough:
                    continue
                table = pa.Table.from_batches(held)
                of = table.column("suffix").to_numpy()
                full = int(np.searchsorted(of, of[-1], side="left"))  # the last group may go on
                if full:
                    yield tested(table.slice(0, full))
                held = table.slice(full).to_batches()
                rows -= full
                enough = max(GROUP_ROWS, 2 * rows)
            if rows:
                yield tested(pa.Table.from_batches(held))

        def tested(table):
            gram, n, p = (table.column(c).to_numpy() for c in ("gram", "n", "p"))
            p = deep_probabilities(gram, n, p, range(top + 1, depth + 1), min_count, min_gain, smooth)
            return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(p)], ["gram", "p"])

        found = cut(map_arrow(rows, run, "gram long, p double"), "probabilities", release=True)
    drop(whole, *tables.values())
    return found


def _with_shorter(grams: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """The grams with ``p`` of the gram without the first of ``size`` context bytes, or of longer ones' last ``size``."""
    parent = found.select(F.col("gram").alias("shorter"), "p")
    return grams.withColumn("shorter", F.col("gram").bitwiseAND((1 << 8 * size) - 1)).join(parent, "shorter")


def deep_probabilities(window: np.ndarray, n: np.ndarray, p: np.ndarray, sizes: range, min_count: int, min_gain: float, smooth: float) -> np.ndarray:
    """Probability of each distinct window by contexts of the lengths ``sizes``, from ``p`` by contexts one byte shorter.

    All windows whose contexts share the last ``sizes.start`` - 1 bytes have to be there.
    """
    for size in sizes:
        gram, first, row = np.unique(window & (1 << 8 * (size + 1)) - 1, return_index=True, return_inverse=True)
        count, parent = np.bincount(row, weights=n), p[first]
        context = gram >> 8
        start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        total = np.add.reduceat(count, start)
        told = np.add.reduceat(count * np.log(np.maximum(count, 1) / parent), start)
        keep = (total >= max(1, min_count)) & (told - total * np.log(np.maximum(total, 1)) > min_gain)
        of = spans_to_rows(np.diff(np.append(start, len(gram))))
        p = np.where(keep[of], (count + smooth * parent) / (total[of] + smooth), parent)[row]
    return p


class Places:
    """Where each of some distinct numbers stands among them: a hash table, for a window is looked up once an occurrence."""

    def __init__(self, numbers: np.ndarray):
        self.numbers, self.bits = numbers, max(1, (2 * len(numbers)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(numbers), dtype=np.int32), self._slot(numbers)
        while len(left):
            free = self.table[at] < 0
            self.table[at[free]] = left[free]  # of those that want a slot, one gets it
            lost = self.table[at] != left
            left, at = left[lost], self._next(at[lost])

    def _slot(self, numbers: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((numbers.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Places of numbers that are all there; others raise a KeyError."""
        at = self._slot(numbers)
        found = self.table[at]
        other = np.flatnonzero(self.numbers[found] != numbers) if len(self.numbers) else np.arange(len(numbers))
        at = at[other]
        while len(other):
            if (found[other] < 0).any():
                raise KeyError("a number that is not held")
            at = self._next(at)
            found[other] = self.table[at]
            still = self.numbers[found[other]] != numbers[other]
            other, at = other[still], at[still]
        return found


def window_scores(texts: pa.Array, depth: int, window: Places, log10: np.ndarray) -> np.ndarray:
    """log10 probability of each text from those of its windows."""
    symbols, total = stream(texts, depth)
    if not len(total):
        return np.zeros(0)
    told = np.zeros(len(symbols), np.float32)
    for place, code in codes(symbols, total, depth):
        told[place] = log10[window.of(code)]
    return np.add.reduceat(told, np.cumsum(total) - total, dtype=np.float64)


@dataclass
class Automaton:
    """States are the prefixes of kept contexts; each scores with its longest kept suffix."""

    symbol: np.ndarray  # byte -> column
    step: np.ndarray  # states x columns: next state
    log10: np.ndarray  # states x columns
    start: int
    depth: int

    def scores(self, texts: pa.Array) -> np.ndarray:
        """log10 probability of each text."""
        symbols, total = stream(texts, self.depth)
        columns = self.symbol[symbols]
        scored = total - self.depth
        pieces = -(-scored // STEP)
        row = spans_to_rows(pieces)
        number = ranges(np.zeros(len(pieces), np.int64), pieces)
        first = (np.cumsum(total) - total)[row] + number * STEP
        size = np.minimum(scored[row] - number * STEP, STEP)
        order = np.argsort(-size, kind="stable")
        first, size, row = first[order], size[order], row[order]
        state = np.full(len(first), self.start, np.int64)
        sums = np.zeros(len(first))
        width = self.log10.shape[1]
        step, log10 = self.step.ravel(), self.log10.ravel()
        for k in range(self.depth):
            state = step[state * width + columns[first + k]]
        alive = np.searchsorted(-size, -np.arange(STEP), side="left")  # pieces longer than k
        for k in range(int(size[0]) if len(size) else 0):
            n = alive[k]
            at = state[:n] * width + columns[first[:n] + self.depth + k]
            sums[:n] += log10[at]
            state[:n] = step[at]
        return np.bincount(row, weights=sums, minlength=len(total))


def learn(size: np.ndarray, gram: np.ndarray, n: np.ndarray, depth: int, divergence: float, smooth: float) -> Automaton:
    """The same model in one process, for a small corpus: tests, smoothing and the automaton from candidate contexts' counts.

    ``divergence`` is the least gain as a share of all training symbols.
    """
    seen = np.unique(np.concatenate([gram[size == 0], [END, BLANK]]).astype(np.int64))
    symbol = np.full(256, len(seen), np.int64)  # bytes that training lacks share the last column
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    unseen = max(1, 256 - len(seen))
    all_symbols = max(1, int(n[size == 0].sum()))
    root = np.full(width, 0.5)
    root[symbol[gram[size == 0]]] += n[size == 0]
    root[-1] = 0.5 * unseen
    tables = {(0, 0): root / root.sum()}  # kept contexts: (length, bytes as a number) -> distribution
    for length in range(1, depth + 1):
        mine = size == length
        if not mine.any():
            continue
        order = np.argsort(gram[mine], kind="stable")
        g, c = gram[mine][order], n[mine][order].astype(float)
        contexts, first = np.unique(g >> 8, return_index=True)
        for context, a, b in zip(contexts.tolist(), first.tolist(), [*first[1:].tolist(), len(g)], strict=True):
            parent = next(tables[k, context & (1 << 8 * k) - 1] for k in range(length - 1, -1, -1) if (k, context & (1 << 8 * k) - 1) in tables)
            column, counts = symbol[g[a:b] & 255], c[a:b]
            total = counts.sum()
            share = counts / total
            if total / all_symbols * float((share * np.log(share / parent[column])).sum()) <= divergence:
                continue
            own = smooth * parent
            own[column] += counts
            tables[length, context] = own / (total + smooth)
    return _automaton(tables, symbol, width, unseen, depth)


def _automaton(tables, symbol, width, unseen, depth) -> Automaton:
    nodes = {(0, 0): 0}
    for length, context in sorted(tables):
        for k in range(1, length + 1):
            nodes.setdefault((k, context >> 8 * (length - k)), len(nodes))
    step = np.zeros((len(nodes), width), np.int32)
    log10 = np.zeros((len(nodes), width), np.float32)
    fallback = np.zeros(len(nodes), np.int64)
    children: dict[int, list[tuple[int, int]]] = {}
    for (length, context), node in nodes.items():
        if length:
            children.setdefault(nodes[length - 1, context >> 8], []).append((int(symbol[context & 255]), node))
    for (length, context), node in sorted(nodes.items()):
        if (length, context) in tables:
            log10[node] = np.log10(tables[length, context])
            log10[node, -1] -= np.log10(unseen)
        else:
            log10[node] = log10[fallback[node]]
        step[node] = step[fallback[node]] if node else 0
        for column, child in children.get(node, ()):
            fallback[child] = step[node, column] if node else 0
            step[node, column] = child
    return Automaton(symbol, step, log10, 0, depth)


def split_words(texts: DataFrame) -> DataFrame:
    """split, word, n: the distinct words of every split, and how often training texts hold them."""

    def run(batches):
        split, found = None, []

        def close():
            table = summed(found)
            for rows in table.to_batches():
                whole = [pa.array(np.full(len(rows), split)), rows.column("word"), rows.column("n")]
                yield pa.RecordBatch.from_arrays(whole, ["split", "word", "n"])

        def summed(tables):
            whole = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": whole.column("word"), "n": whole.column("n_sum")})

        for of, part in unpacked_texts(batches):
            if found and of != split:
                yield from close()
                found = []
            split = of
            codes, vocabulary, counts = arrow_words(part.column("text"), LOWER_SPLIT_ON_BLANKS)
            learned = part.column("learned").to_numpy(zero_copy_only=False)
            n = np.bincount(codes, weights=np.repeat(learned, counts), minlength=len(vocabulary)).astype(np.int64)
            found.append(pa.table({"word": vocabulary, "n": n}))
            if sum(map(len, found[1:])) > max(WORD_ROWS, len(found[0])):
                found = [summed(found)]
        if found:
            yield from close()

    return map_arrow(texts.select("split", "texts"), run, "split long, word string, n long")


def packed(rows: DataFrame, name: str) -> DataFrame:
    """split, ``name``: the rows of a split as compressed Arrow tables, windows in order and as differences.

    A task packs ``PACK_ROWS`` rows at a time, so a split has a few rows where it had one a window.
    """
    field = [c for c in rows.columns if c != "split"]

    def pack(batches):
        table = pa.Table.from_batches(batches)
        by = [("split", "ascending"), (field[0], "ascending")] if field[0] == "window" else [("split", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=by)).combine_chunks()
        of = table.column("split").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        blobs = []
        for a, b in zip(starts, [*starts[1:], len(of)], strict=True):
            part = table.slice(a, b - a).select(field)
            if field[0] == "window":
                part = part.set_column(0, "window", pa.array(np.diff(part.column("window").to_numpy(), prepend=0)))
            blobs.append(blob(part))
        return pa.RecordBatch.from_arrays([pa.array(of[starts]), pa.array(blobs, pa.binary())], ["split", name])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= PACK_ROWS:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    return map_arrow(rows, run, f"split long, {name} binary")


def blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(blob: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(blob.as_buffer()).read_all()


def unpacked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(split, rows) of packed texts."""
    for batch in batches:
        for split, packed in zip(batch.column("split").to_pylist(), batch.column("texts"), strict=True):
            for part in unpacked(packed).to_batches():
                yield split, part


def score(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = 6,
    min_count: int = 8,
    min_gain: float = 1.0,
    smooth: float = 4.0,
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every text."""
    spark = docs.sparkSession
    placed = cut(placed_texts(docs, training, id_col, text_col), "texts")
    held = cut(split_windows(placed, depth), "windows", **PLAIN)
    counted = held.groupBy("window").agg(F.sum("n").alias("n"))
    found = gram_probabilities(counted, depth, min_count, min_gain, smooth)
    log10 = found.select(F.col("gram").alias("window"), F.log10("p").cast("float").alias("log10"))
    # a partition's distinct windows fit in a hash table, so the splits' windows need no sort
    met = held.select("split", "window").join(log10.hint("shuffle_hash"), "window")
    looked_up = cut(packed(met.select("split", "window", "log10"), "windows"), "split-windows", release=True)
    drop(held, found)
    held = cut(split_words(placed), "words")
    known = cut(held.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    row = known.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    n_texts = placed.agg(F.sum("learned")).first()[0] or 0  # each has one end
    n_all, n_distinct = (row[0] or 0) + n_texts, row[1] + (n_texts > 0)
    room = n_all + 0.5 * (n_distinct + 1)
    met = held.select("split", "word").join(known, "word")
    looked_up_words = cut(packed(met.select("split", "word", "n"), "words"), "split-words", release=True)
    drop(held, known)

    def run(batches):
        split, found, counted, ready = None, [], [], None
        for batch in batches:
            for of, texts, window, word in zip(batch.column("split").to_pylist(), *(batch.column(c) for c in ("texts", "windows", "words")), strict=True):
                if of != split:
                    split, found, counted, ready = of, [], [], None
                if window.is_valid:
                    found.append(unpacked(window))
                if word.is_valid:
                    counted.append(unpacked(word))
                if not texts.is_valid:
                    continue
                if ready is None:
                    places = Places(np.concatenate([np.cumsum(t.column("window").to_numpy()) for t in found]))
                    log10 = np.concatenate([t.column("log10").to_numpy() for t in found])
                    count = {}
                    for t in counted:
                        count.update(zip(t.column("word").to_numpy().tolist(), t.column("n").to_numpy().tolist(), strict=True))
                    ready = places, log10, count
                    found, counted = [], []
                for part in unpacked(texts).to_batches():
                    yield scored(part, *ready)

    def scored(part, window, log10, count):
        texts = part.column("text")
        codes, vocabulary, counts = words(texts, LOWER_SPLIT_ON_BLANKS)
        c = np.fromiter((count[w] for w in vocabulary), np.float64, len(vocabulary))
        row, n = spans_to_rows(counts), len(counts)
        base = np.bincount(row, weights=np.log10((c + 0.5) / room)[codes], minlength=n) + np.log10((n_texts + 0.5) / room)
        n_known = np.bincount(row, weights=(c > 0)[codes], minlength=n).astype(np.int64) + (n_texts > 0)
        columns = [part.column("doc_id"), pa.array(counts + 1), pa.array(n_known), pa.array(np.full(n, n_all, np.int64)), pa.array(base)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(window_scores(texts, depth, window, log10))], NAMES)

    tables = looked_up.unionByName(looked_up_words, allowMissingColumns=True)
    rows = tables.unionByName(placed.drop("learned"), allowMissingColumns=True)
    # a split's windows and words, then its texts
    rows = rows.repartition(partitions_for(spark), "split").sortWithinPartitions(F.col("split") * 2 + F.col("texts").isNotNull().cast("long"))
    return map_arrow(rows, run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


NAMES = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
