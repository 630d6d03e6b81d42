"""Quality rules: repeated passages of a text by suffix array.

The suffix arrays of a batch of texts stand one after another in one array: a
word's symbol starts with its text's number, and each text is closed by a symbol
of its own. It is sorted by prefix doubling; only suffixes that still have an
equal are sorted again. The classes of equal 1, 2, 4, ... word prefixes, kept
from the doubling, give the longest common prefix of neighbours in the array,
and each suffix's deepest longest-common-prefix interval: the longest repeat
that starts there. A repeat is maximal where no longer one begins a word
earlier. The union of the maximal repeats of at least ``min_words`` words gives
the covered fraction; a text is kept if that and its longest repeat stay within
their limits.

Beside these stand plain counts (words, characters, symbols, repeated lines and
words in repeated windows) for the base rules.

Nulls: a null or wordless text has zero words and fails the base rule. Repeated
rows are judged each for itself; an empty table gives an empty table. Other
columns are kept if ``keep`` names them (as ``kept_<name>``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPLIT_ON_BLANKS, map_arrow, slices, spans_to_rows, words

SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
IS_BLANK = np.frombuffer(SPLIT_ON_BLANKS, np.uint8) == 32


def closed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols: each text's words and then its end, none shared between texts; place of every word)."""
    row = spans_to_rows(counts)
    place = np.arange(len(codes)) + row
    top = int(codes.max()) + 1 if len(codes) else 0
    out = np.empty(len(codes) + len(counts), np.int64)
    out[place] = row * (top + 1) + codes
    out[np.cumsum(counts) + np.arange(len(counts))] = np.arange(len(counts)) * (top + 1) + top
    return out, place


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffixes in order, for k = 0, 1, ...: the class of each place by its first 2**k symbols)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    heads = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    levels, step = [rank], 1
    while True:
        single = heads & np.concatenate([heads[1:], [True]])
        at = np.flatnonzero(~single)
        if not len(at):
            return order, levels
        place = order[at]
        # equal symbols so far never reach past a text's own end symbol, so place + step exists
        key = rank[place] * n + rank[place + step]
        by = np.argsort(key, kind="stable")
        key, order[at] = key[by], place[by]
        heads[at] = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[order[at]] = np.maximum.accumulate(np.where(heads[at], at, 0))
        levels.append(rank)
        step *= 2


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For every place, the length of the longest repeated sequence that starts there."""
    order, levels = suffix_array(symbols)
    alike = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[alike], order[alike + 1]
    prefix = np.zeros(len(alike), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # a pair that has matched up to its texts' ends would look past them
        x, y = np.minimum(a + prefix, len(symbols) - 1), np.minimum(b + prefix, len(symbols) - 1)
        prefix += (levels[k][x] == levels[k][y]) * (1 << k)
    longest = np.zeros(len(symbols), np.int64)
    np.maximum.at(longest, a, prefix)
    np.maximum.at(longest, b, prefix)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which places lie in some span."""
    change = np.bincount(starts, minlength=size + 1) - np.bincount(starts + lengths, minlength=size + 1)
    return np.cumsum(change)[:size] > 0


def by_offsets(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(upto[offsets])


def measures(texts: pa.Array, min_words: int, window: int = 8) -> dict[str, np.ndarray]:
    """Counts of every text, its covered words and its longest repeat."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    codes, _, counts = words(texts, SPLIT_ON_BLANKS)
    symbols, place = closed(codes, counts)
    longest = longest_repeats(symbols) if len(codes) else np.zeros(len(symbols), np.int64)
    row = np.empty(len(symbols), np.int64)
    row[place] = spans_to_rows(counts)
    row[np.cumsum(counts) + np.arange(n)] = np.arange(n)

    def words_in(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return np.bincount(row[covered(starts, lengths, len(symbols))], minlength=n)

    windows = np.flatnonzero(longest >= window)
    # maximal to the left: no repeat that begins a word earlier holds this one
    maximal = longest >= min_words
    maximal[1:] &= longest[:-1] != longest[1:] + 1
    repeats = np.flatnonzero(maximal)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, row, longest)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    inner = offsets - offsets[0]
    lines = pc.split_pattern(texts, "\n")
    coded = lines.values.dictionary_encode()
    worded = pc.not_equal(pc.ascii_trim_whitespace(coded.dictionary), pa.scalar("", coded.dictionary.type)).to_numpy(zero_copy_only=False)
    line, of = coded.indices.to_numpy(), spans_to_rows(np.diff(lines.offsets.to_numpy()))
    keep = worded[line] if len(line) else np.zeros(0, bool)
    distinct = np.unique(of[keep] * (len(worded) + 1) + line[keep]) // (len(worded) + 1)
    return {
        "n_words": counts,
        "word_chars": pc.utf8_length(texts).to_numpy() - by_offsets(IS_BLANK[data], inner),
        "n_symbols": by_offsets(IS_SYMBOL[data], inner),
        "n_dup_lines": np.bincount(of[keep], minlength=n) - np.bincount(distinct, minlength=n),
        "n_repeat_words": words_in(windows, np.full(len(windows), window)),
        "covered_words": words_in(repeats, longest[repeats]),
        "longest_repeat": top,
    }


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    min_words: int = 5,
    max_covered: float = 0.3,
    longest_share: float = 0.2,
    longest_free: int = 50,
) -> DataFrame:
    """Measures of every document, base_failed and kept.

    A text is kept if at most ``max_covered`` of its words lie in maximal repeats
    of ``min_words`` words or more, and its longest repeat has at most
    ``longest_free`` words or ``longest_share`` of the text's.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    kept = [F.col(c).alias(f"kept_{c}") for c in keep]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *kept)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                got = measures(part.column("text"), min_words)
                columns = {c: x for c, x in zip(part.schema.names, part.columns, strict=True) if c != "text"}
                columns |= {c: pa.array(got[c], pa.int64()) for c in names}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = rows.drop("text").withColumns({c: F.lit(0).cast("long") for c in names}).schema
    found = map_arrow(rows, run, schema)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fine = (F.col("covered_words") <= max_covered * F.col("n_words")) & (
        F.col("longest_repeat") <= F.greatest(F.lit(float(longest_free)), longest_share * F.col("n_words"))
    )
    return found.withColumn("base_failed", base).withColumn("kept", ~base & fine)
