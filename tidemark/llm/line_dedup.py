"""Line dedup: exact set-similarity join of lines, by DataFrame functions only.

A line's tokens are its words, held as 63-bit numbers: a word's length, then its hash. Lines link if the Jaccard
similarity of their word sets is at least ``percent`` / 100. A line is removed if an earlier line
(smaller document id, or an earlier line of the same document) links with it,
whether that one was removed or not; equal lines link, lines without a word do
not. So every class of equal lines keeps its first place, unless an earlier
class links with it.

Tokens are ordered by length, longest first (long words are rare), ties by hash. That takes no
counts, so no table goes through the driver. A line's elements are its neighbouring tokens in that
order, two by two (the last one stands alone), ordered by the first. If a line x lacks b tokens of a
linked line and has a that the other lacks, at most 2a + b of its elements are not the other's: a
token spoils the two it is in, and one between two neighbours spoils one. So of the first
max(2a + b) + 1 elements of each, its prefix, the two share one. For ``percent`` up to 50 that can be
more than a line has; there the tokens themselves are the elements, and a line lacks at most a.
Pairs of words are shared by few lines in tables of any size that single words would tie up. Lines
that share an element are candidates if their lengths and a sketch of
their words (each word turns one of 64 bits over, or one of 128 if both lines are
long; the bits that differ are at most the words that differ) allow the
similarity; candidates are verified on all tokens.

Elements that one line alone has go at once; the others' lines get their sketches. Dense groups: every
line is first held against the ``EARLIEST`` first lines of
each of its elements' groups, so no group is held against itself whole; only lines
that this leaves are held against the later lines of groups that have more.

Nulls: a null text has no lines. Rows with a null id are passed through whole.
``kept_lines`` takes ids that do not repeat (``named_rows`` gives such); ``deduplicate``
names rows that share an id each for itself.
An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop, free_name, named_rows

SLOTS = 1 << 18
FILTER_SLOTS = 6 << 18
EARLIEST = 16
LONG_LINE = 96
TOKEN_BITS = 48
LENGTHS = 127
DICTIONARY_BYTES = 4 << 20
BLANKS = "\t\u000b\f\r"


def distinct_lines(text: Column) -> Column:
    """The distinct lines of a text in order of first occurrence."""
    return F.array_distinct(F.split(text, "\n"))


def words_of(line: Column) -> Column:
    """The distinct words (runs without ASCII white space) of a line as numbers, in order: longest first, then by hash."""
    odd = F.contains(line, F.lit(BLANKS[0]))
    for b in BLANKS[1:]:
        odd = odd | F.contains(line, F.lit(b))
    plain = F.when(odd, F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line)

    def number(w: Column) -> Column:
        shortness = F.lit(LENGTHS) - F.least(F.octet_length(w), F.lit(LENGTHS))
        return F.shiftleft(shortness.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 8))

    return F.sort_array(F.transform(F.array_distinct(F.array_remove(F.split(plain, " "), "")), number))


def line_classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, at, words: each distinct line with a word, at the first place it stands."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.posexplode(distinct_lines(F.col(text_col))).alias("at", "line"))
    worded = rows.filter(F.col("line").rlike("[^\\x20\\x09-\\x0D]"))
    first = worded.groupBy("line").agg(F.min("doc").alias("doc"), F.min_by("at", "doc").alias("at"))
    return first.select("doc", "at", words_of(F.col("line")).alias("words"))


def _table(rows: DataFrame, name: str) -> Column:
    """``value`` of every ``slot`` below ``SLOTS`` (0 if it has none) as one array.

    The array is the one row of a written table and a scalar subquery, so plans
    name it and do not hold it.
    """
    slots = rows.sparkSession.range(SLOTS).withColumnRenamed("id", "slot")
    filled = slots.join(rows, "slot", "left").select(F.struct("slot", F.coalesce("value", F.lit(0)).cast("tinyint").alias("value")).alias("x"))
    one = filled.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["value"]).alias("numbers"))
    return cut(one, name).scalar()


def sketch(tokens: Column) -> Column:
    """Each token turns one of 64 bits over (the lowest six bits of it say which)."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))))


def half_sketch(tokens: Column) -> Column:
    """As ``sketch``, of the tokens whose seventh bit is set."""

    def turned(a: Column, t: Column) -> Column:
        return a.bitwiseXOR(F.call_function("shiftleft", F.shiftright(t, 6).bitwiseAND(1), t.bitwiseAND(63).cast("int")))

    return F.aggregate(tokens, F.lit(0).cast("long"), turned)


def elements(classes: DataFrame, percent: int) -> DataFrame:
    """key, doc, at: one row a prefix element of each line.

    ``key`` is the last ``TOKEN_BITS`` of the element's hash. Two that agree there only make
    more candidates; in one line they give it two rows, which are no pair.
    """
    words, size = F.col("words"), F.size("words")
    if percent > 50:
        length = F.floor(2 * (100 - percent) * size / 100).cast("int") + 1
        hashed = lambda t, i: F.xxhash64(t, F.get(words, i + 1))
    else:
        length = size - F.floor((percent * size + 99) / 100).cast("int") + 1
        hashed = lambda t, i: F.xxhash64(t)
    keys = F.transform(F.slice(words, F.lit(1), length), lambda t, i: hashed(t, i).bitwiseAND((1 << TOKEN_BITS) - 1))
    return classes.select(F.explode(keys).alias("key"), "doc", "at")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key another line has too, with each line's number (rank) among those of its key."""
    of_key = Window.partitionBy("key").orderBy("doc", "at")
    rank = F.count(F.lit(1)).over(of_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")
    more = F.lead(F.lit(1)).over(of_key).isNotNull()
    return rows.select("key", "doc", "at", rank.alias("rank"), more.alias("more")).filter((F.col("rank") > 1) | F.col("more")).drop("more")


def _sketched(classes: DataFrame) -> DataFrame:
    """doc, at, size, bits, half of each line (half is 0 for lines that are not long)."""
    half = F.when(F.size("words") >= LONG_LINE, half_sketch(F.col("words"))).otherwise(F.lit(0).cast("long"))
    return classes.select("doc", "at", F.size("words").alias("size"), sketch(F.col("words")).alias("bits"), half.alias("half"))


def _possible(x: str, y: str, percent: int) -> Column:
    """What lengths and sketches of two lines (the prefixes of their columns' names) that share an element allow."""
    a, b = F.col(f"{x}size"), F.col(f"{y}size")
    bits = F.col(f"{x}bits").bitwiseXOR(F.col(f"{y}bits"))
    half = F.col(f"{x}half").bitwiseXOR(F.col(f"{y}half"))
    both_long = F.bit_count(bits.bitwiseXOR(half)) + F.bit_count(half)
    return (
        (100 * F.least(a, b) >= percent * F.greatest(a, b))
        & ((100 + percent) * F.bit_count(bits) <= (100 - percent) * (a + b))
        & ((F.least(a, b) < LONG_LINE) | ((100 + percent) * both_long <= (100 - percent) * (a + b)))
    )


def _pairs(probe: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """doc, at of lines of ``probe`` with doc_y, at_y of earlier ones of ``held`` that they may link with."""
    other = (F.col("x.doc") != F.col("y.doc")) | (F.col("x.at") != F.col("y.at"))
    met = probe.alias("x").join(held.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("y.rank") < F.col("x.rank")) & other & _possible("x.", "y.", percent))
    return met.select("x.doc", "x.at", F.col("y.doc").alias("doc_y"), F.col("y.at").alias("at_y")).distinct()


def _mark(ids: DataFrame) -> Column:
    """Whether a line may be one of ``ids``: one bit a hashed place, in a table of fixed size."""
    slot = F.pmod(F.xxhash64("doc", "at"), F.lit(FILTER_SLOTS)).cast("int")
    marks = ids.select((slot / 6).cast("long").alias("slot"), (slot % 6).alias("bit")).distinct().groupBy("slot")
    table = _table(marks.agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("bit"))).alias("value")), "marks")
    return F.call_function("shiftright", F.get(table, (slot / 6).cast("int")).cast("int"), slot % 6).bitwiseAND(1) == 1


def _without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of other lines than ``ids``; only those that bear a mark are shuffled."""
    marked = _mark(ids)
    return rows.filter(~marked).unionByName(rows.filter(marked).join(ids, ["doc", "at"], "left_anti"))


def _places(pairs: DataFrame) -> DataFrame:
    """doc, at of all lines that stand in some pair."""
    return pairs.select("doc", "at").unionByName(pairs.select(F.col("doc_y").alias("doc"), F.col("at_y").alias("at"))).distinct()


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """doc, at of lines that really link with an earlier one."""
    ids = _places(pairs)
    found = _compact(classes.filter(_mark(ids)).join(ids, ["doc", "at"]), "candidate-lines")
    x = found.select("doc", "at", F.col("words").alias("x"))
    y = found.select(F.col("doc").alias("doc_y"), F.col("at").alias("at_y"), F.col("words").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = 100 * both >= percent * (F.size("x") + F.size("y") - both)
    linked = cut(pairs.join(x, ["doc", "at"]).join(y, ["doc_y", "at_y"]).filter(alike).select("doc", "at").distinct(), "linked", release=True)
    drop(found)
    return linked


def _compact(rows: DataFrame, name: str) -> DataFrame:
    """A written table whose hashes are kept in dictionaries."""
    return cut(rows, name, release=True, **{"parquet.dictionary.page.size": DICTIONARY_BYTES})


def kept_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", spent: list[DataFrame] | None = None) -> DataFrame:
    """doc, kept: for each document with any, the places of its kept lines among its distinct lines.

    ``spent`` gets the tables that may go once the result is written.
    """
    classes = _compact(line_classes(docs, id_col, text_col), "lines")
    shared = cut(_shared(elements(classes, percent)), "shared-elements", release=True)
    seen = cut(shared.join(_sketched(classes), ["doc", "at"]), "sketched-elements", release=True)
    drop(shared)
    early = cut(_pairs(seen.filter(F.col("rank") > 1), seen.filter(F.col("rank") <= EARLIEST), percent), "early-pairs", release=True)
    first_removed = _linked(early, classes, percent)
    drop(early)
    later = seen.filter(F.col("rank") > EARLIEST)
    hard = cut(_pairs(_without(later, first_removed), later, percent), "late-pairs", release=True)
    drop(seen)
    late_removed = _linked(hard, classes, percent)
    drop(hard)
    removed = first_removed.unionByName(late_removed).distinct()
    if spent is not None:
        spent += [classes, first_removed, late_removed]
    left = _without(classes.select("doc", "at"), removed)
    return left.groupBy("doc").agg(F.sort_array(F.collect_list("at")).alias("kept"))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a lambda would compute it again for every element)."""
    return F.get(F.transform(F.array(value), body), 0)


def _first_places(lines: Column) -> Column:
    """For each distinct line, in order, its first place among all lines."""

    def of_sorted(placed: Column) -> Column:
        first = F.filter(placed, lambda x, j: (j == 0) | (F.get(placed, j - 1)["line"] != x["line"]))
        return F.sort_array(F.transform(first, lambda x: x["i"]))

    return _bound(F.sort_array(F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))), of_sorted)


def text_of_kept(text: Column, places: Column) -> Column:
    """The text with its lines without a word and the distinct lines at ``places``, each where it first stands."""

    def joined(lines: Column) -> Column:
        firsts = F.when(F.size(F.array_distinct(lines)) == F.size(lines), F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(_first_places(lines))
        at = _bound(firsts, lambda first: F.transform(places, lambda k: F.get(first, k)))
        wordless = lambda line: ~line.rlike("[^\\x20\\x09-\\x0D]")
        return _bound(at, lambda stay: F.array_join(F.filter(lines, lambda line, i: wordless(line) | F.array_contains(stay, i)), "\n"))

    return _bound(F.split(text, "\n"), joined)


def deduplicate(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the removed lines taken out of their texts; all columns and all lines without a word stay.

    Rows that share an id are documents of their own. Other columns pass through, whatever their names.
    """
    row = free_name(docs, "llm_row")
    rows = named_rows(docs, id_col, text_col, row)
    spent: list[DataFrame] = []
    kept = cut(kept_lines(rows, percent, row, text_col, spent), "kept", release=True)
    drop(*spent)
    places = F.coalesce(F.col("llm_kept.kept"), F.array().cast("array<int>"))
    text = F.when(F.col(f"llm_docs.{id_col}").isNull(), F.col(f"llm_docs.{text_col}")).otherwise(text_of_kept(F.col(f"llm_docs.{text_col}"), places))
    met = rows.alias("llm_docs").join(kept.alias("llm_kept"), F.col(f"llm_docs.{row}") == F.col("llm_kept.doc"), "left")
    return met.select(*(text.alias(c) if c == text_col else F.col(f"llm_docs.{c}").alias(c) for c in docs.columns))
