"""Source divergence audit: how each source's terms differ from its language and from other sources.

Strings are materialised late. Counts are made, shuffled and joined by 64-bit
digests of the terms. Text is needed twice only: the least and the greatest
string of each digest that is kept tell whether two terms share it, and the terms
of the final ranks get their text by a join. A digest whose strings differ is
split: its terms are counted again, by their strings. Strings of terms that are
too rare to keep never leave the task that read them (a table of bits, of fixed
size, sorts them out; an exact join follows).

Groups, that is languages and sources, have digests too, salted until all differ.

A term's chance in a group is p = 1 + floor(10^9 (count + 1) / (N + V)), N the
count of all kept terms there and V the number of kept terms of the language;
f = floor((p - q)^2 / q). Sums of f over all terms of a language are taken over
the terms that occur: terms that one side lacks are summed by their counts (a
group has few distinct counts), those that both lack by their number, and
terms of both correct this.

Nulls: a null text, language or source is the empty string. A group without a
term has all counts 0. Repeated rows count each for itself. Other columns are
not read, whatever their names. Texts of any length go in slices of whole rows.
Ties in a rank go by the bytes of the item. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop, map_arrow, slices, spans_to_rows, words

# letters and all bytes above 127 make terms; only A-Z change
TERM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))
FILTER_BITS = 1 << 22
HELD_ROWS = 1_500_000
HELD_TERMS = 400_000
SCALE = 1_000_000_000  # of p, fixed by the contract
EXACT = "decimal(38,0)"


class Counter:
    """Counts of (group, term) of many slices, in bounded memory."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.groups: dict[int, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, groups: np.ndarray, texts: pa.Array) -> None:
        codes, vocabulary, sizes = words(texts, TERM_TABLE)
        if not len(codes):
            return
        known = np.fromiter((self.codes.setdefault(w, len(self.codes)) for w in vocabulary), np.int64, len(vocabulary))
        group = np.fromiter((self.groups.setdefault(g, len(self.groups)) for g in groups.tolist()), np.int64, len(groups))
        # once a document and term, then once a group and term
        of_doc, times = np.unique(spans_to_rows(sizes) * len(vocabulary) + codes, return_counts=True)
        doc, code = np.divmod(of_doc, len(vocabulary))
        self._keep(group[doc] << 32 | known[code], times, np.ones(len(doc), np.int64))

    def _keep(self, keys, counts, docs) -> None:
        unique, inverse = np.unique(keys, return_inverse=True)
        sums = [np.bincount(inverse, weights=x, minlength=len(unique)).astype(np.int64) for x in (counts, docs)]
        self.parts.append((unique, *sums))
        self.rows += len(unique)

    def full(self) -> bool:
        return self.rows > HELD_ROWS or len(self.codes) > HELD_TERMS

    def take(self, bits: int, only: np.ndarray | None = None) -> pa.RecordBatch:
        """g, digest, n, docs, term of all held, which are then forgotten.

        ``term`` stands in one row of each term; with ``only``, a table of bits,
        in all rows of the digests that it marks, which alone are given.
        """
        parts, self.parts = self.parts, []
        if parts:
            self._keep(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        keys, n, docs = self.parts[0] if parts else (np.zeros(0, np.int64),) * 3
        terms, names = list(self.codes), np.array(list(self.groups), np.int64)
        code = keys & 0xFFFFFFFF
        digests = digest(terms, bits)[code]
        if only is None:
            shown = np.zeros(len(code), bool)
            shown[np.unique(code, return_index=True)[1]] = True
        else:
            some = only[digests & (FILTER_BITS - 1)]
            keys, n, docs, code, digests = (x[some] for x in (keys, n, docs, code, digests))
            shown = np.ones(len(code), bool)
        term = pa.array(terms, pa.string()).take(pa.array(code, mask=~shown))
        groups = names[keys >> 32] if len(keys) else keys
        self.clear()
        return pa.RecordBatch.from_arrays([*map(pa.array, (groups, digests, n, docs)), term], COUNTED_NAMES)


COUNTED = "g long, digest long, n long, docs long, term string"
COUNTED_NAMES = [c.split()[0] for c in COUNTED.split(", ")]


def digest(terms: list[str], bits: int = 64) -> np.ndarray:
    """Digests of ``bits`` bits (fewer than 64 only to see collisions)."""
    if not terms:
        return np.zeros(0, np.int64)
    got = pd.util.hash_array(np.array(terms, object), categorize=False)
    return (got if bits == 64 else got & np.uint64((1 << bits) - 1)).view(np.int64)


def counted(docs: DataFrame, bits: int, only: DataFrame | None = None) -> DataFrame:
    """g, digest, n, docs, term: partial counts of the terms of each group, as every task found them.

    With ``only``: those of its digests, by their strings.
    """
    shared = _bits(only) if only is not None else None

    def run(batches):
        flags = np.unpackbits(shared.value).astype(bool) if shared else None
        held = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                held.add(part.column("g").to_numpy(), part.column("text"))
                if held.full():
                    yield held.take(bits, flags)
        yield held.take(bits, flags)

    found = map_arrow(docs, run, COUNTED)
    return found if only is None else found.join(only, "digest", "left_semi")


def _bits(digests: DataFrame):
    """A table of bits, of fixed size, that marks the digests; given to all tasks."""
    marked = digests.select(F.col("digest").bitwiseAND(FILTER_BITS - 1).cast("int").alias("slot")).distinct().toArrow()
    bits = np.zeros(FILTER_BITS, bool)
    bits[marked.column("slot").to_numpy()] = True
    return digests.sparkSession.sparkContext.broadcast(np.packbits(bits))


def ends_of(parts: DataFrame, kept: DataFrame) -> DataFrame:
    """digest, lo, hi: the least and the greatest string of each kept digest."""
    shared = _bits(kept)

    def run(batches):
        flags = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(flags[batch.column("digest").to_numpy() & (FILTER_BITS - 1)]))

    shown = map_arrow(parts.filter(F.col("term").isNotNull()).select("digest", "term"), run, "digest long, term string")
    ends = shown.groupBy("digest").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
    return ends.join(kept.select("digest").distinct(), "digest", "left_semi")


def grouped(docs: DataFrame) -> tuple[DataFrame, Column]:
    """(g, l, lang, source of every group; the digest of a row's group), salted until no two groups share one."""
    groups = cut(docs.groupBy("lang", "source").agg(F.count("*").alias("rows")), "groups")
    salt = 0
    while True:
        g, lang = F.xxhash64(F.lit(salt), "lang", "source"), F.xxhash64(F.lit(salt), "lang")
        named = groups.select(g.alias("g"), lang.alias("l"), "lang", "source")
        seen = named.agg(F.count("*"), F.count_distinct("g"), F.count_distinct("l"), F.count_distinct("lang")).first()
        if seen[0] == seen[1] and seen[2] == seen[3]:
            return named, g
        salt += 1


def chance(count: Column, total: Column, terms: Column) -> Column:
    """p, exactly."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (total + terms).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """f: p - q is at most 10^9, so its square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value.cast(EXACT)), F.lit(0).cast(EXACT))


def pair_sums(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """g, h, value: the sum of f over all kept terms for every two groups of a language.

    ``groups``: g, l, total, held (kept terms that occur), terms; ``rows``: g, l, the term's
    key and n, its count.
    """
    none = F.when(F.col("terms") > 0, chance(F.lit(0), F.col("total"), F.greatest("terms", F.lit(1))))
    own = groups.select("g", "l", "total", "held", "terms", none.alias("p0"))
    other = own.select(F.col("g").alias("h"), "l", F.col("total").alias("other_total"), F.col("held").alias("other_held"), F.col("p0").alias("q0"))
    pairs = own.join(other, "l").filter(F.col("g") != F.col("h"))
    absent = (F.col("terms") - F.col("held") - F.col("other_held")).cast(EXACT) * gap(F.col("p0"), F.col("q0")).cast(EXACT)
    base = pairs.select("g", "h", F.coalesce(absent, F.lit(0).cast(EXACT)).alias("value"))
    # terms of one side, by their counts
    times = rows.groupBy("g", "l", "n").agg(F.count("*").alias("times"))
    mine = times.join(own.drop("l"), "g").select("l", "g", "times", chance(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0")
    met = mine.join(other, "l").filter(F.col("g") != F.col("h"))
    of_g = met.select("g", "h", (F.col("times") * gap(F.col("p"), F.col("q0")).cast(EXACT)).alias("value"))
    of_h = met.select(F.col("h").alias("g"), F.col("g").alias("h"), (F.col("times") * gap(F.col("q0"), F.col("p")).cast(EXACT)).alias("value"))
    # terms of both sides
    term = rows.join(own.drop("l", "held"), "g").select("l", "digest", "split", "g", chance(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0")
    again = term.select("l", "digest", "split", F.col("g").alias("h"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    mend = gap(p, q).cast(EXACT) - gap(p, q0) - gap(p0, q) + gap(p0, q0)
    both = term.join(again, ["l", "digest", "split"]).filter(F.col("g") != F.col("h")).select("g", "h", mend.alias("value"))
    sums = [x.groupBy("g", "h").agg(_total(F.col("value")).alias("value")) for x in (of_g, of_h, both)]
    out = base
    for x in sums:
        out = out.unionByName(x)
    return out.groupBy("g", "h").agg(_total(F.col("value")).cast("long").alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", bits: int = 64) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).alias("text"))
    groups, g = grouped(docs)
    texts = docs.select(g.alias("g"), "text")
    parts = cut(counted(texts, bits), "term-counts")
    of_term = ["digest", "split"]
    by_digest = cut(parts.groupBy("g", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumn("split", F.lit("")), "counts")

    def kept_of(counts: DataFrame) -> DataFrame:
        held = counts.join(groups.select("g", "l"), "g").groupBy("l", *of_term)
        return held.agg(F.sum("n").alias("n_l"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")

    kept = cut(kept_of(by_digest), "kept")
    ends = cut(ends_of(parts, kept), "term-ends")
    split = ends.filter(F.col("lo") != F.col("hi")).select("digest")
    counts = by_digest
    if not split.isEmpty():
        more = counted(texts, bits, split).groupBy("g", "digest", F.col("term").alias("split")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        counts = cut(by_digest.join(split, "digest", "left_anti").select("g", "digest", "n", "docs", "split").unionByName(more.select("g", "digest", "n", "docs", "split")), "split-counts")
        kept = cut(kept_of(counts), "kept")
    drop(parts)
    rows = counts.select("g", *of_term, "n").join(groups.select("g", "l"), "g").join(kept, ["l", *of_term])
    rows = cut(rows, "kept-counts")
    of_lang = kept.groupBy("l").agg(F.count("*").alias("terms"), F.sum("n_l").alias("lang_total"))
    of_group = rows.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    sized = groups.join(of_lang, "l", "left").join(of_group, "g", "left").na.fill(0, ["terms", "lang_total", "total", "held"])
    sized = cut(sized, "sized-groups")
    named = sized.select("g", "lang", "source")

    pairs = pair_sums(sized, rows.select("g", "l", *of_term, "n"))
    others = named.select(F.col("g").alias("h"), F.col("source").alias("item"))
    pairs = pairs.join(named, "g").join(others, "h").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(place))

    share = rows.join(sized.select("g", "total", "terms", "lang_total"), "g").withColumns(
        {"p": chance(F.col("n"), F.col("total"), F.col("terms")), "q": chance(F.col("n_l"), F.col("lang_total"), F.col("terms"))}
    )
    valued = share.filter(F.col("p") > F.col("q")).select("g", *of_term, gap(F.col("p"), F.col("q")).alias("value"))
    near = valued.withColumn("upto", F.rank().over(Window.partitionBy("g").orderBy(F.desc("value")))).filter(F.col("upto") <= top).drop("upto")
    near = cut(near, "top-terms")
    item = F.when(F.col("split") != "", F.col("split")).otherwise(F.col("lo")).alias("item")
    terms = near.join(ends.select("digest", "lo"), "digest").select("g", item, "value")
    terms = terms.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), F.asc("item")))).filter(F.col("rank") <= top)
    terms = terms.join(named, "g").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
