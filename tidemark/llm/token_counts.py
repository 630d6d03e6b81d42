"""Token counts: exact length histogram with suffix sums.

Every document is encoded once for its length; documents are then summed by
length. Sums over the histogram from either end answer, for every context limit
that is some document's length (``at_limits``: for any): how many documents fit, their tokens, the
tokens left when longer ones are cut at the limit, and the share of documents.

The histogram has at most one row a distinct length. Its running sums are taken
block by block (``block`` lengths each, with the blocks' own totals added), so
no window holds the whole histogram.

Nulls: a null text counts as empty (length 0). Repeated rows count as often as
they stand. An empty table gives an empty histogram. Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, map_arrow, slices
from tidemark.llm.tokens import encoder


def token_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """One row (length) a document."""

    def lengths(batches):
        enc = encoder(tokenizer, added_tokens)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(enc.encode(part.column("text"))[1])], ["length"])

    return map_arrow(docs.select(F.col(text_col).cast("string").alias("text")), lengths, "length long")


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text", block: int = 1024, added_tokens: bool = False) -> DataFrame:
    """length, n_docs, tokens and the sums up to and from that length, one row a distinct length."""
    counts = token_lengths(docs, tokenizer, text_col, added_tokens).groupBy("length").agg(F.count("*").alias("n_docs"))
    # written, as the sums read it twice and texts are to be encoded once
    counts = cut(counts.withColumn("tokens", F.col("length") * F.col("n_docs")), "length-counts")
    return suffix_sums(counts, block)


def suffix_sums(counts: DataFrame, block: int = 1024) -> DataFrame:
    """Answers for every limit from a histogram (length, n_docs, tokens)."""
    counts = counts.withColumn("block", F.floor(F.col("length") / block))
    totals = counts.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    upto = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of lengths
    whole = Window.partitionBy()
    totals = totals.select(
        "block",
        F.coalesce(F.sum("block_docs").over(upto), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("block_tokens").over(upto), F.lit(0)).alias("tokens_before"),
        F.sum("block_docs").over(whole).alias("all_docs"),
        F.sum("block_tokens").over(whole).alias("all_tokens"),
    )
    within = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        counts.join(totals, "block")
        .withColumn("docs_fitting", F.col("docs_before") + F.sum("n_docs").over(within))
        .withColumn("tokens_fitting", F.col("tokens_before") + F.sum("tokens").over(within))
    )
    longer = F.col("all_docs") - F.col("docs_fitting")
    return summed.select(
        "length",
        "n_docs",
        "tokens",
        "docs_fitting",
        "tokens_fitting",
        longer.alias("docs_longer"),
        (F.col("all_tokens") - F.col("tokens_fitting")).alias("tokens_of_longer"),
        (F.col("tokens_fitting") + longer * F.col("length")).alias("tokens_truncated"),
        (F.col("docs_fitting") / F.col("all_docs")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_fitting, tokens_fitting, docs_longer, tokens_truncated, tokens_cut for any limits, a bounded list of them."""
    spark = histogram.sparkSession
    wanted = spark.createDataFrame([(int(n),) for n in sorted(set(limits))], "limit long")
    fits = F.col("length") <= F.col("limit")
    over = lambda c: F.coalesce(F.sum(F.when(~fits, F.col(c))), F.lit(0))
    upto = lambda c: F.coalesce(F.sum(F.when(fits, F.col(c))), F.lit(0))
    met = wanted.join(histogram.select("length", "n_docs", "tokens"), how="left").groupBy("limit")
    summed = met.agg(
        upto("n_docs").alias("docs_fitting"),
        upto("tokens").alias("tokens_fitting"),
        over("n_docs").alias("docs_longer"),
        over("tokens").alias("longer"),
    )
    left = F.col("docs_longer") * F.col("limit")
    return summed.select(
        "limit",
        "docs_fitting",
        "tokens_fitting",
        "docs_longer",
        (F.col("tokens_fitting") + left).alias("tokens_truncated"),
        (F.col("longer") - left).alias("tokens_cut"),
    )


def length_quantile(histogram: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least the share ``q`` of the documents doesn't exceed."""
    return histogram.filter(F.col("quantile") >= q).agg(F.min("length").alias("length"))
