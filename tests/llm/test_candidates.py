"""Sets that share a block are candidates only if their sketches allow a link; tables go when their step is done."""

import os

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, line_dedup
from tidemark.session import checkpoint_root


def _words(seed, n):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 1 << 30, n)]


def _texts():
    """0, 1: unrelated; 2, 3: linked; 4 to 15: unrelated but for 12 and 13, all with one block in common."""
    near = _words(2, 200)
    texts = [_words(0, 200), _words(1, 200), near, near[:-3]] + [_words(x, 150) for x in range(4, 16)]
    texts[13] = texts[12][2:]
    return [" ".join(t) for t in texts]


def _tables(spark, *names):
    where = os.path.join(checkpoint_root(spark).removeprefix("file:"), "tidemark")
    return {d for d in (os.listdir(where) if os.path.isdir(where) else ()) if d.startswith(names)}


def test_unrelated_sets_that_share_a_block_make_no_region(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(_texts())), "doc_id long, text string")
    key = F.when(F.col("doc_id") < 4, F.floor(F.col("doc_id") / 2)).otherwise(F.lit(9)).alias("key")
    monkeypatch.setattr(jaccard_join, "keyed", lambda rows, *_: rows.select("doc_id", key))
    wanted, needed = [], jaccard_join.needed_sets

    def seen(rows, ids, length):
        wanted.extend(r.doc_id for r in ids.collect())
        return needed(rows, ids, length)

    monkeypatch.setattr(jaccard_join, "needed_sets", seen)
    out = {r.doc_id: r.component_id for r in jaccard_join.similar(docs, percent=80, length=5).collect()}
    assert {d: c for d, c in out.items() if d != c} == {3: 2, 13: 12}
    # a block of more than PAIRED documents ties them all
    assert jaccard_join.PAIRED < 12
    assert sorted(wanted) == [2, 3, *range(4, 16)]


def test_linked_sets_are_possible_whatever_their_sketches_widths(spark):
    t, rng = jaccard_join.Threshold(80), np.random.default_rng(5)
    pairs = []
    for n in (1, 5, 63, 64, 65, 70, 128, 500, 1020, 1030):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for gone in {0, n // 9, n // 5}:
            b = a[gone:]
            pairs.append((len(a), jaccard_join.sketch(a), len(b), jaccard_join.sketch(b)))
            more = np.concatenate([a[gone // 2 :], rng.integers(0, 1 << 63, gone // 2).astype(np.uint64)])
            if 100 * len(a[gone // 2 :]) >= 80 * (len(a) + gone // 2):
                pairs.append((len(a), jaccard_join.sketch(a), len(more), jaccard_join.sketch(more)))
    far = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64)), np.unique(rng.integers(0, 1 << 63, 520).astype(np.uint64))
    pairs.append((500, jaccard_join.sketch(far[0]), 520, jaccard_join.sketch(far[1])))
    batch = spark.createDataFrame(pairs, "n_a long, bits_a binary, n_b long, bits_b binary").coalesce(1).toArrow().to_batches()[0]
    assert jaccard_join.possible(batch, t).tolist() == [True] * (len(pairs) - 1) + [False]


def test_line_tables_go_when_their_step_is_done(spark):
    before = _tables(spark, "lines-", "linked-")
    docs = spark.createDataFrame([(1, "a b c d\nx y z w"), (2, "a b c d\nq r s t")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    assert out == {1: "a b c d\nx y z w", 2: "q r s t"}
    assert _tables(spark, "lines-", "linked-") == before
