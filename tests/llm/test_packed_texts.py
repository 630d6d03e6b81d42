"""LM scoring: texts are written and shuffled packed; windows are looked up in a hash table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.suffix_tree_lm import Places, placed_texts, unpacked_texts


def test_texts_are_packed_and_whole(spark):
    rows = [(i if i % 7 else None, None if i % 11 == 0 else f"some words {i} " * 200) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    packed = placed_texts(docs, F.col("doc_id") % 2 == 0, "doc_id", "text").toArrow()
    assert len(packed) < 10
    assert sum(len(x.as_py()) for x in packed.column("texts")) < sum(len(t or "") for _, t in rows) / 4
    back = [tuple(r.values()) for _, part in unpacked_texts(packed.to_batches()) for r in part.to_pylist()]
    assert back == [(i, i is not None and i % 2 == 0, t) for i, t in rows]
    assert sum(packed.column("learned").to_pylist()) == sum(r[1] for r in back)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 200_000])
def test_places_of_numbers(n):
    rng = np.random.default_rng(n)
    numbers = rng.permutation(np.unique(rng.integers(0, 1 << 55, n)))
    held = Places(numbers)
    asked = rng.integers(0, len(numbers), 5000) if n else np.zeros(0, np.int64)
    assert (held.of(numbers[asked]) == asked).all()
    with pytest.raises(KeyError):
        held.of(np.array([-5]))
