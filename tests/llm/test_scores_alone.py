"""Quality scores depend on the text alone; helper columns give way to the input's."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import line_dedup
from tidemark.llm import quality_classifier as qc


def net_of(seed=0, d=3, f=4):
    rng = np.random.default_rng(seed)
    net = qc.start(d, f, rng)
    for part in net.parts():
        part += rng.normal(0, 0.1, part.shape).astype(np.float32)
    return net


def naive(net, text):
    """The network place by place: zeros follow the text, as many as fill its blocks."""
    blocks = (len(text) + qc.WIDTH) // qc.BLOCK + 1
    data = text.ljust(blocks * qc.BLOCK, b"\0")
    got = np.full((blocks, len(net.bias)), -np.inf)
    for at in range(len(data) - qc.WIDTH + 1):
        response = sum(net.embedding[data[at + k]].astype(np.float64) @ net.filters[k] for k in range(qc.WIDTH))
        got[at // qc.BLOCK] = np.maximum(got[at // qc.BLOCK], response)
    chunks = [np.maximum(got[b], got[b + 1]) if b + 1 < blocks else got[b] for b in range(blocks)]
    active = np.maximum(np.array(chunks) + net.bias, 0)
    return 1 / (1 + np.exp(-(np.concatenate([active.mean(axis=0), active.max(axis=0)]) @ net.out + net.base[0])))


TEXTS = [b"", b"a", b"hello world " * 40, *(b"xyz$" * 70 for _ in range(2)), *(bytes(range(65, 91)) * 10 for _ in range(1))]
TEXTS += [b"q" * n for n in range(248, 260)] + [b"ab" * n for n in (255, 256, 300)]


def test_scores_equal_the_naive_network():
    net = net_of()
    tables = net.pair_tables()
    want = np.array([naive(net, t) for t in TEXTS])
    together = qc.score(net, tables, TEXTS)
    alone = np.array([qc.score(net, tables, [t])[0] for t in TEXTS])
    behind = qc.score(net, tables, TEXTS[::-1])[::-1]
    for got in (together, alone, behind):
        assert np.abs(got - want).max() < 1e-5


def test_all_gradients():
    net = net_of(1)
    texts, y, w = [b"hello world " * 40, b"", b"***$$$ " * 9, b"q" * 253], np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 0.5, 1])

    def loss():
        p = np.array([naive(net, t) for t in texts])
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    rng = np.random.default_rng(2)
    for part, g in zip(net.parts(), qc.gradients(net, texts, y, w), strict=True):
        flat, g = part.reshape(-1), np.asarray(g).reshape(-1)
        largest = np.argsort(-np.abs(g))[:3]
        for at in {*largest.tolist(), int(rng.integers(len(flat)))}:
            before = flat[at]
            flat[at] = before + 2e-3
            up = loss()
            flat[at] = before - 2e-3
            down = loss()
            flat[at] = before
            assert abs((up - down) / 4e-3 - g[at]) < 0.02 * abs(g[at]) + 1e-3


def test_one_text_of_an_id_trains(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    texts, y = qc.training_rows(docs, labels, F.lit(True), 10, 8192, "quality", "doc_id", "text")
    assert (texts, y) == ([b"text 0", b"other"], [1, 0])


def test_lines_keep_columns_of_any_name(spark):
    line = "one two three four five"
    docs = spark.createDataFrame([(1, line, 99), (2, line + "\nsix seven", 98)], "doc_id long, text string, llm_row int")
    got = sorted(tuple(r) for r in line_dedup.deduplicate(docs).collect())
    assert got == [(1, line, 99), (2, "six seven", 98)]
