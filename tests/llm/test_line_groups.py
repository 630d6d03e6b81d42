"""Line dedup against brute force where token groups are dense and lines are long."""

import collections

import numpy as np
import pytest

from tidemark.llm import line_dedup


def kept_by_hand(rows: list[tuple[int, str]], percent: int) -> dict[int, list[int]]:
    first = {}
    for d, t in rows:
        for i, line in enumerate(dict.fromkeys(t.split("\n"))):
            if line.split():
                first.setdefault(line, (d, i))
    classes = sorted((p, set(line.split())) for line, p in first.items())
    want = collections.defaultdict(list)
    for k, (p, s) in enumerate(classes):
        if not any(100 * len(s & e) >= percent * len(s | e) for _, e in classes[:k]):
            want[p[0]].append(p[1])
    return dict(want)


def varied(rng, words: list[str], changes: int, pool: int) -> str:
    """A line with some words replaced, some dropped and some added, so that it is near the threshold."""
    out = list(words)
    for _ in range(changes):
        k = int(rng.integers(len(out)))
        out[k : k + 1] = [[f"v{rng.integers(pool)}"], [], [out[k], f"v{rng.integers(pool)}"]][int(rng.integers(3))]
    return " ".join(out)


@pytest.mark.parametrize("earliest, long_line, token_bits", [(1, 96, 48), (2, 20, 4), (16, 96, 48)])
def test_dense_groups_and_long_lines(spark, monkeypatch, earliest, long_line, token_bits):
    monkeypatch.setattr(line_dedup, "EARLIEST", earliest)
    monkeypatch.setattr(line_dedup, "LONG_LINE", long_line)
    monkeypatch.setattr(line_dedup, "TOKEN_BITS", token_bits)
    rng = np.random.default_rng(17)
    rows = []
    for d in range(150):
        lines = []
        for _ in range(int(rng.integers(1, 4))):
            n = (5, 24, 90, 110, 260)[int(rng.integers(5))]
            base = [f"w{(7 * k) % 400}" for k in range(n)]  # one hot group of lines for each length
            lines.append(varied(rng, base, int(rng.integers(0, n // 4 + 1)), 60))
        rows.append((d, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = kept_by_hand(rows, 80)
    lines = sum(len(dict.fromkeys(t.split("\n"))) for _, t in rows)
    assert 20 < lines - sum(map(len, want.values())) and 20 < sum(map(len, want.values()))  # some go, some stay
    assert {r.doc: list(r.kept) for r in line_dedup.kept_lines(docs).collect()} == want


def test_sketches_never_differ_by_more_than_the_words(spark):
    rng = np.random.default_rng(3)
    sets = [sorted({int(x) for x in rng.integers(0, 2**62, n)}) for n in (0, 1, 40, 200, 900)]
    sets += [s[: len(s) * 9 // 10] for s in sets]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "i int, tokens array<long>")
    got = {r.i: (r.bits % 2**64, r.half % 2**64) for r in frame.select("i", line_dedup.sketch(frame.tokens).alias("bits"), line_dedup.half_sketch(frame.tokens).alias("half")).collect()}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differ, bits, half = len(set(a) ^ set(b)), got[i][0] ^ got[j][0], got[i][1] ^ got[j][1]
            assert bits.bit_count() <= differ
            assert (bits ^ half).bit_count() + half.bit_count() <= differ


@pytest.mark.parametrize("percent", [80, 51, 40])
def test_linked_lines_share_an_element_and_sharing_a_word_is_none(spark, percent):
    rng = np.random.default_rng(5)
    lines = {"w " * 3 + "only", "w"}
    while len(lines) < 90:
        base = [f"{'x' * (k % 9)}{k}" for k in range(int(rng.integers(4, 40)))]
        lines |= {varied(rng, base, k, 50) for k in range(4)}
    lines = sorted(x for x in lines if x)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    classes = line_dedup.line_classes(docs, "doc_id", "text")
    keys = collections.defaultdict(set)
    for r in line_dedup.elements(classes, percent).collect():
        keys[r.doc].add(r.key)
    sets, linked = [set(x.split()) for x in lines], 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= percent * len(a | b):
                linked += 1
                assert keys[i] & keys[j]
    assert linked > 20
    # lines that have nothing but their longest word in common made one group of all (percent over 50)
    apart = spark.createDataFrame([(i, f"commonlongword a{i} b{i} c{i} d{i}") for i in range(40)], "doc_id long, text string")
    rows = line_dedup.elements(line_dedup.line_classes(apart, "doc_id", "text"), 80)
    assert rows.groupBy("key").count().filter("count > 1").isEmpty()
