"""Each operator of the training-data pipeline against brute force, on odd rows and on small tables."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import (
    decontamination,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    quality_classifier,
    repetition,
    suffix_tree_lm,
    token_counts,
    token_store,
)
from tidemark.llm.common import crc_fold
from tidemark.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, score double, kept boolean, word string"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
TEXTS = [
    None,
    "",
    " \n\t ",
    "Word",
    "a  b \n\n c\td",
    BASE,
    BASE,
    BASE + " seventeen",
    "é ü ñ 日本   x　y don't <|endoftext|>",
    "x " * 3000,
    "\n".join([BASE] * 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 == 0 else "en", 0.5, None, "w") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (5, BASE, "en", None, True, None), (None, "no id here", None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def plain(text):
    return (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()


def test_ids_equal_the_library(ids_of):
    texts = [*TEXTS, " lead", "trail ", "a\r\nb", "it's  we're 's", "x\x1cy \x1c z", "1 22  333\n"]
    ids, counts = Encoder(PATH).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [ids_of(t) for t in texts]


def test_codes_give_any_id():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 300, 1500), rng.integers(0, 2**32, 700), [0, 255, 256, 2**32 - 1]]).astype(np.uint32)
    code = token_store.Code(token_store.encode(ids))
    assert (code.all() == ids).all() and all(code.at(i) == ids[i] for i in range(len(ids)))
    assert len(token_store.Code(token_store.encode(ids[:0]))) == 0


def test_token_store_round_trip(spark, odd, none, ids_of, tmp_path):
    token_store.write(odd, str(tmp_path / "a"), PATH, end_id=2)
    got = token_store.read(spark, str(tmp_path / "a"), with_ids=True).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    start = 0
    for row, (_, text) in zip(got, rows, strict=True):
        want = [*ids_of(text), 2]
        assert (row.start, row.n_tokens, row.ids) == (start, len(want), want)
        assert row.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    token_store.write(none, str(tmp_path / "b"), PATH, end_id=2)
    assert token_store.read(spark, str(tmp_path / "b")).count() == 0


def test_token_counts(odd, none, ids_of):
    lengths = sorted(len(ids_of(r.text)) for r in odd.collect())
    for r in token_counts.length_histogram(odd, PATH, block=4).collect():
        fits = [n for n in lengths if n <= r.length]
        assert (r.n_docs, r.docs_fitting, r.tokens_fitting) == (lengths.count(r.length), len(fits), sum(fits))
        assert r.tokens_truncated == sum(min(n, r.length) for n in lengths)
        assert math.isclose(r["quantile"], len(fits) / len(lengths))
    assert token_counts.length_histogram(none, PATH).count() == 0


def test_packing(odd, none, ids_of):
    rows = packing.pack_documents(odd, PATH, capacity=64, with_ids=True).collect()
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append(r)
    for group in held.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    whole = sorted((r.doc_id, r.start, tuple(r.ids)) for r in rows if r.doc_id == 9)
    assert [i for _, _, ids in whole for i in ids] == [*ids_of(TEXTS[9]), 0]
    assert len(held) == -(-sum(r.length for r in rows) // 64)
    assert packing.pack_documents(none, PATH).count() == 0


def test_packing_in_several_regions(spark):
    lengths = [7 + 13 * (i * 7919 % 97) for i in range(900)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack(items, capacity=2048, region_items=128).collect()
    assert sorted(r.doc_id for r in rows) == list(range(900))
    fill = collections.Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(lengths) // 2048) + 3


def test_repetition(odd, none):
    got = [(r.doc_id, r) for r in repetition.judge(odd, keep=("text", "score")).collect()]
    for _, r in got:
        w = (r.kept_text or "").encode().split()
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        lines = [x for x in (r.kept_text or "").split("\n") if x.encode().split()]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(hit), len(lines) - len(set(lines)))
        longest = max((k for k in range(1, min(len(w), 70)) if len({tuple(w[i : i + k]) for i in range(len(w) - k + 1)}) < len(w) - k + 1), default=0)
        assert r.longest_repeat == longest or len(w) > 100
    assert repetition.judge(none).count() == 0


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([("b", "Five SIX, seven eight nine-ten eleven twelve thirteen fourteen"), ("a", "日本"), ("a", None), (None, "")], "item_id string, text string")
    for size in (200_000, 2):  # one block of items, and several
        got = by_id(decontamination.scan(odd, items, keep=("score",), clean_text=True, block_words=size))
        assert got[5]["items"] == ["b"] and [tuple(s) for s in got[5]["hit_spans"]] == [(4, 14)]
        assert got[5]["clean_text"].split() == ["one", "two", "three", "four", "fifteen", "sixteen"]
        assert got[8]["items"] == ["a"] and not got[3]["contaminated"] and got[0]["n_words"] == 0
    assert decontamination.clean_documents(odd, items).columns == odd.columns
    assert decontamination.scan(none, items).count() == 0
    assert decontamination.scan(odd, items.limit(0)).filter("contaminated").count() == 0


def brute_components(texts, percent, length):
    sets = {}
    for d, t in texts:
        w = plain(t)
        sets[d] = {tuple(w[i : i + length]) for i in range(max(1, len(w) - length + 1))} if w else set()
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and label[a] < label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[b] = label[a]
                    changed = True
    return sets, label


@pytest.mark.parametrize("region_docs,splits", [(1024, 4), (4, 3), (4, 0)])
def test_jaccard_join(spark, monkeypatch, region_docs, splits):
    rng = np.random.default_rng(5)
    texts = []
    for g in range(6):
        base = [f"w{rng.integers(400)}" for _ in range(int(rng.integers(3, 150)))]
        for _ in range(int(rng.integers(1, 14))):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(len(own)))] = f"n{rng.integers(9999)}"
            texts.append((len(texts), " ".join(own)))
    texts += [(1000, None), (1001, ""), (1002, "one two"), (1003, "One  two"), (1004, "one")]
    real = jaccard_join.join_regions
    monkeypatch.setattr(jaccard_join, "join_regions", lambda m, t: real(m, t, region_docs, 10**9, splits))
    docs = spark.createDataFrame([(d, t, 1) for d, t in texts], "doc_id long, text string, slot int")
    got = by_id(jaccard_join.similar(docs, percent=80, length=3))
    sets, label = brute_components(texts, 80, 3)
    assert {d: r["component_id"] for d, r in got.items()} == label
    assert all(got[d]["n_shingles"] == len(s) for d, s in sets.items())


def test_jaccard_join_odd_rows(odd, none):
    got = jaccard_join.similar(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert jaccard_join.similar(none).count() == 0


def test_block_keys_lose_no_partner():
    rng = np.random.default_rng(9)
    for percent in (80, 90):
        t = jaccard_join.Threshold(percent)
        bands = t.bands(1 << 20)
        for n in (1, 2, 5, 9, 10, 19, 40, 300):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
                b = a[int(rng.integers(0, len(a) - math.ceil(len(a) * percent / 100) + 1)) :]
                assert np.intersect1d(jaccard_join.block_keys(a, t, bands), jaccard_join.block_keys(b, t, bands)).size


def test_line_dedup(spark, odd, none):
    rng = np.random.default_rng(1)
    rows = []
    for d in range(60):
        lines = []
        for _ in range(int(rng.integers(0, 5))):
            base = [f"t{k}" for k in range(int(rng.integers(3)) * 7, int(rng.integers(3)) * 7 + 22)]
            for _ in range(int(rng.integers(0, 6))):
                base[int(rng.integers(len(base)))] = f"u{rng.integers(30)}"
            lines.append(" ".join(base))
        rows.append((d, "\n".join(lines)))
    first = {}
    for d, t in rows:
        for i, line in enumerate(dict.fromkeys(t.split("\n"))):
            if line.split():
                first.setdefault(line, (d, i))
    classes = sorted((p, set(line.split())) for line, p in first.items())
    want = collections.defaultdict(list)
    for k, (p, s) in enumerate(classes):
        if not any(100 * len(s & e) >= 80 * len(s | e) for _, e in classes[:k]):
            want[p[0]].append(p[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc: list(r.kept) for r in line_dedup.kept_lines(docs).collect()} == dict(want)
    out = line_dedup.deduplicate(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = by_id(out)
    assert texts[6]["text"] == "" and texts[10]["text"] == "" and texts[0]["text"] is None and texts[None]["text"] == "no id here"
    assert line_dedup.deduplicate(none).count() == 0


def test_base_score_and_normalised_model(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    got = [r for r in suffix_tree_lm.score(odd, crc_fold() != 1).collect()]
    learned = [t for d, t in [*rows, (None, "no id here")] if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1]
    c = collections.Counter(w for t in learned for w in plain(t))
    n, v = sum(c.values()) + len(learned), len(c) + 1
    for r in got:
        text = dict(rows).get(r.doc_id, "no id here")
        counts = [*(c[w] for w in plain(text)), len(learned)]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(counts), sum(x > 0 for x in counts), n)
        assert math.isclose(r.base_score, sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in counts), rel_tol=1e-9)
        assert r.score < 0
    assert suffix_tree_lm.score(none, crc_fold() != 1).count() == 0


def test_automaton_equals_longest_suffixes():
    texts = pa.array(["abra cadabra abra", "", None, "bra " * 400], pa.string())
    depth = 3
    code, n = suffix_tree_lm.windows(texts, depth)
    counts = collections.Counter()
    for w, k in zip(code.tolist(), n.tolist(), strict=True):
        for size in range(depth + 1):
            counts[size, w & (1 << 8 * (size + 1)) - 1] += k
    size, gram = (np.array(x, np.int64) for x in zip(*counts, strict=True))
    tree = suffix_tree_lm.learn(size, gram, np.array(list(counts.values())), depth, 1e-6, 1.0)
    assert np.allclose((10.0**tree.log10).sum(axis=1) + (10.0 ** tree.log10[:, -1]) * (255 - tree.log10.shape[1] + 1), 1, atol=1e-3)
    whole = tree.scores(texts)
    alone = [tree.scores(pa.array([t], pa.string()))[0] for t in texts.to_pylist()]
    assert np.allclose(whole, alone) and whole[3] > -400


def test_language_id(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = by_id(language_id.identify(docs, crc_fold() != 0))
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(got[r.doc_id]["lang_pred"] == r.lang for r in held) >= 0.95 * len(held)
    found = language_id.identify(odd, crc_fold() != 0).collect()
    assert all((r.lang_pred == "und") == (r.doc_id in (0, 1, 2)) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    assert language_id.identify(none, crc_fold() != 0).count() == 0


def test_quality_classifier(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = by_id(quality_classifier.classify(docs, labels, crc_fold() != 0))
    held = [(r.quality, got[r.doc_id]["score"]) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = [s for q, s in held if q == 1], [s for q, s in held if q == 0]
    assert sum(g > b for g in good for b in bad) > 0.9 * len(good) * len(bad)
    found = quality_classifier.classify(odd, labels.limit(0), crc_fold() != 0, keep=("score", "word")).collect()
    assert len(found) == odd.count() and all(r.score == 0.5 for r in found)
    assert quality_classifier.classify(none, labels, crc_fold() != 0).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = quality_classifier.start(3, 4, rng)
    for part in net.parts():
        part += rng.normal(0, 0.1, part.shape).astype(np.float32)
    texts, y = [b"hello world " * 40, b"", b"***$$$ " * 9], np.array([1.0, 0, 0])
    tables = lambda: quality_classifier.score(net, net.pair_tables(), texts)
    loss = lambda: -(y * np.log(tables()) + (1 - y) * np.log(1 - tables())).mean()
    got = quality_classifier.gradients(net, texts, y, np.ones(3))
    for part, g, place in ((net.out, got[3], 2), (net.base, got[4], 0)):
        part[place] += 1e-2
        up = loss()
        part[place] -= 2e-2
        assert math.isclose((up - loss()) / 2e-2, g[place], rel_tol=0.05, abs_tol=1e-3)
        part[place] += 1e-2
