"""What the operators must do beyond their first tests: cases that an earlier version cut short."""

import collections

import corpus_pipeline
import pyarrow as pa
import public_tokenizers
import numpy as np
import pytest

from pyspark.sql import functions as F
from test_operators import brute_components

from tidemark.llm import line_dedup, quality_classifier, queries, suffix_tree_lm, token_counts
from tidemark.llm.common import crc_fold
from tidemark.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ADDED = ["a <|endoftext|> b", None, "plain text\nhere", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext", "  a\t b"]


def test_added_tokens_equal_the_library(library):
    for texts in (ADDED, ADDED[:1], ADDED[1:3], []):
        ids, counts = Encoder(PATH, added_tokens=True).encode(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [library(t) for t in texts]
    assert library(ADDED[0]) == [64, 220, 50256, 275]


def test_queries_count_added_tokens_as_the_library(spark, tmp_path, library):
    spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = [len(library(t)) for t in ADDED]
    found = {r.doc_id: r.n_tokens for r in queries.op10_token_store(spark, str(tmp_path)).collect()}
    assert found == {i: n + 1 for i, n in enumerate(want)}
    counted = queries.op4_token_counts(spark, str(tmp_path)).collect()
    assert sorted(n for r in counted for n in [r.length] * r.n_docs) == sorted(want)
    packed = queries.op3_best_fit_packing(spark, str(tmp_path)).collect()
    assert sum(r.length for r in packed) == sum(want) + len(want)


def test_line_dedup_keeps_every_wordless_line(spark):
    rows = [
        (1, "a one\n\nb two\n\n\nc three\n \n \nd four"),
        (2, "\n\nnew line\n\na one\nnew line\n\nother words\n"),
        (3, "b two\n\n\nc three"),
        (4, None),
        (5, ""),
        (6, "same same\nsame same\n\nsame same"),
    ]
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\n\nnew line\n\n\nother words\n", 3: "\n", 4: None, 5: "", 6: "same same\n"}


def test_near_duplicates_link_at_five_words_and_eight_tenths(spark):
    base = [f"w{i}" for i in range(200)]
    near = ["changed" + w if i in (20, 70, 120, 170) else w for i, w in enumerate(base)]  # five-word 0.815, three-word 0.886
    far = ["changed" + w if i % 30 == 10 else w for i, w in enumerate(base)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((base, near, far))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == [0, 2]


def lm_corpus(n):
    rng = np.random.default_rng(11)
    vocabulary = [f"{a}{b}{c}" for a in ("st", "pl", "qu", "é") for b in ("a", "ea", "o") for c in ("r", "nd", "st", "")]
    return [(i, " ".join(vocabulary[k] for k in rng.geometric(0.06, 40) % len(vocabulary)) if i % 9 else None) for i in range(n)]


def automaton_of(texts, depth, min_count, min_gain, smooth):
    """The model by ``learn``, from all contexts that occur often enough."""
    code, n = suffix_tree_lm.windows(pa.array(texts, pa.string()), depth)
    grams, contexts = collections.Counter(), collections.Counter()
    for w, k in zip(code.tolist(), n.tolist(), strict=True):
        for size in range(depth + 1):
            grams[size, w & (1 << 8 * (size + 1)) - 1] += k
    for (size, gram), k in grams.items():
        contexts[size, gram >> 8] += k
    kept = [(size, gram, k) for (size, gram), k in grams.items() if not size or contexts[size, gram >> 8] >= min_count]
    return suffix_tree_lm.learn(*(np.array(x, np.int64) for x in zip(*kept, strict=True)), depth, min_gain / n.sum(), smooth)


@pytest.mark.parametrize("split_bytes", [32 << 20, 500])
def test_lm_scores_equal_the_automaton(spark, monkeypatch, split_bytes):
    monkeypatch.setattr(suffix_tree_lm, "SPLIT_BYTES", split_bytes)
    rows = [*lm_corpus(60), (60, "zzz unseen \U0001f600 words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in suffix_tree_lm.score(docs, F.col("doc_id") < 40, depth=4, min_count=5, min_gain=2.0, smooth=3.0).collect()}
    tree = automaton_of([t for _, t in rows[:40]], 4, 5, 2.0, 3.0)
    want = tree.scores(pa.array([t for _, t in rows], pa.string()))
    assert np.allclose([got[i] for i, _ in rows], want, rtol=1e-4)


def test_lm_keeps_contexts_that_any_corpus_size_makes_rare(spark):
    """A phrase of a rare source is learned though its share of a larger corpus is small."""
    rare = [(10_000 + i, "xqxq zvzv") for i in range(30)]
    common = [(i, "some plain words of the common source " * 500) for i in range(400)]  # 7.6 million symbols
    docs = spark.createDataFrame([*common, *rare], "doc_id long, text string")
    got = {r.doc_id: r.score for r in suffix_tree_lm.score(docs, F.lit(True)).collect()}
    assert got[10_000] > -12  # about -50 by single bytes


def test_rows_that_share_an_id_are_documents_of_their_own(spark, tmp_path):
    rows = [(7, "first line of seven\nsecond thing here"), (7, "other words entirely\nsecond thing here\nthe last"), (3, "first line of seven"), (None, "the last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in line_dedup.deduplicate(docs).collect()]
    assert collections.Counter(d for d, _ in got) == collections.Counter(d for d, _ in rows) and (None, "the last") in got
    lines = [x for d, t in got if d is not None for x in t.split("\n") if x]
    assert sorted(lines) == ["first line of seven", "other words entirely", "second thing here", "the last"]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op9_line_dedup(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_lines) for r in found) == [(0, 1), (3, 1), (7, 2), (7, 3)]
    assert sum(r.n_kept for r in found) == 4


def test_near_duplicates_of_one_id(spark):
    base = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, base), (5, base + " more"), (5, "nothing like the others at all"), (9, "twice the same text here ok"), (9, "twice the same text here ok")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect())
    assert got == [(1, base), (5, "nothing like the others at all"), (9, "twice the same text here ok")]


def test_token_counts_at_any_limit(spark):
    lengths = [3, 3, 10, 50, 0, 120]
    rows = [(n, lengths.count(n), n * lengths.count(n)) for n in set(lengths)]
    histogram = token_counts.suffix_sums(spark.createDataFrame(rows, "length long, n_docs long, tokens long"), block=16)
    limits = [1, 3, 7, 49, 50, 119, 120, 4096]
    got = {r.limit: tuple(r)[1:] for r in token_counts.at_limits(histogram, limits).collect()}
    for k in limits:
        fits = [n for n in lengths if n <= k]
        cut_to = sum(min(n, k) for n in lengths)
        assert got[k] == (len(fits), sum(fits), len(lengths) - len(fits), cut_to, sum(lengths) - cut_to)
    above_least = token_counts.suffix_sums(spark.createDataFrame([(5, 2, 10)], "length long, n_docs long, tokens long"))
    assert [tuple(r) for r in token_counts.at_limits(above_least, [2]).collect()] == [(2, 0, 0, 2, 4, 6)]
    assert [tuple(r) for r in token_counts.at_limits(above_least.limit(0), [2]).collect()] == [(2, 0, 0, 0, 0, 0)]


def test_long_texts_train_the_classifier(spark):
    good, bad = "plain calm prose about rivers and towns. ", "$$$ BUY!!! now*** 1234 %%% "
    rows = [(i, "é" + (good if i % 2 else bad) * 600) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")  # half of no document
    texts, y = quality_classifier.training_rows(docs, labels, F.lit(True), 30, 8192, "quality", "doc_id", "text")
    assert len(texts) == 30 and 0 < sum(y) < 30 and {len(t) for t in texts} == {8192}
    whole = {t.encode() for _, t in rows}
    assert all(any(t in w for w in whole) for t in texts) and len(set(texts)) > 2
    got = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels, F.lit(True)).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(40))


def pipeline_tables(folder, spark):
    rng = np.random.default_rng(21)
    vocabulary = [f"{a}{b}{c}" for a in ("ri", "ta", "mo", "sel", "ba") for b in ("ver", "lo", "nik", "da", "pu") for c in ("s", "ra", "t", "en", "")]
    prose = lambda n: [vocabulary[k] for k in rng.integers(len(vocabulary), size=n)]
    lines = lambda w, shift=0: "\n".join(" ".join(w[max(a, 0) : a + 12]) for a in range(-shift, len(w), 12) if w[max(a, 0) : a + 12])
    texts = ["\n\n".join(" ".join(prose(25)) for _ in range(4)) + "\n" for _ in range(24)]
    base = prose(200)
    near, far = list(base), list(base)
    for k in (20, 70, 120, 170):  # five-word similarity 0.815, three-word 0.886
        near[k] = f"near{k}"
    for k in range(10, 200, 30):
        far[k] = f"far{k}"
    texts += [lines(base), lines(near, 4), lines(far, 8)]
    line = prose(20)
    texts += [" ".join(line) + "\n\n" + " ".join(prose(20)), " ".join(prose(20)) + "\n\n\n" + " ".join([*line[:19], "other"]), " ".join(line)]
    item = [f"item{k}" for k in range(14)]
    texts += [" ".join(prose(9) + item[2:12] + prose(9)), " ".join(prose(9) + item[2:11] + prose(9)), "a <|endoftext|> b", None, ""]
    texts += [" ".join(f"$$$ BUY{k}!!! {k * 7919} ***" for k in range(j, j + 40)) for j in range(0, 1200, 60)]
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, int("$$$" not in (t or "")), 0) for i, t in enumerate(texts) if t]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("x", " ".join(item))], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(enumerate(texts)), [x.lower() for x in item]


def brute_line_stage(texts):
    first = {}
    for d in sorted(texts):
        for i, line in enumerate((texts[d] or "").split("\n")):
            if line.split():
                first.setdefault(line, (d, i))
    classes = sorted((p, set(line.split())) for line, p in first.items())
    stay = {p for k, (p, s) in enumerate(classes) if not any(100 * len(s & e) >= 80 * len(s | e) for _, e in classes[:k])}
    out = {}
    for d, t in texts.items():
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if not x.split() or (d, i) in stay)
        if (left or "").split() or not (t or "").split():
            out[d] = left
    return out


def test_pipeline_stages_equal_brute_force(spark, tmp_path, monkeypatch, library):
    texts, item = pipeline_tables(str(tmp_path), spark)
    found, real = {}, corpus_pipeline.cut
    monkeypatch.setattr(corpus_pipeline, "cut", lambda df, name, **options: found.setdefault(name, real(df, name, **options)))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {name: {r.doc_id: r.text for r in found[name].collect()} for name, _ in corpus_pipeline.STAGES[:-1]}
    docs, labels = (spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("documents", "labels"))
    scores = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels, crc_fold() != 0).collect()}
    want = {d: t for d, t in texts.items() if scores[d] >= 0.3}
    assert got["quality_classifier"] == want and 24 <= len(want) < len(texts)
    want = brute_line_stage(want)
    assert got["line_dedup"] == want
    assert all(r.n_chars == len(r.text) for r in found["line_dedup"].collect() if r.text is not None)
    _, label = brute_components([(d, t) for d, t in want.items()], 80, 5)
    want = {d: t for d, t in want.items() if label[d] == d}
    assert got["near_duplicates"] == want and 24 in want and 25 not in want and 26 in want
    windows = {tuple(item[i : i + 10]) for i in range(5)}
    held = lambda t: any(tuple(w[i : i + 10]) in windows for w in [(t or "").lower().split()] for i in range(len(w)))
    want = {d: t for d, t in want.items() if not held(t)}
    assert got["decontamination"] == want and 30 not in want and 31 in want
    assert {d: sum(r.length for r in packed if r.doc_id == d) for d in want} == {d: len(library(t)) + 1 for d, t in want.items()}
    assert {r.doc_id for r in packed} == set(want)
