"""Language identification: averaged hashed subword embeddings with a linear softmax.

A word's subwords are its runs of two, three and four letters, the word's ends
counting as a letter. Each is hashed to a row of the embedding table; a text is
the mean of its rows, and a linear softmax over the languages follows. Both are
trained by stochastic gradient descent in numpy.

For scoring, embedding and softmax are one table (a linear function of a mean is
the mean of the linear function): every distinct word of a batch is summed once,
texts are sums over their words.

Rejection is calibrated on a third of the sample that training doesn't see: a
temperature makes the probabilities fit it, and the threshold is the probability
that all but ``reject`` of its right predictions reach.

The sample has about ``per_language`` pieces of up to ``piece_chars`` characters a
language, cut at hashed places of hashed documents; everything else covers all
texts whole.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows with
null language train nothing; without any, every text is ``und``. Repeated rows
are predicted each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPLIT_ON_BLANKS, map_arrow, mix64, slices, spans_to_rows, words

LENGTHS = (2, 3, 4)
BUCKETS = 1 << 16
NO_LANGUAGE = "und"


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Letters:
    """Which code points are letters; made once a process."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = _letters()
        return cls.table[points]


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, number of the text it stands in), ordered by length of subword."""
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    points = np.frombuffer((" " + "".join(t + " " for t in lowered)).encode("utf-32-le"), np.uint32)
    letter = Letters.of(points)
    code = np.where(letter, points, 32).astype(np.uint64)
    row = np.concatenate([[0], spans_to_rows(sizes)]) if len(sizes) else np.zeros(1, np.int64)
    buckets, rows = [], []
    with np.errstate(over="ignore"):
        for n in LENGTHS:
            count = len(code) - n + 1
            if count <= 0:
                continue
            whole = np.ones(count, bool)
            for k in range(1, n - 1):
                whole &= letter[k : k + count]
            whole &= letter[:count] | letter[n - 1 :] if n == 2 else whole
            at = np.flatnonzero(whole)
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + code[at + k]
            buckets.append((mix64(h) % np.uint64(BUCKETS)).astype(np.int64))
            rows.append(row[at + 1])  # a first place may be the blank before the text
    return (np.concatenate(buckets), np.concatenate(rows)) if buckets else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: embedding times softmax weights
    base: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (sums / np.maximum(counts, 1)[:, None] + self.base) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def by_text(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sums of table rows, number of subwords) of each text."""
    bucket, row = subwords(texts)
    counts = np.bincount(row, minlength=len(texts))
    sums = np.stack([np.bincount(row, weights=model.table[bucket, k], minlength=len(texts)) for k in range(len(model.languages))], axis=1)
    return sums, counts


def train(pieces: list[tuple[str, str]], dim: int = 16, epochs: int = 6, rate: float = 0.5, batch: int = 32, reject: float = 0.01, seed: int = 11) -> Model:
    """Stochastic gradient descent on two thirds of (text, language), calibration on the rest."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in pieces})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    order = rng.permutation(len(pieces))
    held, used = order[: len(order) // 3], order[len(order) // 3 :]
    y = np.array([languages.index(lang) for _, lang in pieces])
    bucket, row = subwords([t for t, _ in pieces])
    counts = np.bincount(row, minlength=len(pieces))
    bucket = bucket[np.argsort(row, kind="stable")]
    first = np.cumsum(counts) - counts
    embedding = rng.normal(0, 1 / dim, (BUCKETS, dim))
    weights, base = np.zeros((dim, len(languages))), np.zeros(len(languages))
    share = np.bincount(y[used], minlength=len(languages)) + 1.0
    balance = share.sum() / len(languages) / share
    step, steps = 0, epochs * -(-len(used) // batch)
    for _ in range(epochs):
        for mine in np.array_split(rng.permutation(used), max(1, len(used) // batch)):
            pace = rate * (1 - step / (steps + 1))
            step += 1
            size = counts[mine]
            mine, size = mine[size > 0], size[size > 0]
            if not len(mine):
                continue
            rows = np.concatenate([bucket[first[i] : first[i] + counts[i]] for i in mine])
            mean = np.add.reduceat(embedding[rows], np.cumsum(size) - size) / size[:, None]
            z = mean @ weights + base
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(mine)), y[mine]] -= 1
            p *= balance[y[mine], None] / len(mine)
            back = p @ weights.T
            weights -= 8 * pace * mean.T @ p
            base -= pace * p.sum(axis=0)
            np.add.at(embedding, rows, np.repeat(-8 * pace * back * len(mine) / size[:, None], size, axis=0))
    model = Model(languages, embedding @ weights, base)
    return calibrated(model, [pieces[i][0] for i in held], y[held], reject)


def calibrated(model: Model, texts: list[str], y: np.ndarray, reject: float) -> Model:
    """Set the temperature that makes the held-out loss least, and the threshold of rejection."""
    if not len(texts):
        return model
    sums, counts = by_text(model, texts)

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.probabilities(sums, counts)[np.arange(len(y)), y], 1e-12)).mean()

    model.temperature = min((2.0**e for e in np.arange(-4, 4.5, 0.5)), key=loss)
    p = model.probabilities(sums, counts)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    model.threshold = float(np.quantile(right, reject)) if len(right) else 0.0
    return model


def sample(docs: DataFrame, usable: Column, lang_col: str, id_col: str, text_col: str, per_language: int, piece_chars: int) -> list[tuple[str, str]]:
    """About ``per_language`` pieces a language, from documents with the smallest hashes."""
    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    shares = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # a row a language
    if not shares:
        return []
    keep = F.create_map(*(F.lit(x) for lang, n in shares.items() for x in (lang, min(1.0, per_language / n))))
    chance = F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    room = F.greatest(F.length(text_col) - piece_chars, F.lit(0)) + 1
    piece = F.substring(F.col(text_col), F.pmod(F.xxhash64(id_col), room).cast("int") + 1, F.lit(piece_chars))
    chosen = rows.filter(chance < F.element_at(keep, F.col(lang_col))).select(F.xxhash64(id_col).alias("h"), piece.alias("t"), F.col(lang_col).alias("l"))
    return [(r.t, r.l) for r in sorted(chosen.collect())]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m: Model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                codes, vocabulary, counts = words(part.column("text"), SPLIT_ON_BLANKS)
                n, k = len(counts), len(m.languages)
                lang, score = np.full(n, NO_LANGUAGE, object), np.zeros(n)
                row = spans_to_rows(counts)
                lettered = np.zeros(n, bool)
                if len(codes) and k:
                    sums, sizes = by_text(m, vocabulary)
                    has = np.fromiter((any(map(str.isalpha, w)) for w in vocabulary), bool, len(vocabulary))
                    lettered[row[has[codes]]] = True
                    per_text = np.stack([np.bincount(row, weights=sums[codes, j], minlength=n) for j in range(k)], axis=1)
                    p = m.probabilities(per_text, np.bincount(row, weights=sizes[codes], minlength=n))
                    lang = np.where(lettered, np.array(m.languages, object)[p.argmax(axis=1)], NO_LANGUAGE)
                    score = np.where(lettered, p.max(axis=1), 0.0)
                rejected = pa.array(~lettered | (score < m.threshold))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), rejected], ["doc_id", "lang_pred", "score", "rejected"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(
    docs: DataFrame, usable: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_language: int = 1000, piece_chars: int = 400
) -> DataFrame:
    """Train on the rows that ``usable`` lets through, predict all."""
    model = train(sample(docs, usable, lang_col, id_col, text_col, per_language, piece_chars))
    return predict(docs, model, id_col, text_col)
