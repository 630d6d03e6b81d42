"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; filters of six bytes slide over every place of the text;
their responses are max-pooled over chunks of two 256-byte blocks, each chunk
sharing one block with the next, so the chunks cover the whole text. The mean
and the maximum of the chunks' rectified responses go into one logistic unit.

Scoring needs no embedding: the response to a pair of neighbouring bytes is one
row of a table, so a place costs three lookups. Training follows the maxima
back (only the places that won a chunk have a gradient) and uses Adam.

The network is fitted on ``max_rows`` labelled documents (all, if there are fewer),
those with the smallest hash of their id; of a text longer than ``max_bytes``
bytes it takes a stretch of that size, at a place hashed from the id, and one
text of each id. All else
covers every document and byte. Labels, language, source and id are no inputs.

Nulls: a null text is an empty one and gets a score. A null label is no label;
of several labels of one id the smallest counts. Without labelled rows every
score is 0.5. Repeated documents are scored each for itself; an empty table
gives an empty table. A score depends on the text alone. Columns besides id and
text are not read; those of ``keep`` are passed on as ``kept_<name>``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, slices, spans_to_rows

BLOCK = 256
WIDTH = 6
TILE = 64  # blocks scored at once


@dataclass
class Network:
    embedding: np.ndarray  # 256 x d
    filters: np.ndarray  # WIDTH x d x f
    bias: np.ndarray  # f
    out: np.ndarray  # 2f: for the mean and the maximum over chunks
    base: np.ndarray  # 1

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.out, self.base]

    def pair_tables(self) -> list[np.ndarray]:
        """For each pair of the filters' places: responses to all 65,536 byte pairs (low byte first)."""
        one = [self.embedding @ w for w in self.filters]
        return [(one[k][None, :, :] + one[k + 1][:, None, :]).reshape(65536, -1).astype(np.float32) for k in range(0, WIDTH, 2)]


def start(d: int, f: int, rng: np.random.Generator) -> Network:
    shapes = ((256, d), (WIDTH, d, f))
    e, w = (rng.normal(0, s, shape).astype(np.float32) for s, shape in zip((0.5, 0.3), shapes, strict=True))
    return Network(e, w, np.zeros(f, np.float32), rng.normal(0, 0.1, 2 * f).astype(np.float32), np.zeros(1, np.float32))


def blocks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, each filled with zeros to whole blocks; blocks of each text, at least one)."""
    counts = np.array([(len(t) + WIDTH) // BLOCK + 1 for t in texts], np.int64)
    data = b"".join(t.ljust(int(n) * BLOCK, b"\0") for t, n in zip(texts, counts, strict=True))
    return np.frombuffer(data + bytes(WIDTH), np.uint8), counts


def inner(got: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Responses by block and place; places of a text's last block whose window leaves it don't count.

    Behind its bytes every text has a whole window of zeros, so no byte goes unseen.
    """
    got[last, 1 - WIDTH :] = -np.inf
    return got


def chunks_of(block_max: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Maximum over each block and the next block of the same text."""
    last = np.cumsum(counts) - 1
    chunk = block_max.copy()
    chunk[:-1] = np.maximum(block_max[:-1], block_max[1:])
    chunk[last] = block_max[last]
    return chunk


def pooled(net: Network, block_max: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability of each text from the filters' maxima in its blocks."""
    active = np.maximum(chunks_of(block_max, counts) + net.bias, 0)
    first = np.cumsum(counts) - counts
    mean = np.add.reduceat(active, first) / counts[:, None]
    top = np.maximum.reduceat(active, first)
    return 1 / (1 + np.exp(-(np.concatenate([mean, top], axis=1) @ net.out + net.base)))


def score(net: Network, tables: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    data, counts = blocks_of(texts)
    pairs = data[:-1].astype(np.uint16) | data[1:].astype(np.uint16) << 8
    n = int(counts.sum())
    last = np.zeros(n, bool)
    last[np.cumsum(counts) - 1] = True
    block_max = np.empty((n, len(net.bias)), np.float32)
    for a in range(0, n, TILE):
        b = min(n, a + TILE)
        at = slice(a * BLOCK, b * BLOCK)
        got = tables[0][pairs[at]]
        for k in (1, 2):
            got += tables[k][pairs[at.start + 2 * k : at.stop + 2 * k]]
        block_max[a:b] = inner(got.reshape(b - a, BLOCK, -1), last[a:b]).max(axis=1)
    return pooled(net, block_max, counts)


def gradients(net: Network, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted logistic loss over one batch."""
    data, counts = blocks_of(texts)
    n, f = int(counts.sum()), len(net.bias)
    tables = [(net.embedding @ w).astype(np.float32) for w in net.filters]
    got = tables[0][data[: n * BLOCK]]
    for k in range(1, WIDTH):
        got += tables[k][data[k : n * BLOCK + k]]
    got = inner(got.reshape(n, BLOCK, f), np.cumsum(counts) - 1)
    where = got.argmax(axis=1)
    block_max = np.take_along_axis(got, where[:, None, :], axis=1)[:, 0, :]
    chunk = chunks_of(block_max, counts)
    active = np.maximum(chunk + net.bias, 0)
    first = np.cumsum(counts) - counts
    mean, top = np.add.reduceat(active, first) / counts[:, None], np.maximum.reduceat(active, first)
    features = np.concatenate([mean, top], axis=1)
    error = (1 / (1 + np.exp(-(features @ net.out + net.base))) - labels) * weights / len(labels)
    row = spans_to_rows(counts)
    g = error[row, None] * net.out[None, :f] / counts[row, None]
    is_top = active == top[row]
    is_top = is_top & (np.cumsum(is_top, axis=0) - (np.cumsum(is_top, axis=0) - is_top)[first][row] == 1)  # the first of equals
    g = (g + is_top * error[row, None] * net.out[None, f:]) * (active > 0)
    # a chunk's maximum stands in its own block or in the next one
    own = block_max >= chunk
    to_block = g * own
    to_block[1:] += (g * ~own)[:-1]
    place = where + np.arange(n)[:, None] * BLOCK
    d_filters, d_embedding, column = np.empty_like(net.filters), np.zeros_like(net.embedding), np.arange(f)[None, :]
    for k in range(WIDTH):
        byte = data[place + k].astype(np.int64)
        by_byte = np.bincount((byte * f + column).ravel(), weights=to_block.ravel(), minlength=256 * f).reshape(256, f)
        d_filters[k] = net.embedding.T @ by_byte
        d_embedding += by_byte @ net.filters[k].T
    return [d_embedding, d_filters, g.sum(axis=0), features.T @ error, np.array([error.sum()])]


def fit(texts: list[bytes], labels: list[int], d: int = 8, f: int = 16, epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam over shuffled batches; both labels weigh alike in sum, and the bias is set back to their true share."""
    rng = np.random.default_rng(seed)
    net, y = start(d, f, rng), np.array(labels, np.float32)
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    weights = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step, steps = 0, max(1, epochs * -(-len(y) // batch))
    for _ in range(epochs if len(y) else 0):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            mine = order[a : a + batch]
            step += 1
            pace = rate * min(1, 2 * (1 - step / steps) + 0.02)
            for p, g, (m, v) in zip(net.parts(), gradients(net, [texts[i] for i in mine], y[mine], weights[mine]), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    net.base += np.log(share / (1 - share)).astype(np.float32)
    if not len(y):
        net.out[:] = 0
    return net


def training_rows(
    docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int, max_bytes: int, label_col: str, id_col: str, text_col: str
) -> tuple[list[bytes], list[int]]:
    """``max_rows`` labelled texts or stretches of them; their ids are chosen before any text is read."""
    rows = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & usable)
    rows = rows.groupBy(F.col(id_col).alias("wanted")).agg(F.min(label_col).alias("y"))
    rows = rows.join(docs.select(F.col(id_col).alias("wanted")), "wanted", "left_semi")  # labels of other documents take no place
    chosen = rows.orderBy(F.xxhash64("wanted"), "wanted").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("wanted"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "wanted")
    spare = F.greatest(F.octet_length("text") - max_bytes, F.lit(0))
    first = F.pmod(F.xxhash64("wanted", F.lit("stretch")), spare + 1).cast("int") + 1
    stretch = F.col("text").cast("binary").substr(first, F.lit(max_bytes))
    one = found.groupBy("wanted").agg(F.min(F.struct(stretch.alias("bytes"), "y")).alias("row"))  # of the texts of one id, the least stretch
    got = sorted(one.select("wanted", "row.bytes", "row.y").collect(), key=lambda r: (r[0], r[1]))
    return [bytes(r[1]) for r in got], [int(r[2]) for r in got]


def predict(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Adds column ``score`` to the id and the kept columns (named ``kept_<name>``)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(f"kept_{c}") for c in keep))

    def run(batches):
        tables = shared.value.pair_tables()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = pc.fill_null(part.column("text"), "").cast(pa.large_binary()).to_pylist()
                got = score(shared.value, tables, texts).astype(np.float64)
                columns = {n: c for n, c in zip(part.schema.names, part.columns, strict=True) if n != "text"} | {"score": pa.array(got)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = rows.drop("text").withColumn("score", F.lit(0.0)).schema
    return map_arrow(rows, run, schema)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    max_rows: int = 2000,
    max_bytes: int = 8192,
) -> DataFrame:
    """Fit on the labelled rows that ``usable`` lets through, score every document."""
    texts, y = training_rows(docs, labels, usable, max_rows, max_bytes, label_col, id_col, text_col)
    return predict(docs, fit(texts, y), id_col, text_col, keep)
