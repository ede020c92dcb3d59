"""Quality classifier: supervised subword embeddings (operator 8).

Every word, every pair of neighbouring words and every run of three and four
bytes of a text is hashed to a bucket (a pair of equal words to one of its own,
whatever the word); the buckets' learned vectors are averaged over the document and a
softmax layer tells good from poor. Vectors and layer are trained together by
stochastic gradient descent in numpy, on a bounded sample of the labelled rows
(``sample``, at most half of each class, drawn by a hash of the id; in the bias
the classes' true shares, counted over all labelled ids, replace those of the rows
trained on). As the layer is linear,
scoring needs only each bucket's product with the layer: one number a bucket.

Definitions: null and empty texts have no features and score by the bias alone;
labels that are null, other than 0 and 1, held out or without a document teach
nothing; if one class has no rows to learn from, every score is the other class.
An id teaches once: of repeated texts the smallest, of clashing labels 0. Repeated rows
are scored each. Case counts: upper and lower case hash apart. A text beyond
``SEGMENT`` bytes is read in segments cut at white space.

At scale: the sampled ids are broadcast (bounded by ``sample``), features of the
sample reach the driver as sparse counts, the table of buckets has a fixed size,
and scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks, held_out

SAMPLE = 3000
BUCKET_BITS = 17
WIDTH = 8
EPOCHS = 6
RATE = 0.5
SEGMENT = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_POWERS = _powers(1 << 12, _BASE), _powers(1 << 12, pow(_BASE, -1, 1 << 64))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        _POWERS = _powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64))
    return _POWERS


def features(raw: bytes, bits: int = BUCKET_BITS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For byte runs of three and four, words and pairs of words: where each starts and ends in ``raw``, and its bucket."""
    shift = np.uint64(64 - bits)
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    out = []
    for n in (3, 4):
        if len(b) >= n:
            x = b[: len(b) - n + 1].copy()
            for i in range(1, n):
                x |= b[i : len(b) - n + 1 + i] << np.uint64(8 * i)
            at = np.arange(len(x))
            out.append((at, at + n, ((x + np.uint64(n << 40)) * _MIX) >> shift))
    solid = np.concatenate(([False], b > 32, [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts):
        powers, inverse = _tables(len(b))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b + np.uint64(1)) * powers[: len(b)])))
        x = (sums[ends] - sums[starts]) * inverse[starts]
        x = (x ^ (x >> np.uint64(29))) * _SPREAD
        out.append((starts, ends, x >> shift))
        pairs = np.where(x[1:] == x[:-1], np.uint64(1), x[:-1] * _MIX ^ x[1:]) * _SPREAD
        out.append((starts[:-1], ends[1:], pairs >> shift))
    return out


def segments(text: str | None) -> list[bytes]:
    """UTF-8 of a text, cut at white space where it goes on beyond a segment."""
    raw = (text or "").encode()
    out, start = [], 0
    while len(raw) - start > SEGMENT:
        end = raw.find(b" ", start + SEGMENT)
        if end < 0:
            break
        out.append(raw[start:end])
        start = end
    return [*out, raw[start:]]


def bag(text: str | None, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs."""
    counts = np.zeros(1 << bits, np.int32)
    for raw in segments(text):
        for _, _, bucket in features(raw, bits):
            counts += np.bincount(bucket.astype(np.int64), minlength=1 << bits).astype(np.int32)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found]


class Embeddings:
    """Bucket vectors and a softmax layer over their average."""

    def __init__(self, bits: int = BUCKET_BITS, width: int = WIDTH, seed: int = 7):
        random = np.random.default_rng(seed)
        self.vectors = random.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
        self.layer = random.normal(0, 1, (width, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def learn(self, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> None:
        """Stochastic gradient descent, one document a step, with a falling rate. A bucket's step is scaled up by
        the number of features that share the gradient, as each holds only its share of the average."""
        random = np.random.default_rng(seed)
        steps, step = epochs * len(bags), 0
        for _ in range(epochs):
            for k in random.permutation(len(bags)):
                bucket, count = bags[k]
                now = rate * (1 - step / steps)
                step += 1
                n = max(1, int(count.sum()))
                share = (count / n).astype(np.float32)
                mean = share @ self.vectors[bucket]
                z = mean @ self.layer + self.bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[labels[k]] -= 1
                down = self.layer @ p
                self.layer -= now * np.outer(mean, p)
                self.bias -= now * p
                scale = now * np.sqrt(n) * share
                self.vectors[bucket] -= scale[:, None] * down[None, :]

    def products(self) -> tuple[np.ndarray, float]:
        """Each bucket's part in the log odds of label 1, and the bias."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def score_texts(texts: list[str | None], weights: np.ndarray, bias: float, bits: int = BUCKET_BITS) -> np.ndarray:
    """Probability of label 1 of each text."""
    parts, owner = [], []
    for k, text in enumerate(texts):
        for raw in segments(text):
            parts.append(raw)
            owner.append(k)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(lengths + 1) - lengths - 1
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    owner = np.array(owner, np.int64)
    for at, to, bucket in features(b" ".join(parts), bits):
        # Both ends rise from feature to feature; what reaches beyond its text is left out.
        value = np.concatenate(([0.0], np.cumsum(weights[bucket], dtype=np.float64)))
        first = np.searchsorted(at, starts)
        last = np.maximum(first, np.searchsorted(to, starts + lengths, "right"))
        np.add.at(total, owner, value[last] - value[first])
        np.add.at(n, owner, last - first)
    odds = bias + total / np.maximum(n, 1)
    return 1 / (1 + np.exp(-odds))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Bucket weights and bias from a bounded sample of ``labels`` (doc_id, label)."""
    taught = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
    share = {r.y: r["count"] for r in taught.groupBy("y").count().collect()}  # two rows at most
    if len(share) < 2:
        return np.zeros(1 << BUCKET_BITS, np.float32), 50.0 if 1 in share else -50.0
    halves = [taught.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most ``sample`` rows of two numbers
    out = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("bucket", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])

    def bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            found = [bag(t) for t in texts]
            yield pa.record_batch([batch["doc_id"], batch["y"], pa.array([f[0] for f in found], out.field(2).type), pa.array([f[1] for f in found], out.field(3).type)], schema=out)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    rows = map_arrow(texts, bags, "doc_id long, y int, bucket array<int>, n array<int>").toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    n1 = int(rows["y"].to_numpy().sum())
    n0 = rows.num_rows - n1
    if not n0 or not n1:  # at most one class has documents
        return np.zeros(1 << BUCKET_BITS, np.float32), 50.0 if n1 else -50.0 if n0 else float(np.log(share[1] / share[0]))
    model = Embeddings()
    model.learn(
        [(b.values.to_numpy(), c.values.to_numpy()) for b, c in zip(rows["bucket"], rows["n"], strict=True)], rows["y"].to_numpy())
    weights, bias = model.products()
    # The bias holds the odds of the classes in the rows trained on; the true odds take their place.
    return weights, bias + float(np.log(share[1] / share[0]) - np.log(n1 / n0))


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_quality(docs: DataFrame, weights: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row under a trained table of weights."""
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))  # 2^17 numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        for batch, texts in blocks(batches):
            yield pa.record_batch([batch.column(0), pa.array(score_texts(texts, w, b))], schema=_SCORES)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, score double")


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, mod: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted: learns from labels that are not held out, scores every row."""
    weights, bias = train(docs, labels.where(~held_out(F.col("doc_id"), mod, rest)))
    return score_quality(docs, weights, bias).select(
        "doc_id", held_out(F.col("doc_id"), mod, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
