"""Toxicity by nearest labelled examples (operator 4).

A text's terms are its words in ASCII lower case and the words' first four characters,
which inflected words share. A bounded sample of the labelled documents (``sample``,
drawn by a hash of the id) gives the examples; all their terms count. Texts and
examples are unit TF-IDF vectors, with document frequencies over all documents. In a
term's weight its IDF is multiplied by its relevance, the squared z value of its log
odds ratio between marked and other examples (half a row added to each count): plain
TF-IDF finds texts of one kind of prose, not of one label (README has the figures).

The k nearest examples by cosine are found exactly. Terms that many examples hold are
dense rows, scored for a block of texts at once by one matrix product. That part of a
cosine is a lower bound, so its k-th best is a floor. The other terms have an inverted
index cut into blocks of examples with the largest weight of each term in each block:
the blocks of largest bound are visited first, which lifts the floor, then those
whose bound still reaches it. The last candidates are scored
again in double precision. The neighbours vote with weights that fall with distance,
together with ``PRIOR`` votes of the base rate; they are returned as evidence.

Definitions: null and empty texts and texts without a term of any example score the
share of label 1 among the examples without one, smoothed by the same prior. Labels
that are null, other than 0 and 1, held out or without a document teach nothing and
use up no place of the sample; without any example every score is 0. Equal cosines go
to the example of smaller id; repeated examples count once (of clashing texts the
smallest, of clashing labels 1). Repeated rows are scored each. Very long texts are
counted whole. An empty table of documents gives no rows. Other columns are not read,
but those in ``carry``, which come back unchanged as a struct, whatever their names.

At scale: texts are read twice, for frequencies (summed in each task, one row a term
leaves it) and for scores; the index is bounded by the terms of ``sample`` rows, is
sent as packed counts and made by each task, which takes about half a second, so that no idle worker holds it; scoring has no shuffle.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.kept import kept, let_go
from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks, held_out

SAMPLE = 2500
NEIGHBOURS = 15
PRIOR = 1.0
BLOCK = 64
#: Terms that more than one in so many examples hold are dense rows.
DENSE = 16
PREFIX = 4
#: Blocks that are visited first.
LEAD = 4
#: Texts whose dense part is one matrix product.
TOGETHER = 64
#: About so many bytes of text are counted together, so that a word they share is looked up once.
COUNTED_BYTES = 4 << 20
#: More than the product's single precision can be wrong by.
SLACK = 1e-4

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[str]:
    return (text or "").encode().translate(_FOLD).decode().split(" ")


def term_counts(text: str | None) -> tuple[Counter[str], Counter[str]]:
    """How often each word occurs, and each beginning of ``PREFIX`` characters."""
    words = Counter(words_of(text))
    words.pop("", None)
    begins: Counter[str] = Counter()
    for w, n in words.items():
        if len(w) >= PREFIX:
            begins[w[:PREFIX]] += n
    return words, begins


class Vocabulary:
    """The examples' words and beginnings, with places 0, 1, ... in one row of terms."""

    def __init__(self, words: Sequence[str], begins: Sequence[str]):
        self.words, self.begins = pa.array(words, pa.large_string()), pa.array(begins, pa.large_string())

    def __len__(self) -> int:
        return len(self.words) + len(self.begins)

    def counted(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Keys (place of the text * number of terms + place of the term), ascending, and how often each term
        occurs in the text. Each word of the block of texts is looked up once."""
        folded = pa.array([(t or "").encode().translate(_FOLD) for t in texts], pa.large_binary())
        split = pc.split_pattern(folded, b" ")
        coded = split.values.dictionary_encode()
        words = coded.dictionary.cast(pa.large_string())
        n_tokens = np.diff(split.offsets.to_numpy())
        if not len(words) or not len(self):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)
        # A shorter word is no beginning: its prefix is none of them.
        begin = pc.fill_null(pc.index_in(pc.utf8_slice_codeunits(words, 0, PREFIX), self.begins), -1).to_numpy().astype(np.int64)
        begin[begin >= 0] += len(self.words)
        base = np.repeat(np.arange(len(texts)) * len(self), n_tokens)
        code = coded.indices.to_numpy()
        keys = np.concatenate([(base + of[code])[of[code] >= 0] for of in (at, begin)])
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.diff(first, append=len(keys))

    def count(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the places of its terms, ascending, and how often each occurs."""
        keys, times = self.counted(texts)
        cuts = np.searchsorted(keys, np.arange(len(texts) + 1) * len(self))
        return [(keys[a:b] - i * len(self), times[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def unit_vector(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term places and weights ((1 + log tf) idf, of length one) of term counts."""
    w = (1 + np.log(tf)) * idf[at]
    norm = np.sqrt((w * w).sum())
    return (at, w / norm) if norm > 0 else (at[:0], w[:0])


class BlockMaxIndex:
    """Examples by dense rows of common terms, and an inverted index by blocks of the others with each block's largest weight of every term."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK, dense: float = DENSE):
        # Examples with the same heaviest terms share blocks, so that bounds differ between blocks.
        order = sorted(range(len(ids)), key=lambda i: ([-1 * t for t in vectors[i][0][np.argsort(-vectors[i][1])[:2]]], ids[i]))
        order = [i for i in order if len(vectors[i][0])]
        empty = [i for i in range(len(ids)) if not len(vectors[i][0])]
        self.block, self.n_terms = block, n_terms
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.n_blocks = -(-len(order) // block) if order else 0
        self.visited = self.asked = 0  # blocks
        n = self.n_blocks * block
        places = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        terms = np.concatenate([vectors[i][0] for i in order]) if order else np.zeros(0, np.int64)
        weights = np.concatenate([vectors[i][1] for i in order]) if order else np.zeros(0)
        common = np.flatnonzero(np.bincount(terms, minlength=n_terms) > len(order) / dense)
        self.row = np.full(n_terms, -1, np.int64)  # of a common term
        self.row[common] = np.arange(len(common))
        here = self.row[terms] >= 0
        self.exact = np.zeros((n, len(common)))
        self.exact[places[here], self.row[terms[here]]] = weights[here]
        self.rows = np.ascontiguousarray(self.exact.T, np.float32)
        places, terms, weights = places[~here], terms[~here], weights[~here]
        # The postings of term t in block b lie from start[t, b] to start[t, b + 1].
        key = terms * self.n_blocks + places // block
        sort = np.argsort(key, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(key, minlength=n_terms * self.n_blocks)))).astype(np.int32)
        self.start = np.lib.stride_tricks.sliding_window_view(starts, self.n_blocks + 1)[:: max(self.n_blocks, 1)][:n_terms]
        self.place, self.weights = places[sort].astype(np.int32), weights[sort]
        largest = np.zeros(n_terms * self.n_blocks, np.float32)
        filled = np.flatnonzero(np.diff(starts))
        if len(filled):
            # Rounded up, so that a bound is never too small.
            largest[filled] = np.nextafter(np.maximum.reduceat(self.weights, starts[filled]).astype(np.float32), np.float32(np.inf))
        self.largest = largest.reshape(n_terms, self.n_blocks)
        self.rate = float(np.mean(labels)) if labels else 0.0
        self.without = (sum(labels[i] for i in empty) + PRIOR * self.rate) / (len(empty) + PRIOR) if labels else 0.0

    def dense_parts(self, vectors: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each vector the part of all cosines that comes from common terms."""
        asked = np.zeros((len(vectors), len(self.rows)), np.float32)
        for i, (at, w) in enumerate(vectors):
            row = self.row[at]
            asked[i, row[row >= 0]] = w[row >= 0]
        return asked @ self.rows

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples that share a term, best first; exact. ``part``: of :meth:`dense_parts`."""
        part = self.dense_parts([(at, weights)])[0] if part is None else part
        n = len(self.ids)
        row = self.row[at]
        rare = row < 0
        terms, w = at[rare], weights[rare]
        floor = np.partition(part[:n], n - k)[n - k] if n > k else 0.0
        bound = part.reshape(-1, self.block).max(axis=1) + w.astype(np.float32) @ self.largest[terms]
        possible = np.flatnonzero((bound >= floor - SLACK) & (bound > 0))
        possible = possible[np.argsort(-bound[possible], kind="stable")]
        start = self.start[terms]
        added, total = np.zeros(len(part)), part
        self.asked += self.n_blocks
        # The blocks of largest bound first: with them the floor rises, and fewer others reach it.
        visit, rest = possible[:LEAD], possible[LEAD:]
        while len(visit):
            self.visited += len(visit)
            # All postings of the rare terms in these blocks, one slice a term and block.
            first = start[:, visit]
            count = (start[:, visit + 1] - first).ravel()
            held = np.flatnonzero(count > 0)
            first, count = first.ravel()[held], count[held]
            ends = np.cumsum(count)
            where = np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
            added += np.bincount(self.place[where], np.repeat(w[held // len(visit)], count) * self.weights[where], minlength=len(part))
            total = part + added
            if n > k and len(rest):
                floor = max(floor, np.partition(total[:n], n - k)[n - k])
            visit, rest = rest[bound[rest] >= floor - SLACK], rest[:0]
        best = np.partition(total[:n], n - k)[n - k] if n > k else 0.0
        found = np.flatnonzero((total[:n] >= best - SLACK) & (total[:n] > 0))
        dense = row[~rare]
        cosine = np.round(added[found] + weights[~rare] @ self.exact[found[:, None], dense[None, :]].T, 12)
        best = np.lexsort((self.ids[found], -cosine))[:k]
        return found[best], cosine[best]

    def score(self, at: np.ndarray, weights: np.ndarray, k: int, part: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """Distance-weighted share of label 1 among the neighbours, their ids and cosines."""
        if not len(at) or not len(self.ids):
            return self.without, self.ids[:0], np.zeros(0)
        found, cosine = self.nearest(at, weights, k, part)
        vote = 1 / (0.05 + np.maximum(1 - cosine, 0))
        share = (vote @ self.labels[found] + PRIOR * self.rate) / (vote.sum() + PRIOR)
        return float(share), self.ids[found], cosine


def sampled_labels(labels: DataFrame, docs: DataFrame, sample: int, label: str, id_col: str) -> DataFrame:
    """doc_id, y: at most ``sample`` labelled ids that have a document, drawn by a hash of the id; of clashing labels the largest."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    return (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
        .groupBy("doc_id").agg(F.max("y").alias("y")).join(known, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def relevance(marked: np.ndarray, held: np.ndarray, n_marked: int, n: int) -> np.ndarray:
    """Squared z value of each term's log odds ratio; ``marked`` of the ``held`` examples with it have label 1."""
    if n_marked in (0, n):
        return np.ones(len(held))
    a, b = marked + 0.5, held - marked + 0.5
    c, d = n_marked - marked + 0.5, n - n_marked - held + marked + 0.5
    return np.log(a * d / (b * c)) ** 2 / (1 / a + 1 / b + 1 / c + 1 / d)


def _vocabulary(name: str, sent: Broadcast) -> Vocabulary:
    return kept(name, "vocabulary", lambda: Vocabulary(*pickle.loads(zlib.decompress(sent.value))))


def _index(name: str, sent: Broadcast, n_terms: int) -> tuple[BlockMaxIndex, np.ndarray]:
    def make() -> tuple[BlockMaxIndex, np.ndarray]:
        ids, y, cuts, terms, tf, idf = pickle.loads(zlib.decompress(sent.value))
        vectors = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            sort = np.argsort(terms[a:b])
            vectors.append(unit_vector(terms[a:b][sort].astype(np.int64), tf[a:b][sort], idf))
        return BlockMaxIndex(ids, y.tolist(), vectors, n_terms), idf

    return kept(name, "index", make)


def frequencies(texts: DataFrame, name: str, sent: Broadcast, n_terms: int) -> tuple[int, np.ndarray]:
    """Rows of ``texts`` (text), and how many of them hold each term."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(name, sent)
        held, n = np.zeros(n_terms, np.int64), 0
        for _, some in blocks(batches, limit=COUNTED_BYTES):
            n += len(some)
            keys, _ = vocabulary.counted(some)
            held += np.bincount(keys % max(n_terms, 1), minlength=n_terms)
        found = np.flatnonzero(held)
        terms, counts = np.concatenate((found, [-1])), np.concatenate((held[found], [n]))
        for at in range(0, len(terms), 1 << 16):
            yield pa.record_batch([pa.array(terms[at : at + (1 << 16)], pa.int32()), pa.array(counts[at : at + (1 << 16)], pa.int64())], schema=schema)

    got = map_arrow(texts, run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row a term of the examples
    out = np.zeros(n_terms + 1, np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()  # the number of rows has place -1
    return int(out[-1]), out[:-1]


def _texts_inside(batches: Iterable[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, row) with the struct's text as the column ``text`` (no copy)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).field(text_col), batch.column(1)], ["doc_id", "text", "row"])


def _packed(things: tuple) -> bytes:
    return zlib.compress(pickle.dumps(things), 1)


def nearest_labelled(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, k: int = NEIGHBOURS,
    id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, score, neighbours (array of doc_id, cosine) for every row of ``docs``; ``labels`` (doc_id, label) teach.

    With ``carry`` (which then names the text too) each row also brings the columns so named, as the struct ``row``."""
    if carry and text_col not in carry:
        raise ValueError(f"carry needs {text_col}")
    spark = docs.sparkSession
    chosen = F.broadcast(sampled_labels(labels, docs, sample, label, id_col))  # at most ``sample`` rows of two numbers
    wordy = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), *((c, t) for w in ("words", "begins") for c, t in ((w, pa.list_(pa.string())), (f"{w}_tf", pa.list_(pa.int32()))))])

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches):
            found = [term_counts(t) for t in texts]
            columns = [pa.array(x, wordy.field(2 + i).type) for i, x in enumerate(
                make for j in range(2) for make in ([list(f[j]) for f in found], [list(f[j].values()) for f in found]))]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], schema=wordy)

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    examples = named.join(chosen, "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    ddl = "doc_id long, y int, words array<string>, words_tf array<int>, begins array<string>, begins_tf array<int>"
    taught = map_arrow(examples, split, ddl).toArrow().sort_by("doc_id").combine_chunks()  # at most ``sample`` rows
    ids, y = taught["doc_id"].to_pylist(), taught["y"].to_numpy().astype(np.int64)
    parts, known = [], []
    for w in ("words", "begins"):
        lists = [taught[c].chunk(0) if taught[c].num_chunks else pa.array([], wordy.field(c).type) for c in (w, f"{w}_tf")]
        coded = lists[0].flatten().dictionary_encode()
        sizes = np.diff(lists[0].offsets.to_numpy())
        parts.append((np.repeat(np.arange(len(ids)), sizes), coded.indices.to_numpy() + sum(map(len, known)), lists[1].flatten().to_numpy()))
        known.append(coded.dictionary.to_pylist())
    of, terms, tf = (np.concatenate(p) for p in zip(*parts, strict=True))
    sort = np.argsort(of, kind="stable")
    of, terms, tf = of[sort], terms[sort], tf[sort]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(ids)))))
    n_terms, name = sum(map(len, known)), uuid.uuid4().hex
    vocabulary = spark.sparkContext.broadcast(_packed(tuple(known)))
    del taught, parts, known
    n, df = frequencies(docs.select(F.col(text_col).alias("text")), name, vocabulary, n_terms)
    held = np.bincount(terms, minlength=n_terms)
    marked = np.bincount(terms[y[of] == 1], minlength=n_terms)
    idf = (np.log((1 + n) / (1 + df)) + 1) * relevance(marked, held, int(y.sum()), len(y))
    # Sent as counts, which are small; each task makes the index of them.
    sent = spark.sparkContext.broadcast(_packed((ids, y, cuts, terms, tf, idf)))
    neighbour = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scored(batches)
        finally:
            let_go()

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _vocabulary(name, vocabulary).count
        index, idf = _index(name, sent, n_terms)
        known: dict[bytes, tuple] = {}  # of this task, for equal texts
        for batch, texts in blocks(_texts_inside(batches, text_col) if carry else batches, limit=COUNTED_BYTES):
            keys = [hashlib.sha256((t or "").encode()).digest() for t in texts]
            if len(known) >= 4000:
                known.clear()
            fresh = {key: t for key, t in zip(keys, texts, strict=True) if key not in known}
            todo = list(fresh.items())
            counts = count([t for _, t in todo])
            for i in range(0, len(todo), TOGETHER):
                some = todo[i : i + TOGETHER]
                vectors = [unit_vector(*c, idf) for c in counts[i : i + TOGETHER]]
                for (key, _), vector, part in zip(some, vectors, index.dense_parts(vectors), strict=True):
                    known[key] = index.score(*vector, k, part)
            out = [known[key] for key in keys]
            ends = np.concatenate(([0], np.cumsum([len(o[1]) for o in out]))).astype(np.int32)
            ids, cosine = (np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in (1, 2))
            pairs = pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(cosine, pa.float64())], fields=list(neighbour))
            columns = {"doc_id": batch.column(0), "score": pa.array([o[0] for o in out], pa.float64()), "neighbours": pa.ListArray.from_arrays(ends, pairs)}
            yield pa.RecordBatch.from_pydict(columns | ({"row": batch.column(2)} if carry else {}))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.struct(*carry).alias("row")) if carry else named
    ddl = "doc_id long, score double, neighbours array<struct<doc_id:long,cosine:double>>"
    return map_arrow(rows, score, ddl + (f", row {rows.schema['row'].dataType.simpleString()}" if carry else ""))


def judge_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, mod: int = 4, rest: int = 2, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours: learns from labels that are not held out, scores every row."""
    held = held_out(F.col("doc_id"), mod, rest)
    return nearest_labelled(docs, labels.where(~held), **options).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "neighbours", *(["row"] if options.get("carry") else []))
