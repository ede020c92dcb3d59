"""Exact dedup by content-defined chunk recipes (operator 11).

A text, with A-Z in lower case, is cut where a rolling hash of its last 32 bytes
says so, so equal texts are cut alike and a passage that two texts share mostly
gives the same chunks. A chunk's identifier is a 128-bit hash. The identifiers
are verified: every distinct chunk moves once, to the rows of its identifier,
where the bytes are compared; should two chunks ever share an identifier, all is
cut again under the next seed. A text's recipe is the ordered list of its
identifiers. Texts are equal exactly if their recipes are, so from there on only
recipes move, 16 bytes for about 2.5 KB of text.

Definitions: a null text counts as empty and has an empty recipe. Of equal texts
the row with the largest doc_id stays (a null id is the smallest; of rows that
repeat an id, one). Repeated rows each count. Other columns, whatever their
names, are not read. An empty table gives no rows.

At scale: the text is read twice, for the chunks and for the recipes, and never
shuffled whole. A chunk that occurs very often leaves a task once for each time
that the task's cache of ``CACHE_BYTES`` has been renewed. Groups are counted with
map-side partial sums; only groups of two or more are joined back, and that join
can be split where a group is hot. Very long texts are hashed in steps of bounded
size; their chunks are rows of at most ``LARGEST`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.scratch import stage
from modelsmith.llm.ship import map_arrow

#: A chunk has ``SMALLEST`` bytes at least (but the last) and ``LARGEST`` at most; a cut follows on average 2^CUT_BITS bytes later.
SMALLEST, LARGEST, CUT_BITS = 512, 16384, 11
CACHE_BYTES = 32 << 20
SEEDS = 8
_WINDOW = 32  # bytes that the rolling hash sees
_STEP = 1 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([c])) for c in range(256)], np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """For each byte the sum of its window's byte values, shifted by their distance; by doubling the window five times."""
    h = _GEAR[data]
    width = 1
    while width < _WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
        width *= 2
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; they depend on its bytes alone."""
    n = len(data)
    if n <= SMALLEST:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    found = []
    for at in range(0, n, _STEP):
        seen = max(0, at - _WINDOW + 1)
        h = rolling_hash(raw[seen : at + _STEP])[at - seen :]
        found.append(np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + at + 1)
    ends, last = [], 0
    for end in np.concatenate(found).tolist():
        while end - last > LARGEST:
            last += LARGEST
            ends.append(last)
        if end - last >= SMALLEST:
            ends.append(end)
            last = end
    while n - last > LARGEST:
        last += LARGEST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunks_of(data: bytes) -> list[bytes]:
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def identifier(chunk: bytes, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def _normalised(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()):
        yield (value.as_py() or b"").translate(_FOLD)


def chunk_store(docs: DataFrame, seed: int = 0, text_col: str = "text", name: Callable[[bytes, int], bytes] = identifier) -> DataFrame:
    """id, chunk, verified for every distinct chunk: ``verified`` is false where an identifier stands for two chunks."""
    schema = pa.schema([("id", pa.binary()), ("chunk", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}  # what this task has sent, up to CACHE_BYTES
        held = 0
        ids: list[bytes] = []
        out: list[bytes] = []
        size = 0
        for batch in batches:
            for data in _normalised(batch):
                for chunk in chunks_of(data):
                    i = name(chunk, seed)
                    if known.get(i) == chunk:
                        continue
                    if held >= CACHE_BYTES:
                        known.clear()
                        held = 0
                    known[i] = chunk
                    held += len(chunk) + 100
                    ids.append(i)
                    out.append(chunk)
                    size += len(chunk)
                    if size >= _STEP:
                        yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(out, pa.binary())], schema=schema)
                        ids, out, size = [], [], 0
        if ids:
            yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(out, pa.binary())], schema=schema)

    sent = map_arrow(docs.select(F.col(text_col).cast("string").alias("text")), run, "id binary, chunk binary")
    # Dealt before the aggregation: chunks are sorted once, on the side that receives them.
    return sent.repartition("id").groupBy("id").agg(F.min("chunk").alias("chunk"), F.max("chunk").alias("_other")).select(
        "id", "chunk", (F.col("chunk") == F.col("_other")).alias("verified"))


def recipes(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", name: Callable[[bytes, int], bytes] = identifier) -> DataFrame:
    """doc_id, recipe (the identifiers of the text's chunks in order, 16 bytes each), text_sha256 (of the normalised text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, digests = [], []
            for data in _normalised(batch):
                made.append(b"".join([name(c, seed) for c in chunks_of(data)]))
                digests.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "recipe": pa.array(made, pa.binary()), "text_sha256": pa.array(digests, pa.string())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, recipe binary, text_sha256 string")


def verified_seed(docs: DataFrame, text_col: str = "text", name: Callable[[bytes, int], bytes] = identifier) -> int:
    """The first seed under which every identifier stands for one chunk."""
    for seed in range(SEEDS):
        if chunk_store(docs, seed, text_col, name).where("not verified").isEmpty():
            return seed
    raise RuntimeError(f"chunks share identifiers under {SEEDS} seeds")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: Callable[[bytes, int], bytes] = identifier) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``; ``name`` gives a chunk's identifier under a seed."""
    seed = verified_seed(docs, text_col, name)
    rows = stage(recipes(docs, seed, id_col, text_col, name).withColumn("row", F.monotonically_increasing_id()), "recipes")
    # Staged, so that both sides of the join are shuffled for it alone and a hot group's rows can be split.
    groups = stage(rows.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "groups")
    return rows.join(groups, "recipe", "left").select(
        "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")
