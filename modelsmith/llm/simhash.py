"""SimHash near-duplicates with pivot distance tables (operator 7).

Each distinct fingerprint gets its Hamming distances to sixteen reference
fingerprints (pivots). By the triangle inequality two fingerprints within
``max_bits`` differ by at most that in every coordinate; pairs that differ more
are discarded, the survivors are verified on the bits.

The table alone would need every pair once, so pairs are met by blocking that
loses none: the 64 bits are cut into ``max_bits + 2`` blocks; two fingerprints
with at most ``max_bits`` differing bits agree in at least two blocks, so they
meet under the key of some two blocks. A pair counts only under the first pair of
blocks it agrees in. In a dense group most of that is needless, as only
components are asked for: under each key all fingerprints close to the smallest
of the key form a star; those whose star is the commonest of the key are not
compared with each other again, only the others are, with all.

Definitions: a text without words, empty or null, has fingerprint zero, which is
linked like any other. Equal fingerprints are one vertex, so groups of copies are
never expanded. Null ids take part in groups; the component's id is the smallest
that is not null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.components import connected_components
from modelsmith.llm.kept import let_go
from modelsmith.llm.scratch import stage
from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Reference fingerprints: hashes of the first integers, so every run has the same.
PIVOTS = tuple(xxhash.xxh64_intdigest(str(i), SEED) for i in range(16))

#: Of UTF-8 bytes: ASCII letters in lower case, ASCII white space as spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_STEP = 1 << 15  # shingles whose bits are unpacked at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over the hashes of word shingles; a bit is set if more than half of the hashes have it."""
    words = (text or "").encode().translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    ends = (ends[-n:] - 1).tolist()
    starts = starts[:n].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, _STEP):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _STEP], ends[at : at + _STEP], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and the columns named in ``carry``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(fp)} | {c: batch[c] for c in carry})

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry), run, "doc_id long, fp long" + "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _pivot_table(fp: Column) -> list[Column]:
    """Distances to the pivots, eight to a long, a byte each."""
    out = []
    for k in range(0, len(PIVOTS), 8):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(PIVOTS[k : k + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long"), 8 * i))
        out.append(packed.alias(f"pivots{k // 8}"))
    return out


def _pivots_allow(a: str, b: str, max_bits: int) -> Column:
    """Whether no coordinate of the two tables differs by more than ``max_bits``."""
    far = []
    for k in range(0, len(PIVOTS), 8):
        for i in range(8):
            x, y = (F.shiftright(F.col(f"{t}.pivots{k // 8}"), 8 * i).bitwiseAND(F.lit(127).cast("long")) for t in (a, b))
            far.append(F.abs(x - y))
    return F.greatest(*far) <= max_bits


def _block_masks(max_bits: int) -> list[int]:
    """Masks of ``max_bits + 2`` blocks of nearly equal width."""
    n = max_bits + 2
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]


def near_pairs(vertices: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints ``fp`` into the components of all pairs within ``max_bits``."""
    masks = [x | y for x, y in combinations(_block_masks(max_bits), 2)]
    fp = F.col("fp")
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), fp.bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in enumerate(masks)]))
    keyed = vertices.select("fp", keys.alias("key")).select("fp", F.col("key.k").alias("k"), F.col("key.part").alias("part"))
    # Stars: the smallest fingerprint of each key with all others near it.
    centres = stage(keyed.groupBy("k", "part").agg(F.min("fp").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "centres")
    met = stage(keyed.join(centres, ["k", "part"]), "met")
    stars = met.where((fp != F.col("centre")) & (F.bit_count(fp.bitwiseXOR(F.col("centre"))) <= max_bits))
    star = stars.groupBy("fp").agg(F.min("centre").alias("star"))
    named = stage(met.join(star, "fp", "left").select("k", "part", "fp", F.least(F.coalesce("star", "fp"), fp).alias("star"), *_pivot_table(fp)), "named")
    commonest = named.groupBy("k", "part", "star").agg(F.count(F.lit(1)).alias("n")).groupBy("k", "part").agg(
        F.max_by("star", F.struct("n", "star")).alias("common"))
    left = stage(named.join(commonest, ["k", "part"]).where("star != common"), "left")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(k)) for k, m in enumerate(masks)])
    # Of two fingerprints that are both compared, the smaller asks.
    found = left.alias("x").join(
        named.alias("y"),
        (F.col("x.k") == F.col("y.k")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.star") != F.col("y.star"))
        & ((F.col("y.star") == F.col("x.common")) | (F.col("x.fp") < F.col("y.fp")))
        & _pivots_allow("x", "y", max_bits) & (F.bit_count(differ) <= max_bits),
    ).where(first == F.col("x.k")).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    return stars.select(fp.alias("a"), F.col("centre").alias("b")).unionByName(found)


def fingerprint_groups(printed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, part (names its component), component_id (smallest doc_id of the component) for rows (doc_id, fp)."""
    vertices = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "vertices")
    parts = connected_components(near_pairs(vertices, max_bits))
    named = vertices.join(parts, vertices.fp == parts.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    smallest = named.groupBy("part").agg(F.min("first").alias("component_id"))
    return named.join(smallest, "part").select("fp", "part", "component_id")


def first_rows(printed: DataFrame, row_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``row_col`` of one row of each component: of the smallest doc_id (null last), of these the smallest ``row_col``."""
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(row_col))
    of_print = printed.groupBy("fp").agg(F.min(order).alias("first"))
    return of_print.join(fingerprint_groups(printed, max_bits), "fp").groupBy("part").agg(F.min("first").alias("first")).select(f"first.{row_col}")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach)."""
    printed = stage(fingerprints(docs, shingle, id_col, text_col), "prints")
    groups = fingerprint_groups(printed, max_bits)
    return printed.join(groups, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
