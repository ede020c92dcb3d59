"""Exact top-k search by term-at-a-time accumulation (operator 10).

A vector is a sparse row of integer weights by dimension (its terms). Queries
and candidates are dealt into blocks; each pair of blocks is one cell, worked by
one call: a candidate block keeps one posting list for each term, each query's
weights scatter the weighted postings into a dense score array, partition
selection picks the best k of the cell, and a window merges the cells' lists.
Every candidate is scored: the result is exact.

Definitions: vectors that are null or hold null or non-finite components, and rows
whose id is null (they could not be named in an answer), take no part; missing trailing dimensions count as zero; a query never answers with rows
of its own id; equal scores go to the smaller id. Repeated query rows (same id
and vector) answer once; repeated candidate rows each count. A component of 2^24 or
more in size after quantising is refused (the query fails and says so), so sums of up
to 2^14 dimensions fit 64 bits. An empty table gives no rows.

At scale: with Q queries and N candidates, blocks of q and c rows move
N * Q/q + Q * N/c rows; a cell holds at most about q * c scores. Blocks are dealt
round robin, so no key can gather rows in one cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelsmith.llm.ship import ship

LARGEST = 1 << 24
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
#: Candidate blocks are made smaller rather than fewer than this, to keep all cores busy on small inputs.
LEAST_BLOCKS = 48


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, q: floor(scale * x) of each component; without unusable vectors and without null ids."""
    v = F.col(vector_col)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.floor(x.cast("double") * scale)
    sound = lambda x: F.when(F.abs(x.cast("double") * scale) < LARGEST, whole(x)).otherwise(F.raise_error(F.lit(f"a component is {LARGEST} or more in size after quantising")))
    return vectors.where(v.isNotNull() & F.col(id_col).cast("long").isNotNull()).where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: sound(x).cast("long")).alias("q"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in column.chunks), default=0)


def score_cell(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all queries by all candidates, accumulated term by term over the candidates' postings."""
    scores = np.zeros((len(queries), len(candidates)), dtype=np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        postings = np.flatnonzero(candidates[:, term])
        asked = np.flatnonzero(queries[:, term])
        if not len(postings) or not len(asked):
            continue
        add = np.multiply.outer(queries[asked, term], candidates[postings, term])
        if len(postings) == len(candidates) and len(asked) == len(queries):
            scores += add
        else:
            scores[np.ix_(asked, postings)] += add
    return scores


def select_best(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query row, candidate row) of the best k of each query; candidates are in id order, ``own`` marks those left out."""
    n = scores.shape[1]
    scores = np.where(own, np.iinfo(np.int64).min, scores)
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k, None]
        above, tied = scores > least, scores == least
        # Of the scores that tie for the last places those of smaller ids are taken.
        chosen = above | (tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    else:
        chosen = np.ones(scores.shape, bool)
    return np.nonzero(chosen & ~own)


_OUT = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def search_cell(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The best k of one block of candidates for each query of one block."""
    if not queries.num_rows or not candidates.num_rows:
        return _OUT.empty_table()
    candidates = candidates.sort_by("vec_id")
    width = max(_width(queries["q"]), _width(candidates["q"]), 1)
    ids = candidates["vec_id"].to_numpy()
    asked, names = queries["vec_id"].to_numpy(), queries["query"].to_numpy()
    posted = _matrix(candidates["q"], width)
    matrix = _matrix(queries["q"], width)
    found = []
    for at in range(0, len(asked), 256):  # bounds the dense score array
        part = slice(at, at + 256)
        rows, cols = select_best(scores := score_cell(matrix[part], posted), asked[part, None] == ids[None, :], k)
        found.append(pa.table([names[part][rows], asked[part][rows], ids[cols], scores[rows, cols]], schema=_OUT))
    return pa.concat_tables(found)


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 5,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, least_blocks: int = LEAST_BLOCKS,
) -> DataFrame:
    """query_id, rank, vec_id, score for frames (vec_id, q) as :func:`quantise` makes them."""
    queries = queries.select(F.xxhash64("vec_id", "q").alias("query"), "vec_id", "q").dropDuplicates(["query"])
    n = candidates.agg(F.count(F.lit(1))).first()[0]
    m = queries.agg(F.count(F.lit(1))).first()[0]
    across = max(1, -(-m // query_block))
    down = max(1, -(-n // candidate_block), min(least_blocks, -(-n // 64)))
    dealt = candidates.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(down)).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("r"), "vec_id", "q")
    asked = queries.select(
        F.pmod("query", F.lit(across)).cast("int").alias("r"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))).alias("c"), "query", "vec_id", "q")

    ship(candidates.sparkSession)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_cell(left, right, k)

    lists = asked.groupBy("c", "r").cogroup(dealt.groupBy("c", "r")).applyInArrow(cell, "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return lists.select("query", "query_id", "vec_id", "score", rank.alias("rank")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
