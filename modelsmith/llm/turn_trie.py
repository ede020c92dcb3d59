"""Conversation prefix trie by truncation peeling (operator 12).

Conversations are sequences of turns; every distinct prefix is a node. The trie is
found from its tips upwards: rows that end at the greatest depth are merged with
the nodes that survive from below, every row loses its last turn, and the rows are
grouped again, so that a node's members, children, leaves and savings are summed
while it is found.

Most depths change nothing: a sequence that no other meets there only loses a
turn. One look at the turns tells at which depths any prefix goes on in two ways,
or ends and goes on; the peeling goes from one such depth to the next and writes
the nodes in between, which have one child each, from the row that it holds. The
rounds are as many as these depths, not as many as the longest conversation's turns.

Definitions: turns come by ``turn``, null first; ties by role, then text. A null
role or text is empty; repeated rows are turns each. Rows with a null conv_id
belong to no conversation. A turn is known by 128 bits of the SHA-256 of role and
text. Rebuilt conversations take their first turns from another one, see
:func:`rebuilt`. An empty table gives no rows.

At scale: texts are read once and never shuffled; a turn moves as 16 bytes and two
numbers. A conversation is one row of these. Copies of one conversation become one
row with their count before the first round. The ids that end at a node are joined
in pieces of ``PIECE`` ids' width, which are hashed in order as a stream, so the
largest group is never held. Each round is staged.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.scratch import shared_folder, stage
from modelsmith.llm.ship import map_arrow

PIECE = 4096
GROUP, HEADS = 100, 6
_WIDE = 24  # bytes of a path for each turn: the turn's id, then the code points of the path so far
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of id, size: code points), in order, of rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    at = F.struct(F.col("turn").isNotNull().alias("named"), F.col("turn"), known.alias("id"), F.char_length(text).cast("long").alias("size"))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), at.alias("at"), role.alias("role"), text.alias("text"))
    # Only where places are equal do role and text take part in the order.
    ties = stage(rows.groupBy(F.col("conv_id").alias("_conv"), F.col("at.turn").alias("_turn")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "ties")
    if not ties.isEmpty():
        tied = F.col("_n").isNotNull()
        rows = rows.join(ties, (F.col("conv_id") == F.col("_conv")) & F.col("at.turn").eqNullSafe(F.col("_turn")), "left").select("conv_id", F.struct(
            "at.named", "at.turn", F.when(tied, F.col("role")).alias("role"), F.when(tied, F.col("text")).alias("text"), "at.id", "at.size").alias("at"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("at")).alias("all")).select(
        "conv_id", F.transform("all", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def rebuilt(found: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Each conversation c with the first h turns of c - c % group in place of its own first h; h = crc32(c) % heads.

    The other conversation gives what it has, nothing if it is absent."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    first = found.select(c.alias("_base"), F.slice("turns", 1, heads - 1).alias("_head"))
    head = F.coalesce(F.slice("_head", F.lit(1), h), F.slice("turns", F.lit(1), F.lit(0)))
    rest = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).otherwise(F.slice("turns", F.lit(1), F.lit(0)))
    return found.join(first, c - c % group == F.col("_base"), "left").select("conv_id", F.concat(head, rest).alias("turns"))


def paths(found: DataFrame) -> DataFrame:
    """conv_id, depth, path: ``_WIDE`` bytes a turn, so that a path's beginnings are the paths of its beginnings."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for turns in batch.column(1).to_pylist():
                total, parts = 0, []
                for t in turns:
                    total += t["size"]
                    parts.append(t["id"] + total.to_bytes(8, "big"))
                out.append(b"".join(parts))
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column(0), "depth": pa.array([len(p) // _WIDE for p in out], pa.int64()), "path": pa.array(out, pa.binary())})

    return map_arrow(found.select("conv_id", "turns"), run, "conv_id long, depth long, path binary")


def tips(ended: DataFrame) -> DataFrame:
    """path, depth, n, first (smallest id), ends_sha256 for each distinct path of rows (conv_id, depth, path)."""
    schema = pa.schema([("path", pa.binary()), ("n", pa.int64()), ("first", pa.int64()), ("ends_sha256", pa.string())])
    ids = F.array_sort(F.collect_list("conv_id"))  # at most PIECE ids, as each stands for one conversation
    pieces = ended.groupBy("path", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(ids.alias("ids")).select(
        "path", "piece", F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("first"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # path, n, first and the hash so far of the path whose pieces are coming in
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held is None or held[0] != row["path"]:
                    if held:
                        done.append(held)
                    held = [row["path"], 0, row["first"], hashlib.sha256()]
                elif held[1]:
                    held[3].update(b",")
                held[1] += row["n"]
                held[3].update(row["text"].encode())
            if done:
                yield packed(done)
        if held:
            yield packed([held])

    def packed(done: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array([d[k] if k < 3 else d[3].hexdigest() for d in done], schema.field(k).type) for k in range(4)], schema=schema)

    dealt = pieces.repartition("path").sortWithinPartitions("path", "piece").select("path", "piece", "n", "first", "text")
    return map_arrow(dealt, digest, "path binary, n long, first long, ends_sha256 string").withColumn("depth", (F.octet_length("path") / _WIDE).cast("long"))


def event_depths(ends: DataFrame) -> list[int]:
    """Depths, the greatest first, at which a path goes on in two ways or ends and goes on; and 0."""
    schema = pa.schema([("depth", pa.int64()), ("head", pa.binary()), ("next", pa.binary())])

    def heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, known, after = [], [], []
            for path in batch.column(0).to_pylist():
                h = hashlib.sha256()
                for d in range(len(path) // _WIDE + 1):
                    turn = path[d * _WIDE : (d + 1) * _WIDE]
                    depth.append(d)
                    known.append(h.digest()[:16])
                    after.append(turn)
                    h.update(turn)
            yield pa.record_batch([pa.array(depth, pa.int64()), pa.array(known, pa.binary()), pa.array(after, pa.binary())], schema=schema)

    seen = map_arrow(ends.select("path"), heads, "depth long, head binary, next binary")
    found = seen.groupBy("depth", "head").agg(F.min("next").alias("a"), F.max("next").alias("b")).where("a != b").select("depth").distinct()
    return sorted({0, *(r.depth for r in found.toLocalIterator())}, reverse=True)


def _before(depth: str) -> Column:
    """Code points of the first ``depth`` (an SQL expression) turns of ``path``."""
    return F.expr(f"if({depth} > 0, cast(conv(hex(substring(path, cast(({depth}) * {_WIDE} - 7 as int), 8)), 16, 10) as bigint), 0L)")


_NODE = ("path", "depth", "n", "first", "children", "leaves", "saved", "ends_sha256")


def peel(ends: DataFrame) -> DataFrame:
    """The nodes above (and at) the tips ``ends``, as :func:`turn_trie` returns them."""
    spark = ends.sparkSession
    zero = F.lit(0).cast("long")
    folder = f"{shared_folder(spark)}/modelsmith-nodes-{uuid.uuid4().hex}"
    own = (F.col("n") - 1) * (_before("depth") - _before("depth - 1"))
    bottoms = ends.select("path", "depth", "n", "first", zero.alias("children"), (zero + 1).alias("leaves"), own.alias("saved"), "ends_sha256")
    level, state, schema = None, None, None
    for at in event_depths(ends):
        # From below come the nodes of the last round, and the tips between it and this depth.
        coming = bottoms.where(F.col("depth") > at) if level is None else state.unionByName(bottoms.where((F.col("depth") > at) & (F.col("depth") < level)))
        head = F.expr(f"substring(path, 1, {at * _WIDE})").alias("head")
        # The nodes passed on the way up have the same members: each saves once more for its own text.
        passed = F.col("saved") + (F.col("n") - 1) * (_before("depth - 1") - _before(f"{at}L"))
        merged = coming.select(head, "n", "first", (zero + 1).alias("children"), "leaves", passed.alias("saved"), F.lit(None).cast("string").alias("ends_sha256")).unionByName(
            ends.where(F.col("depth") == at).select(F.col("path").alias("head"), "n", "first", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"), "ends_sha256"))
        merged = merged.groupBy(F.col("head").alias("path")).agg(
            F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
            F.max("ends_sha256").alias("ends_sha256")).withColumn("depth", F.lit(at).cast("long"))
        merged = merged.withColumn("saved", F.col("saved") + own).withColumn("leaves", F.greatest("leaves", zero + 1)).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
        state = stage(merged.select(*_NODE), "peeled")
        above = state.select(F.col("path").alias("_head"), F.col("first").alias("_first"))
        own_row, top = F.col("d") == F.col("depth"), F.col("d") == at + 1
        nodes = coming.join(above, head == F.col("_head")).select("*", F.explode(F.sequence(F.lit(at + 1).cast("long"), "depth")).alias("d")).select(
            F.col("first").alias("conv_id"), F.col("d").alias("depth"), F.when(top, F.col("_first")).otherwise(F.col("first")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(own_row, F.col("children")).otherwise(zero + 1).alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("saved") + F.when(own_row, zero).otherwise((F.col("n") - 1) * (_before("depth - 1") - _before("d - 1")))).alias("saved_tokens"),
            F.when(own_row, F.col("ends_sha256")).otherwise(NO_ENDS).alias("ends_sha256"))
        nodes.write.mode("append").parquet(folder)
        level, schema = at, nodes.schema
    root = state.select(F.col("first").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")
    return spark.read.schema(schema).parquet(folder).unionByName(root)


def turn_trie(turns: DataFrame, rebuild: bool = True) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id (the parent's smallest member; null at the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 for each node of the trie of ``turns`` (conv_id, turn, role, text).

    ``saved_tokens`` sums, over the node's subtree, each node's code points times its members but one.
    Without ``rebuild`` the conversations are taken as they are."""
    found = stage(sequences(turns), "sequences")
    ended = stage(paths(rebuilt(found) if rebuild else found), "paths")
    return peel(stage(tips(ended), "tips"))
