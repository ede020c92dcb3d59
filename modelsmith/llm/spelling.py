"""Spelling variant grouping by a relational trie frontier (operator 13).

The words and their mirror images form a trie, kept as distributed tables of nodes
(beginnings of words) and of the characters that follow. The frontier holds the
states (word, position, node, edits) of all searches. A word on its own path spends
its edit where the trie parts: by another edge, or by leaving its character out. From
then on a state goes on only with the word's own next characters: each round joins
the frontier with the nodes of the next level. A state that reaches the end of its
word at the end of a word of the trie is a neighbour.

What makes the frontier small: an edit in the second half of a word is looked for
from its beginning, one in the first half from its end, so edits branch only where
the trie is thin; and only at nodes that go on in two ways, or end and go on, as two
words part at such a node. Leaving out finds the shorter neighbour, and the longer one
by turning the pair; of two words of one length the smaller finds the larger; of a run
of one character the last met is left out. So each pair is found once.

Levels are ``LEVEL`` characters apart, from the depth ``DEEP`` on twice as far each
time, so even very long words take few rounds.

Definitions: runs of letters as the contract gives them, A-Z in lower case. A null
text has no words; a null doc_id is written as nothing before the colon. Repeated
rows count each. Other columns are not read. Empty tables give no rows.

At scale: texts are read once; each task sends counts. A node has one row of
characters, whose number is bounded by the letters in use; nodes beyond ``DEEP``
characters are named by their SHA-256. Each round is staged and takes one join, whose
hot nodes can be split. Forms are followed by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.scratch import stage
from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks

SHORTEST, FEWEST, SLIPS = 5, 3, 97
LEVEL, DEEP = 4, 32
#: Different words that a task counts before it sends them on.
HELD = 200_000

_RUN = re.compile("[A-Za-z\\u00C0-\\u00FF]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(doc_id: int | None, text: str | None, slips: int = SLIPS) -> Counter[str]:
    """The words of a text and how often each occurs, after the character that the contract deletes from some of them."""
    runs = Counter(_RUN.findall((text or "").translate(_LOWER)))
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    out: Counter[str] = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % slips == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def count_words(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of all words with ``shortest`` code points or more that occur ``fewest`` times or more."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch, texts in blocks(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                for word, n in words_of(doc_id, text).items():
                    if len(word) >= shortest:
                        seen[word] += n
            if len(seen) >= HELD:
                yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)
                seen.clear()
        if seen:
            yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def _name(node: Column) -> Column:
    return F.when(F.char_length(node) > DEEP, F.sha2(node.cast("binary"), 256)).otherwise(node)


def _begin(n: str) -> Column:
    """The first ``n`` (an SQL expression) characters of the word ``s``."""
    return F.expr(f"substring(s, 1, {n})")


def _next_level(depth: str) -> str:
    return f"if({depth} < {DEEP}, (({depth}) div {LEVEL} + 1) * {LEVEL}, {DEEP} << cast(floor(log2(({depth}) / {DEEP})) + 1 as int))"


def trie_nodes(both: DataFrame) -> DataFrame:
    """rev, name, ends: the nodes at the levels at which words go on, and (``ends``) the words themselves."""
    levels = F.expr(f"filter(flatten(array(transform(sequence(1, {DEEP} div {LEVEL}), i -> i * {LEVEL}), transform(sequence(1, 24), i -> {DEEP} << i))), d -> d < size)")
    inner = both.select("rev", "s", F.explode(levels).alias("d")).select("rev", _name(_begin("d")).alias("name")).distinct()
    return inner.withColumn("ends", F.lit(False)).unionByName(both.select("rev", _name(F.col("s")).alias("name"), F.lit(True).alias("ends")))


def _onwards(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round: the states (rev, s, size, pos, node, edits) whose word leads on to a node of the next level, or to the end of a word (``done``)."""
    depth = "char_length(node)"
    moved = states.withColumn("_step", F.expr(f"cast({_next_level(depth)} - {depth} as int)"))
    moved = moved.select(
        "rev", "s", "size", F.least(F.col("pos") + F.col("_step"), F.col("size")).alias("pos"), F.concat("node", F.expr("substring(s, pos + 1, _step)")).alias("node"), "edits",
        (F.col("pos") + F.col("_step") >= F.col("size")).alias("done"))
    there = nodes.select(F.col("rev").alias("_rev"), F.col("name").alias("_name"), F.col("ends").alias("_ends"))
    return moved.join(there, (F.col("rev") == F.col("_rev")) & (_name(F.col("node")) == F.col("_name")) & (F.col("done") == F.col("_ends"))).select(*moved.columns)


def near_words(words: DataFrame) -> DataFrame:
    """a, b: each unordered pair of different words (column ``word``, distinct) that one inserted, deleted or replaced character tells apart."""
    size = F.char_length("s").cast("int")
    both = words.select(F.col("word").alias("s"), F.lit(False).alias("rev")).unionByName(words.select(F.reverse("word").alias("s"), F.lit(True).alias("rev")))
    # from: the first position at which this direction looks for an edit.
    both = stage(both.where("s != ''").select("s", "rev", size.alias("size"), F.when(F.col("rev"), size - (size / 2).cast("int")).otherwise((size / 2).cast("int")).alias("from")), "trie")
    nodes = stage(trie_nodes(both), "nodes")
    first = both.agg(F.coalesce(F.min("from"), F.lit(0))).first()[0]
    edges = both.select("rev", "s", F.explode(F.sequence(F.lit(first), "size")).alias("d")).select("rev", _name(_begin("d")).alias("name"), F.expr("substring(s, d + 1, 1)").alias("c"))
    edges = stage(edges.distinct().groupBy("rev", "name").agg(F.collect_list("c").alias("next")).where(F.size("next") > 1), "edges")
    paths = both.where("from < size").select("rev", "s", "size", "from", F.explode(F.sequence("from", F.col("size") - 1)).alias("d")).select("*", _name(_begin("d")).alias("name"))
    # Left out, unless the next character is the same; the edge after it is known at this node ('' at the word's end).
    # A run that lies across the middle of its word is left to the search from the beginning.
    char, after = F.expr("substring(s, d + 1, 1)"), F.expr("substring(s, d + 2, 1)")
    across = F.col("rev") & (F.replace(F.expr("substring(s, from, d - from + 2)"), char, F.lit("")) == "")
    left_out = (char != after) & ~across & F.array_contains("next", after)
    taken = F.filter("next", lambda c: c > char)
    states = paths.join(edges, ["rev", "name"]).select("rev", "s", "size", "d", F.explode(F.when(left_out, F.concat(taken, F.array(F.lit("")))).otherwise(taken)).alias("c")).select(
        "rev", "s", "size", (F.col("d") + 1).alias("pos"), F.concat(_begin("d"), "c").alias("node"), F.lit(1).alias("edits"))
    found = []
    while True:
        frontier = stage(_onwards(states, nodes), "frontier")
        found.append(frontier.where("done"))
        states = frontier.where("not done").drop("done")
        if states.isEmpty():
            break
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    turned = lambda c: F.when(F.col("rev"), F.reverse(c)).otherwise(F.col(c))
    return pairs.select(turned("s").alias("a"), turned("node").alias("b"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """word, root: from each word of ``forms`` (word, form) along the forms to the last, by pointer doubling.

    A form is not in a circle with its word (here it occurs at least twice as often); a word that is no word of ``forms`` ends the way."""
    pointers = stage(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = pointers.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = stage(pointers.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if joined.where("_moved").isEmpty():
            return joined.select("word", "root")
        pointers = joined.select("word", "root")


def spelling_groups(words: DataFrame, lead: float = 2) -> DataFrame:
    """word, n, form, form_n, n_near, root for words (word, n): ``form`` is the near word that occurs most, if at least ``lead`` times as often."""
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_words(words), "pairs")
    near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = stage(near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best")), "best")
    leads = -F.col("best.m") >= lead * F.col("n")
    found = stage(words.join(best, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(leads, F.col("best.b")).alias("form"), F.when(leads, -F.col("best.m")).alias("form_n")), "forms")
    return found.join(follow_forms(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
