"""Token counts (operator 6).

Texts arrive in Arrow batches, are regrouped into blocks of about equal bytes,
cut at safe boundaries into short units, and only lengths leave the function.

A boundary is safe before a space that follows a character other than white
space: the tokenizer's pre-tokens never reach across it (a space opens the next
pre-token, and a run of white space is kept whole), so the counts of the units
add up to the count of the text. Units recur, so each task encodes a unit once,
in a batch, and keeps its count in a table of bounded size. Units are short
however long the text, unless it has no safe boundary at all.

Definitions: a null text counts as empty and has no tokens. Special strings in a
text are handled as the tokenizer's default does. Repeated rows count each.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.kept import kept
from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks

#: Units kept by a worker process, and the longest one that is kept.
KEPT_UNITS = 400_000
KEPT_LENGTH = 64

_UNSAFE = re.compile(r"\s ")
_SAFE = re.compile(r"(?<=\S)(?= )")


class UnitCounter:
    """Counts tokens of texts through a bounded table of the units seen so far."""

    def __init__(self, path: str, kept: int = KEPT_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept = kept
        self.counts: dict[str, int] = {}

    def encode(self, units: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        cut = [units(t) for t in texts]
        new = set().union(*cut).difference(self.counts) if cut else set()
        if len(self.counts) + len(new) > self.kept:
            self.counts = {}
            new = set().union(*cut)
        new = list(new)
        found = dict(zip(new, self.encode(new), strict=True))
        long = [u for u in new if len(u) > KEPT_LENGTH]
        self.counts.update(found)
        out = [sum(map(self.counts.__getitem__, c)) for c in cut]
        for u in long:
            del self.counts[u]
        return out


def units(text: str) -> list[str]:
    """The text cut before every space that follows a character other than white space."""
    if not text:
        return []
    if _UNSAFE.search(text):
        return _SAFE.split(text)
    head, *rest = text.split(" ")
    rest = [f" {u}" for u in rest]
    return [head, *rest] if head else rest


def counter(path: str) -> UnitCounter:
    return kept(path, "counter", lambda: UnitCounter(path))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row. ``tokenizer_path`` must exist on every executor."""

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path).count
        for batch, texts in blocks(batches):
            texts = [t or "" for t in texts]
            yield pa.record_batch([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(count(texts), pa.int64())], schema=_OUT)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, lengths, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
