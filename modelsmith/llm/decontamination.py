"""Benchmark decontamination (operator 5).

Every window of ten consecutive words of a benchmark item (the whole item if it
is shorter) becomes one key of an Aho-Corasick automaton over normalised text:
words in lower case, parted by single spaces. Each document is normalised the
same way and scanned once; a hit's place among the words leads back to the
offsets in the original text.

The automaton's keys are sent to the tasks only in blocks below
``max_key_bytes``; a usual benchmark is one block. The documents pass through
one scan a block, each adding its hits to those before.

Definitions: words are as the contract gives them, so upper case beyond A-Z
stays. A null text has no words; an item without words has no window. Repeated
items with one id count once; the windows of an item whose id is null hit like any
other's, but it cannot be listed and ``item_ids`` (and their number) leave it out. Repeated
documents are each scanned. An empty benchmark hits nothing.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.kept import kept
from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks

WINDOW = 10
MAX_KEY_BYTES = 32 << 20

#: Of UTF-8 bytes: digits, letters in lower case and all beyond ASCII stay, the rest parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words, in UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The windows of an item: its words joined by spaces, with a space at either end."""
    w = words(text)
    return [b" %s " % b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def build_automaton(keys: dict[bytes, list[int]]) -> ahocorasick.Automaton:
    """Automaton over windows; a key's value is its length and the places of its items.

    Keys and texts are UTF-8 bytes written as one character each."""
    automaton = ahocorasick.Automaton()
    for key, items in keys.items():
        automaton.add_word(key.decode("latin-1"), (len(key), items))
    if keys:
        automaton.make_automaton()
    return automaton


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(automaton: ahocorasick.Automaton, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Runs [first, end) of hit words in a document's words, and the places of the items hit."""
    if not found or not len(automaton):
        return [], set()
    joined = b" %s " % b" ".join(found)
    runs: list[list[int]] = []  # of bytes in the joined words; hits come in the order of their ends
    items: set[int] = set()
    for end, (length, places) in automaton.iter(joined.decode("latin-1")):
        start = end - length + 1
        items.update(places)
        while runs and start <= runs[-1][1]:
            start = min(start, runs.pop()[0])
        runs.append([start, end])
    if not runs:
        return [], items
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    at = np.searchsorted(spaces, np.array(runs)).tolist()
    return merge((a, b) for a, b in at), items


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets [start, end) in the original text of runs of words."""
    if not spans:
        return []
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    return [(len(raw[: at[a][0]].decode()), len(raw[: at[b - 1][1]].decode())) for a, b in spans]


def key_blocks(items: DataFrame, window: int, max_key_bytes: int) -> Iterator[dict[bytes, list[str]]]:
    """Windows with the ids of their items, in blocks of bounded size; the driver builds one at a time."""
    keys: dict[bytes, list[str]] = {}
    held = 0
    for row in items.toLocalIterator():
        for key in windows(row.text, window):
            ids = keys.setdefault(key, [])
            held += len(row.item or "") + (0 if ids else len(key))
            if row.item is not None and row.item not in ids:
                ids.append(row.item)
        if held >= max_key_bytes:
            yield keys
            keys, held = {}, 0
    if keys:
        yield keys


def _built(name: str, sent: Broadcast) -> tuple[ahocorasick.Automaton, list[str]]:
    def make() -> tuple[ahocorasick.Automaton, list[str]]:
        keys = pickle.loads(sent.value)
        names = sorted({i for ids in keys.values() for i in ids})
        place = {n: k for k, n in enumerate(names)}
        return build_automaton({k: [place[i] for i in ids] for k, ids in keys.items()}), names

    return kept(name, "automaton", make)


_SPAN = pa.struct([("first", pa.int32()), ("end", pa.int32())])
_FIELDS = {
    "doc_id": (pa.int64(), "long"), "text": (pa.string(), "string"), "n_words": (pa.int64(), "long"),
    "word_spans": (pa.list_(_SPAN), "array<struct<first:int,end:int>>"), "char_spans": (pa.list_(_SPAN), "array<struct<first:int,end:int>>"),
    "item_ids": (pa.list_(pa.string()), "array<string>"),
}


def _scanner(sent: Broadcast, name: str, last: bool) -> Callable:
    """Adds the hits of one block of keys to the word_spans and item_ids of earlier blocks; the last pass
    places them in the text, which it leaves out."""
    schema = pa.schema([(c, t) for c, (t, _) in _FIELDS.items() if c != "text" or not last])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, names = _built(name, sent)
        for batch, texts in blocks(batches):
            before = batch.select(["word_spans", "item_ids"]).to_pylist()
            n, spans, items, places = [], [], [], []
            for text, old in zip(texts, before, strict=True):
                found = words(text)
                hit, ids = scan(automaton, found)
                if old["word_spans"]:
                    hit = merge([*hit, *((s["first"], s["end"]) for s in old["word_spans"])])
                n.append(len(found))
                spans.append(hit)
                items.append(sorted({names[i] for i in ids}.union(old["item_ids"] or ())))
                places.append(original_offsets(text, hit) if last else [])
            pairs = [pa.array([[{"first": a, "end": b} for a, b in row] for row in rows], pa.list_(_SPAN)) for rows in (spans, places)]
            columns = {"doc_id": batch.column(0), "text": batch.column(1), "n_words": pa.array(n, pa.int64()), "word_spans": pairs[0],
                       "char_spans": pairs[1], "item_ids": pa.array(items, pa.list_(pa.string()))}
            kept = {c: columns[c].cast(schema.field(c).type) for c in schema.names}
            yield pa.RecordBatch.from_pydict(kept | ({"row": batch["row"]} if "row" in batch.schema.names else {}))

    return run


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_key_bytes: int = MAX_KEY_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, n_words, word_spans (runs of hit words), char_spans (where they lie in the text), item_ids (sorted as strings).

    With ``carry`` each row also brings the columns so named, as the struct ``row``."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    frame = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[
        F.lit(None).cast(kind).alias(c) for c, (_, kind) in _FIELDS.items() if c not in ("doc_id", "text")], *([F.struct(*carry).alias("row")] if carry else []))
    row = f", row {frame.schema['row'].dataType.simpleString()}" if carry else ""
    sent = [docs.sparkSession.sparkContext.broadcast(pickle.dumps(b)) for b in key_blocks(items, window, max_key_bytes)]
    sent = sent or [docs.sparkSession.sparkContext.broadcast(pickle.dumps({}))]
    for k, block in enumerate(sent):
        last = k == len(sent) - 1
        ddl = ", ".join(f"{c} {kind}" for c, (_, kind) in _FIELDS.items() if c != "text" or not last)
        frame = map_arrow(frame, _scanner(block, uuid.uuid4().hex, last), ddl + row)
    return frame


def judge_contamination(found: DataFrame) -> DataFrame:
    """Digest of :func:`find_passages`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
