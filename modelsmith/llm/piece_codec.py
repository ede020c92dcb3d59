"""SentencePiece encoding and decoding by a merge-type prefix table (operator 3).

A byte-pair model merges, again and again, the adjacent pair whose joint piece
scores best. For such a model every prefix of a string has one encoding whose
last token is unique, and a token can end the prefix exactly if it is compatible
with the last token of what comes before it: two tokens are compatible if
encoding their joined text gives these two again. So one pass over the string
fills a table with each prefix's last token, trying the pieces that an
Aho-Corasick automaton finds to end there; the ids are then read backwards.

A string may be cut between any two characters that no piece holds side by side;
what lies between cuts encodes apart. So texts are cut before runs of space marks
into units. A block of texts is encoded at once: the table is filled for all its
distinct units together, a character's place after the other, in numpy arrays
(:class:`UnitTable`; the automaton is then the trie of the pieces, walked from each place).
Units too long for that are cut into parts wherever the pieces allow it; a
worker keeps those it has met in tables of bounded size. Characters without a piece become byte tokens and merge with
nothing.

Definitions: a null text counts as empty; an empty text has the end id only.
Repeated rows are encoded each. Only models with the identity normaliser, a
leading dummy space, byte fallback and space marks at the front of pieces are
taken; others raise.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.kept import give_back, kept
from modelsmith.llm.ship import map_arrow
from modelsmith.llm.tables import blocks

SPACE = "▁"
#: The longest unit whose table is filled together with others.
TABLE_LENGTH = 48
#: Slots for pairs of tokens, as a power of two.
PAIR_BITS = 21
#: Longer units, their parts and pairs of tokens kept by a worker process, and the longest unit or part that is kept.
KEPT_UNITS = 50_000
KEPT_PARTS = 200_000
KEPT_PAIRS = 200_000
KEPT_LENGTH = 96

#: A run of space marks with what follows it.
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceModel:
    """The pieces of a model file: ids, scores and bytes."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        self.end = sentencepiece.SentencePieceProcessor(model_file=path).eos_id()
        normal, byte = spec.SentencePiece.NORMAL, spec.SentencePiece.BYTE
        self.piece = [p.piece for p in spec.pieces]
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == normal}
        self.score = {p.piece: p.score for p in spec.pieces if p.type == normal}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == byte}
        self.bytes = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == byte else p.piece.replace(SPACE, " ").encode() if p.type == normal else b""
            for p in spec.pieces]
        self.kinds = {p.type for p in spec.pieces}
        rules = spec.normalizer_spec
        known = {c for p in self.ids for c in p}
        if (
            spec.trainer_spec.model_type != spec.trainer_spec.BPE or rules.precompiled_charsmap or not rules.add_dummy_prefix
            or rules.remove_extra_whitespaces or not rules.escape_whitespaces or len(self.byte_ids) != 256
            or any(SPACE in p.lstrip(SPACE) for p in self.ids) or not known <= self.ids.keys()
            or spec.SentencePiece.USER_DEFINED in self.kinds or spec.SentencePiece.UNUSED in self.kinds
        ):
            raise ValueError(f"{path}: not a byte-pair model of the kind this operator takes")


class Kept(dict):
    """A table of bounded size: when it is half full it becomes the old half, and what is asked for again is taken over."""

    def __init__(self, size: int):
        super().__init__()
        self.half, self.old = max(1, size // 2), {}

    def find(self, key):
        found = self.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value


class PrefixTableCodec:
    """Encodes units through the table of last tokens; decodes ids."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.pairs: Kept = Kept(KEPT_PAIRS)  # first id * pieces + second id -> whether compatible
        self.units: Kept = Kept(KEPT_UNITS)  # long unit -> decimal ids, decoded text
        self.parts: Kept = Kept(KEPT_PARTS)  # part -> ids
        self.adjacent = {p[i : i + 2] for p in self.model.ids for i in range(len(p) - 1)}
        self.history: dict[str, tuple[list[float], list[str], list[str]]] = {}
        automaton = ahocorasick.Automaton()
        for piece in self.model.ids:
            if self.follow(piece):  # the others never come out of an encoding
                automaton.add_word(piece, (self.model.ids[piece], len(piece)))
        automaton.make_automaton()
        self.automaton = automaton
        self.table = UnitTable(self)

    def follow(self, piece: str) -> bool:
        """Merge a piece from its characters, the best pair first and the leftmost of equals, and keep
        each merge's score with the outermost symbols before it. False if it doesn't end as one token."""
        parts, score = list(piece), self.model.score
        scores: list[float] = []
        lefts, rights = [parts[0]], [parts[-1]]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            scores.append(best)
            lefts.append(parts[0])
            rights.append(parts[-1])
        self.history[piece] = [*scores, -math.inf], lefts, rights
        return True

    def compatible(self, first: int, second: int) -> bool:
        """Whether the joined text of two tokens encodes to these two: the merges inside either run in the
        order of their scores, and at no point may the pair across the border be the next to merge."""
        left, right = self.model.piece[first], self.model.piece[second]
        left_scores, _, borders = self.history[left]
        right_scores, fronts, _ = self.history[right]
        joint = self.model.score.get
        i = j = 0
        while True:
            next_left, next_right = left_scores[i], right_scores[j]
            s = joint(borders[i] + fronts[j])
            if s is not None and s > next_left and s >= next_right:
                return False
            if next_left >= next_right:
                if next_left == -math.inf:
                    return True
                i += 1
            else:
                j += 1

    def last_tokens(self, part: str) -> list[int]:
        """For each length of prefix the id of its last token; -1 at the front and after a character without a piece."""
        last = [-1] * (len(part) + 1)
        pairs, pieces = self.pairs, len(self.model.piece)
        for end, (token, length) in self.automaton.iter(part):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length]
            if before >= 0:
                pair = before * pieces + token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs.find(pair)
                    if fits is None:
                        fits = self.compatible(before, token)
                        pairs.put(pair, fits)
                if not fits:
                    continue
            last[end] = token
        return last

    def encode_part(self, part: str) -> list[int]:
        """Ids of a string, read backwards from its table of last tokens."""
        last, piece = self.last_tokens(part), self.model.piece
        out: list[int] = []
        at = len(part)
        while at:
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= len(piece[token])
            else:
                at -= 1
                out.extend(self.model.byte_ids[b] for b in reversed(part[at].encode()))
        return out[::-1]

    def encode_unit(self, unit: str, keep_whole: bool = True) -> list[int]:
        """Ids of a unit. ``keep_whole``: it is kept where it is one part too; not needed where the unit is kept."""
        unit = unit.replace(" ", SPACE)
        out: list[int] = []
        start, adjacent = 0, self.adjacent
        for end in range(1, len(unit) + 1):
            if unit[end - 1 : end + 1] in adjacent:
                continue
            part = unit[start:end]
            found = self.parts.find(part)
            if found is None:
                found = self.encode_part(part)
                if len(part) <= KEPT_LENGTH and (keep_whole or len(part) < len(unit)):
                    self.parts.put(part, found)
            out += found
            start = end
        return out

    def unit(self, unit: str) -> tuple[str, str]:
        """The decimal ids and the decoded text of a unit, which is the same object where they are equal."""
        found = self.units.find(unit)
        if found is None:
            ids = self.encode_unit(unit, keep_whole=False)
            decoded = self.spell(ids)
            found = " ".join(map(str, ids)), unit if decoded == unit else decoded
            if len(unit) <= KEPT_LENGTH:
                self.units.put(unit, found)
        return found

    def spell(self, ids: Iterable[int]) -> str:
        return b"".join([self.model.bytes[i] for i in ids]).decode(errors="replace")

    def cut(self, text: str) -> list[str]:
        """Units of a text, with the dummy space at its front; space marks are written as spaces, which take
        fewer bytes in the tables."""
        if not text:
            return []
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return [" " + u for u in text.split(" ")]
        return [u.replace(SPACE, " ") for u in _UNIT.findall(SPACE + text.replace(" ", SPACE))]

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text, the end id last."""
        return [i for u in self.cut(text or "") for i in self.encode_unit(u)] + [self.model.end]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; the dummy space at the front goes, control ids have no text."""
        return self.spell(ids).removeprefix(" ")

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids (with the end id), sha256 of the decimal ids, sha256 of the decoded text."""
        n, ids, decoded = self.digest_block(pa.array([text], pa.string()))
        return n[0], ids[0], decoded[0]

    def digest_block(self, texts: pa.Array) -> tuple[list[int], list[str], list[str]]:
        """The digests of each text; every distinct unit of the block is encoded and decoded once."""
        units, ends = cut_block(texts)
        coded = units.dictionary_encode()
        distinct = coded.dictionary
        lengths = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
        order = np.argsort(-lengths, kind="stable")
        n_long = int(np.count_nonzero(lengths > TABLE_LENGTH))
        distinct, lengths = distinct.take(pa.array(order)), lengths[order]
        long = [self.units.get(u) or self.unit(u) for u in distinct[:n_long].to_pylist()]
        n, ids, decoded = self.table.encode(distinct[n_long:], lengths[n_long:])
        n = np.concatenate([np.array([i.count(" ") + 1 for i, _ in long], np.int64), n])
        ids = pa.concat_arrays([pa.array([i for i, _ in long], pa.large_binary()), ids])
        decoded = pa.concat_arrays([pa.array([t.encode() for _, t in long], pa.large_binary()), decoded])

        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[coded.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(n[place])])[ends]
        ids, decoded = join(ends, ids, place, b" "), join(ends, decoded, place, b"")
        last = str(self.model.end).encode()
        return (
            (np.diff(total) + 1).tolist(),
            [hashlib.sha256(i + b" " + last if i else last).hexdigest() for i in ids.to_pylist()],
            [hashlib.sha256(t.removeprefix(b" ")).hexdigest() for t in decoded.to_pylist()],
        )


def cut_block(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts one after the other, as :meth:`PrefixTableCodec.cut` has them, and where each text's begin and end."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
    none, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), none, pc.binary_join_element_wise(space, texts, none))
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data or b"", np.uint8)[: ends[-1]]
    first = held == ord(" ")
    first[1:] &= held[:-1] != ord(" ")
    first[ends[:-1][np.diff(ends) > 0]] = True  # a text before may end in a space
    starts = np.flatnonzero(first)
    cuts = np.append(starts, ends[-1]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), data), np.searchsorted(starts, ends)


def join(ends: np.ndarray, values: pa.Array, at: np.ndarray, by: bytes) -> pa.Array:
    """The values at each place of ``at``, joined from one of the ``ends`` to the next."""
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), values.take(pa.array(at)))
    return pc.binary_join(lists, pa.scalar(by, pa.large_binary()))


class UnitTable:
    """Fills the tables of last tokens of many units together.

    The units are ordered from the longest, so that those with a k-th character are the first so many. From each place
    k the trie of the pieces is walked along the following characters; a piece that ends at a place is its last token if
    it is compatible with the last token of place k. The trie is a double array: the child of node s by character c is
    ``base[s] + c``, if that slot's ``parent`` is s. What is known of pairs lies in a table of fixed size, in which a
    pair takes the place of another in its slot.
    """

    def __init__(self, codec: PrefixTableCodec):
        self.codec, model = codec, codec.model
        self.pieces = len(model.piece)
        self.length = np.array([len(p) for p in model.piece], np.int32)
        self.decimal = pa.array([str(i).encode() for i in range(self.pieces)], pa.large_binary())
        self.texts = pa.array(model.bytes, pa.large_binary())
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)  # 2 * (first id * pieces + second id) + whether compatible
        letters = sorted({c for p in codec.history for c in p})
        self.letter = np.zeros(ord(letters[-1]) + 2, np.int32)  # code point -> number from 1; 0: without a piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letter[ord(" ")] = self.letter[ord(SPACE)]
        self._plant({c: i for i, c in enumerate(letters, 1)})

    def _plant(self, number: dict[str, int]) -> None:
        """Lay out the trie, nodes with many children first, each where its children find free slots."""
        children: dict[str, list[int]] = {}
        names: dict[str, list[str]] = {}
        for name in {p[:i] for p in self.codec.history for i in range(1, len(p) + 1)}:
            children.setdefault(name[:-1], []).append(number[name[-1]])
            names.setdefault(name[:-1], []).append(name)
        reach = len(number) + 1  # slots that the children of a node may span; so many are free at the end
        taken, slot, base = bytearray(2 * reach), {"": 0}, {}
        taken[0] = 1
        begin = [0] * reach  # by least child, from where slots are tried
        for node in sorted(children, key=lambda x: (x != "", -len(children[x]), x)):
            numbers = children[node]
            least = min(numbers)
            at = taken.find(0, max(least, begin[least])) - least
            while any(taken[at + c] for c in numbers):
                at = taken.find(0, at + least + 1) - least
            begin[least] = at + least
            base[node] = at
            for name, c in zip(names[node], numbers, strict=True):
                taken[at + c] = 1
                slot[name] = at + c
            taken.extend(bytes(max(0, at + max(numbers) + 2 * reach - len(taken))))
        size = len(taken)
        self.base, self.parent, self.token = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for node, at in base.items():
            self.base[slot[node]] = at
            self.parent[[slot[name] for name in names[node]]] = slot[node]
        for piece in self.codec.history:
            self.token[slot[piece]] = self.codec.model.ids[piece]

    def fits(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the tokens may stand side by side; anything may follow the front or a character without a piece."""
        free = (first < 0) | (first >= self.pieces)
        pair = first.astype(np.int64) * self.pieces + second
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)
        found = self.pairs[slot]
        new = np.flatnonzero(((found >> 1) != pair) & ~free)
        out = free | ((found & 1) == 1)
        if len(new):
            pairs, back = np.unique(pair[new], return_inverse=True)
            compatible = self.codec.compatible
            known = np.array([compatible(*divmod(x, self.pieces)) for x in pairs.tolist()])[back]
            out[new] = known
            self.pairs[slot[new]] = 2 * pair[new] + known
        return out

    def encode(self, units: pa.Array, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of units in order of falling length: the number of ids, the decimal ids joined by a space, the decoded bytes."""
        points = np.frombuffer("".join(units.to_pylist()).encode("utf-32-le"), np.uint32)
        begin = np.cumsum(lengths, dtype=np.int64) - lengths
        letters = self.letter[np.minimum(points, len(self.letter) - 1)]
        unknown, which = np.unique(points[letters == 0], return_inverse=True)
        letters[letters == 0] = -1 - which

        longest = int(lengths[0]) if len(lengths) else 0
        having = [int(np.searchsorted(-lengths, -k, side="right")) for k in range(longest + 1)]  # units with k characters
        row = np.concatenate([[0], np.cumsum(having)])  # where the place after k characters begins in `last`
        by_place = [letters[begin[: having[k + 1]] + k] for k in range(longest)]
        last = np.full(int(row[-1]), -1, np.int32)
        base, parent, token = self.base, self.parent, self.token
        for k, here in enumerate(by_place):
            other = np.flatnonzero(here < 0)
            last[row[k + 1] + other] = self.pieces - 1 - here[other]
            at = np.flatnonzero(here > 0)
            node = base[0] + here[at]
            end = k + 1
            while True:
                has = token[node]
                ends = np.flatnonzero(has >= 0)
                to = row[end] + at[ends]
                open_ = last[to] < 0
                ends, to = ends[open_], to[open_]
                good = self.fits(last[row[k] + at[ends]], has[ends])
                last[to[good]] = has[ends[good]]
                if end == longest:
                    break
                more = int(np.searchsorted(at, having[end + 1]))
                at, node = at[:more], node[:more]
                child = base[node] + np.maximum(by_place[end][at], 0)  # the slot before all children is no child
                lives = parent[child] == node
                at, node, end = at[lives], child[lives], end + 1
                if not len(at):
                    break

        # Backwards from the ends, a token of every unit at a time.
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(lengths), np.int64)
        length = np.concatenate([self.length, np.ones(len(unknown), np.int32)])
        unit, at = np.arange(len(lengths)), lengths.astype(np.int64)
        while len(unit):
            found = last[row[at] + unit]
            taken.append((unit, found))
            count[unit] += 1
            at = at - length[found]
            unit, at = unit[at > 0], at[at > 0]
        ends = np.concatenate([[0], np.cumsum(count)])
        tokens = np.empty(int(ends[-1]), np.int32)
        for k, (unit, found) in enumerate(taken):
            tokens[ends[unit + 1] - 1 - k] = found

        # A character without a piece stands for the ids of its bytes.
        model, spelled = self.codec.model, [chr(c).encode() for c in unknown.tolist()]
        decimal = [" ".join([str(model.byte_ids[b]) for b in x]).encode() for x in spelled]
        texts = [b"".join([model.bytes[model.byte_ids[b]] for b in x]) for x in spelled]
        decimal = pa.concat_arrays([self.decimal, pa.array(decimal, pa.large_binary())])
        texts = pa.concat_arrays([self.texts, pa.array(texts, pa.large_binary())])
        n = np.concatenate([np.ones(self.pieces, np.int64), np.array([len(x) for x in spelled], np.int64)])
        n = np.diff(np.concatenate([[0], np.cumsum(n[tokens])])[ends])
        return n, join(ends, decimal, tokens, b" "), join(ends, texts, tokens, b"")


def codec(path: str) -> PrefixTableCodec:
    return kept(path, "codec", lambda: PrefixTableCodec(path))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int, the end id last)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch, texts in blocks(batches):
            yield pa.record_batch([batch.column(0), pa.array([c.encode(t) for t in texts], pa.list_(pa.int32()))], schema=schema)

    return map_arrow(_rows(docs, id_col, text_col), encode, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text for the rows of :func:`encode_texts`."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([c.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.string())], schema=schema)

    return map_arrow(encoded.select("doc_id", "ids"), decode, "doc_id long, text string")


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def codec_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded and decoded, with only digests leaving the task."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch, _ in blocks(batches):
            n, ids, decoded = c.digest_block(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], schema=_DIGESTS)
        give_back(collect=False)  # the tables stay for the next task; to go through them takes long

    return map_arrow(_rows(docs, id_col, text_col), digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
