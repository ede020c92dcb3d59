"""Operators 3, 5, 6, 7: against the libraries and brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from modelsmith.llm import decontamination as dc
from modelsmith.llm import piece_codec as pc
from modelsmith.llm import simhash as sh
from modelsmith.llm import token_counts as tc
from modelsmith.llm.components import connected_components
from modelsmith.llm.registry import tokenizer_path
from modelsmith.llm.tables import table
from tests.conftest import SF_SMALL

PIECES = tokenizer_path("piece_bpe_32k.model")
BYTES = tokenizer_path("byte_bpe_50k.json")
HARD = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "<s>", "<0x0A>", "a\x00b", "\n\n\n", "é" * 30, "😀 😀", "hello world  foo   bar ", "a\n  b", "a \n b\t c", "x<|endoftext|> y"]


def _random_texts(n, seed=3):
    random.seed(seed)
    letters = list("aabbeett  \n\t▁éß中文😀\x00.,'llre12\x85\xa0")
    return ["".join(random.choice(letters) for _ in range(random.randint(1, 50))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_codec_matches_sentencepiece():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = pc.PrefixTableCodec(PIECES)
    codec.units.half = codec.parts.half = codec.pairs.half = 50  # the tables turn over
    pieces = [p.replace("▁", " ") for p in codec.model.ids]
    mixed = ["".join(random.choice(pieces) for _ in range(8)) for _ in range(1500)]
    for text in [*HARD, *_random_texts(2000), *mixed]:
        ids = sp.encode(text, add_eos=True)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == sp.decode(ids), text
        assert codec.digests(text) == (len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))), text


def test_codec_encodes_a_block_at_once(monkeypatch):
    """Blocks of texts give what the library gives, with few slots for pairs too; short units are not encoded one by one."""
    import pyarrow as pa
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(pc, "PAIR_BITS", 6)
    codec = pc.PrefixTableCodec(PIECES)
    one_by_one = []
    monkeypatch.setattr(codec, "encode_part", lambda part, f=codec.encode_part: (one_by_one.append(part), f(part))[1])
    random.seed(5)
    pieces = [p.replace("▁", " ") for p in codec.model.ids]
    mixed = ["".join(random.choice(pieces) for _ in range(random.randint(1, 6))) for _ in range(3000)]
    short = [None, *HARD[:-6], *(t for t in _random_texts(2000, 4) + mixed if max(map(len, codec.cut(t))) <= pc.TABLE_LENGTH), "", None, "􏿿 ☃�", " "]
    short = [t for t in short if t is None or all(len(u) <= pc.TABLE_LENGTH for u in codec.cut(t))]
    want = [sp.encode(t or "", add_eos=True) for t in short]
    want = [(len(i), sha(" ".join(map(str, i))), sha(sp.decode(i))) for i in want]
    assert list(zip(*codec.digest_block(pa.array(short, pa.string())), strict=True)) == want
    assert list(zip(*codec.digest_block(pa.array(["cut off", *short], pa.string())[1:]), strict=True)) == want
    assert [codec.digests(t) for t in short[:40]] == want[:40] and not one_by_one
    long = ["ab" * n + " " + "é中􏿿" * n + " a" for n in (1, 23, 24, 25, 47, 48, 49, 500)] + [" " * n + "x" + " " * n for n in (46, 47, 48, 49, 200)]
    for texts in (long, long[::-1], [], [None], [""]):
        got = codec.digest_block(pa.array(texts, pa.string()))
        want = [sp.encode(t or "", add_eos=True) for t in texts]
        assert list(zip(*got, strict=True)) == [(len(i), sha(" ".join(map(str, i))), sha(sp.decode(i))) for i in want]
    assert one_by_one


def test_codec_frames(spark, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256) for r in pc.codec_digests(odd, PIECES).collect())
    want = [(r.doc_id or 0, sp.encode(r.text or "", add_eos=True)) for r in odd.collect()]
    assert got == sorted((i, len(x), sha(" ".join(map(str, x)))) for i, x in want)
    encoded = pc.encode_texts(odd, PIECES)
    back = sorted((r.doc_id or 0, r.text) for r in pc.decode_ids(encoded, PIECES).collect())
    assert back == sorted((i, sp.decode(x)) for i, x in want)
    assert pc.codec_digests(none, PIECES).count() == 0


def test_counts_match_tokenizers(spark, odd, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BYTES)
    count = tc.UnitCounter(BYTES, kept=100)
    texts = [*HARD, *_random_texts(2000)]
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        assert count.count(part) == [len(plain.encode(t, add_special_tokens=False)) for t in part]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tc.count_tokens(odd, BYTES).collect())
    want = []
    for r in odd.collect():
        n = len(plain.encode(r.text or "", add_special_tokens=False))
        want.append((r.doc_id or 0, len((r.text or "").encode()), n, n > 1024))
    assert got == sorted(want)
    assert tc.count_tokens(none, BYTES).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _contamination(text, items):
    words = [(m.group(), m.span()) for m in WORD.finditer(_lower(text or ""))]
    hit, found = set(), set()
    for name, item in items:
        w = WORD.findall(_lower(item or ""))
        for i in range(max(1, len(w) - 9)) if w else ():
            key = w[i : i + 10]
            for j in range(len(words) - len(key) + 1):
                if [x for x, _ in words[j : j + len(key)]] == key:
                    hit.update(range(j, j + len(key)))
                    found.update([] if name is None else [str(name)])
    return len(words), hit, sorted(found), words


@pytest.mark.parametrize("max_key_bytes", [1 << 20, 40])
def test_contamination(spark, make, odd, none, max_key_bytes):
    random.seed(5)
    vocab = ["a", "B", "é", "x1", "ÄB", "c"]
    items = [(i, "-".join(random.choice(vocab) for _ in range(random.choice([0, 2, 9, 10, 14])))) for i in range(12)]
    items += [(99, None), (None, "a B"), (3, items[3][1])]
    docs = []
    for i in range(60):
        text = "  ".join(random.choice(vocab) + random.choice(["", ",", "!"]) for _ in range(random.randint(0, 60)))
        docs.append((i, text + "; " + (items[i % 12][1] if i % 3 else "")))
    bench = make(items, "item_id long, text string")
    frame = dc.find_passages(make(docs, "doc_id long, text string"), bench, max_key_bytes=max_key_bytes)
    rows = {r.doc_id: r for r in frame.collect()}
    digest = {r.doc_id: r for r in dc.judge_contamination(frame).collect()}
    for i, text in docs:
        n, hit, found, words = _contamination(text, items)
        assert digest[i].n_words == n and digest[i].n_hit == len(hit) and digest[i].contaminated == bool(hit)
        assert rows[i].item_ids == found and digest[i].n_items == len(found) and digest[i].items_sha256 == sha(",".join(found))
        spans = [(text[s.first : s.end], words[w.first][1][0], words[w.end - 1][1][1]) for s, w in zip(rows[i].char_spans, rows[i].word_spans)]
        assert all(a == text[x:y] for a, x, y in spans)
    assert dc.find_passages(odd, bench).count() == odd.count()
    assert dc.find_passages(none, bench).count() == 0
    empty = make([], "item_id long, text string")
    assert not dc.judge_contamination(dc.find_passages(odd, empty)).where("contaminated or n_hit > 0").count()


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def _check_simhash(docs, got):
    prints = {}
    for r in docs.collect():
        prints.setdefault(_fingerprint(r.text), []).append(r.doc_id)
    fps = list(prints)
    linked = [(a, b) for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= 4]
    part = _components(fps, linked)
    smallest = {}
    for fp, ids in prints.items():
        known = [i for i in ids if i is not None]
        smallest[part[fp]] = min([*known, smallest.get(part[fp], 1 << 62)])
    want = sorted(((i if i is not None else -1), f"{fp:016x}", smallest[part[fp]]) for fp, ids in prints.items() for i in ids)
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.fingerprint, r.component_id) for r in got.collect()) == want


def test_simhash_small_table(spark, odd, none):
    _check_simhash(odd, sh.near_duplicates(odd))
    assert sh.near_duplicates(none).count() == 0
    docs = table(spark, SF_SMALL, "documents")
    _check_simhash(docs, sh.near_duplicates(docs))


def test_near_pairs_lose_no_component(spark, make):
    random.seed(8)
    fps = set()
    for _ in range(12):  # dense groups and chains
        base = random.getrandbits(64)
        fps.add(base)
        for _ in range(40):
            x = random.choice([base, max(fps)])
            for b in random.sample(range(64), random.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    want = _components(list(fps), [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    vertices = make([(s,) for s in signed], "fp long")
    parts = {signed[r.node]: r.component for r in connected_components(sh.near_pairs(vertices)).collect()}
    groups = {}
    for x in fps:
        groups.setdefault(parts.get(x, f"alone {x}"), set()).add(want[x])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_components_of_a_chain(spark, make):
    pairs = make([(i, i + 1) for i in range(40)] + [(100, 100), (50, 60), (60, 50)], "a long, b long")
    got = {r.node: r.component for r in connected_components(pairs).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 60: 50}
