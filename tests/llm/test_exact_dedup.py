"""Operator 11: exact dedup by chunk recipes."""

import hashlib
import random
from collections import defaultdict

import pytest

from modelsmith.llm import exact_dedup as ed


def _plain(rows):
    """Brute force over (doc_id, text): (doc_id, keep_id, group_size, sha) of each row, and the kept (doc_id, sha)."""
    fold = [(i, (t or "").encode().translate(ed._FOLD)) for i, t in rows]
    groups = defaultdict(list)
    for i, t in fold:
        groups[t].append(i)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {t: hashlib.sha256(t).hexdigest() for t in groups}
    return sorted(((i, largest[t], len(groups[t]), sha[t]) for i, t in fold), key=repr), sorted(((largest[t], sha[t]) for t in groups), key=repr)


def _found(df):
    rows = df.collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr), sorted(((r.doc_id, r.text_sha256) for r in rows if r.kept), key=repr)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert _found(ed.exact_groups(odd)) == _plain(rows)
    assert ed.exact_groups(none).count() == 0


def test_planted_copies(make):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefÄé", k=rng.randint(1, 9))) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 300, 3000]))) for _ in range(60)]
    near = [t[:-1] + "!" for t in texts[:30]] + ["x" + t for t in texts[:30]]
    upper = [t.replace("a", "A") for t in texts[10:50]]
    beyond = [t.replace("ä", "Ä") for t in texts]
    all_texts = texts * 3 + near + upper + beyond + [texts[0]] * 300
    ids = rng.sample(range(10_000), len(all_texts))
    assert _found(ed.exact_groups(make(list(zip(ids, all_texts, strict=True)), "doc_id long, text string"))) == _plain(list(zip(ids, all_texts, strict=True)))


def test_chunks_depend_on_bytes_alone():
    rng = random.Random(2)
    data = rng.randbytes(3_000_000)
    chunks = ed.chunks_of(data)
    assert b"".join(chunks) == data and max(map(len, chunks)) <= ed.LARGEST and min(map(len, chunks[:-1])) >= ed.SMALLEST
    # One step and many give the same hash, and a shifted passage soon has the same chunks again.
    import numpy as np

    raw = np.frombuffer(data[:5000], np.uint8)
    assert [sum(int(ed._GEAR[raw[i - k]]) << k for k in range(min(32, i + 1))) % 2**32 for i in range(200)] == ed.rolling_hash(raw)[:200].tolist()
    assert len(set(chunks) & set(ed.chunks_of(b"some more" + data))) > len(chunks) - 10
    assert ed.chunks_of(b"") == [] and ed.chunks_of(b"x" * 40_000) == [b"x" * 16384, b"x" * 16384, b"x" * 7232]


def test_shared_identifiers_are_found(make):
    docs = make([(i, t) for i, t in enumerate(["a", "b", "a", "c", "A"])], "doc_id long, text string")
    weak = lambda chunk, seed: ed.identifier(chunk, seed)[:16] if seed == 2 else bytes(16)
    assert ed.verified_seed(docs) == 0 and ed.verified_seed(docs, name=weak) == 2
    assert _found(ed.exact_groups(docs, name=weak)) == _found(ed.exact_groups(docs))
    with pytest.raises(RuntimeError):
        ed.verified_seed(docs, name=lambda chunk, seed: bytes(16))
