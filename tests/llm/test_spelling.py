"""Operator 13: spelling variants by a relational trie frontier."""

import random
import re
import zlib
from collections import Counter

from modelsmith.llm import spelling as sp


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _plain_groups(words):
    near = {w: [v for v in words if _near(v, w)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def _plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def _groups(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_near_words_of_random_words(spark):
    rng = random.Random(4)
    for alphabet, longest in (("abé", 8), ("a", 6)):
        words = {"".join(rng.choices(alphabet, k=rng.randint(1, longest))): rng.choice([1, 2, 4, 9, 30]) for _ in range(300)}
        frame = spark.createDataFrame(list(words.items()), "word string, n long")
        pairs = [tuple(sorted((r.a, r.b))) for r in sp.near_words(frame).collect()]
        assert sorted(pairs) == sorted((a, b) for a in words for b in words if a < b and _near(a, b))  # each once
        found = sp.spelling_groups(frame)
        assert found.count() == len(words) and _groups(found) == _plain_groups(words)


def test_words_and_their_slips(make):
    rng = random.Random(5)
    pool = ["Colour", "color", "colours", "Äpfel", "äpfel", "naïve", "naive", "a×b÷c", "straße", "tiny", "x" * 300, "x" * 299 + "y"]
    rows = [(rng.choice([None, 1, 2, 77, 10**12]), " ".join(rng.choices(pool, k=40)) + "_COLOUR3color") for _ in range(60)] + [(5, None), (6, ""), (7, "12 _ 34")] + [(8, "repeat repeat repeats")] * 4
    docs = make([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    words = _plain_words(rows)
    assert {r.word: r.n for r in sp.count_words(docs).collect()} == words
    assert _groups(sp.spelling_groups(sp.count_words(docs))) == _plain_groups(words)


def test_odd_tables(odd, none):
    assert _groups(sp.spelling_groups(sp.count_words(odd))) == _plain_groups(_plain_words([(r.doc_id, r.text) for r in odd.collect()]))
    assert sp.spelling_groups(sp.count_words(none)).count() == 0
