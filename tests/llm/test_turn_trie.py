"""Operator 12: conversation prefix trie by truncation peeling."""

import hashlib
import random
import zlib
from collections import defaultdict

from modelsmith.llm import turn_trie as tt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, n long, `first` long"


def _plain(rows, rebuild=True):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in convs.items()}
    if rebuild:
        seqs = {}
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            seqs[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    else:
        seqs = own
    members = defaultdict(list)
    for c, ts in seqs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []

    def walk(p):
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        leaves = 0 if children[p] else 1
        for q in children[p]:
            s, n = walk(q)
            saved, leaves = saved + s, leaves + n
        ends = ",".join(str(c) for c in sorted(members[p]) if len(seqs[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return saved, leaves

    if seqs:
        walk(())
    return sorted(out, key=repr)


def _found(make, rows, **options):
    frame = make([(*r, 1, "p", 2, 3) for r in rows], SCHEMA)
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in cols) for r in tt.turn_trie(frame, **options).collect()), key=repr)


def test_random_tries(make):
    rng = random.Random(3)
    for case in range(3):
        rows = []
        for c in rng.sample(range(-150, 450), 120):
            for turn in range(rng.choice([1, 2, 3, 7, 9])):
                rows.append((c, turn, rng.choice("ua"), "é" * rng.randint(0, 2)))
        rng.shuffle(rows)
        assert _found(make, rows, rebuild=case != 2) == _plain(rows, case != 2)


def test_odd_rows(make):
    long = "wörd " * 100_000
    rows = [(0, 0, "user", long), (0, 1, None, None), (1, None, "a", "x"), (1, None, "a", "w"), (1, 5, "b", "y"), (1, 5, "b", "y"), (1, 5, "a", "z"), (None, 0, "u", "lost"),
            (2, 3, "", ""), (2, 3, None, None), (100, 9, "user", long), (105, 0, "user", long), (205, 0, "q", "t")]
    assert _found(make, rows) == _plain(rows)
    assert _found(make, rows, rebuild=False) == _plain(rows, False)
    assert _found(make, []) == []


def test_copies_and_a_long_conversation(make):
    rows = [(c, t, "u", f"t{t}") for c in range(9000) for t in range(2)]  # more ends than a piece holds
    rows += [(c, t, "u", f"t{t}") for c in (9001, 9002) for t in range(60)] + [(9003, t, "u", f"t{t}" if t < 40 else "z") for t in range(55)]
    assert _found(make, rows, rebuild=False) == _plain(rows, False)
    assert _found(make, rows) == _plain(rows)


def test_rounds_are_the_depths_at_which_paths_part(make):
    ends = make([(1, t, "u", f"t{t}") for t in range(50)] + [(2, t, "u", f"t{t}" if t < 30 else "x") for t in range(50)] + [(3, 0, "u", "t0")], "conv_id long, turn long, role string, text string")
    assert tt.event_depths(tt.tips(tt.paths(tt.sequences(ends)))) == [30, 1, 0]
