"""Operators at the ends of what they promise."""

import numpy as np
import pyarrow as pa
import pytest

from modelsmith.llm import decontamination as dc
from modelsmith.llm import topk_search as tk


def test_search_of_large_components_does_not_overflow():
    rng = np.random.default_rng(3)
    q = (1 << 24) - 1
    candidates = rng.integers(-(1 << 10), 1 << 10, (8192, 384))
    candidates[[5, 4000, 8000]] = q
    queries = np.full((1, 384), q)
    make = lambda ids, rows, **more: pa.table({**more, "vec_id": ids, "q": pa.array(rows.tolist(), pa.list_(pa.int64()))})
    found = tk.search_cell(make(pa.array([-1]), queries, query=pa.array([1])), make(pa.array(range(8192)), candidates), 5).to_pylist()
    truth = sorted(((-sum(int(a) * int(b) for a, b in zip(c, queries[0], strict=True)), i) for i, c in enumerate(candidates)))[:5]
    assert sorted((-r["score"], r["vec_id"]) for r in found) == truth


def test_selection_takes_ties_by_place():
    scores = np.array([[3, 3, 3, 3, 1], [0, 0, 0, 0, 0], [1, 2, 3, 4, 5]])
    own = np.array([[False, True, False, False, False], [True, True, True, True, False], [False] * 5])
    rows, cols = tk.select_best(scores, own, 2)
    assert list(zip(rows.tolist(), cols.tolist(), strict=True)) == [(0, 0), (0, 2), (1, 4), (2, 3), (2, 4)]


def test_too_large_components_are_refused(make):
    vectors = make([(1, [1.0, 65535.9]), (2, [float("inf")])], "vec_id long, embedding array<double>")
    assert tk.quantise(vectors).count() == 1
    with pytest.raises(Exception, match="or more in size"):
        tk.quantise(make([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_items_without_an_id_hit(make):
    words = [f"w{i}" for i in range(12)]
    docs = make([(1, "x " + " ".join(words)), (2, "y")], "doc_id long, text string")
    items = make([(None, " ".join(words)), ("b", " ".join(words[:10])), (None, None)], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in dc.judge_contamination(dc.find_passages(docs, items)).collect()}
    assert got == {1: (12, 1, True), 2: (0, 0, False)}
    alone = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in dc.judge_contamination(dc.find_passages(docs, items.where("item_id is null"))).collect()}
    assert alone == {1: (12, 0, True), 2: (0, 0, False)}
