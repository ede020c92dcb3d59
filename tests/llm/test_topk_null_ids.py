"""Vectors without an id take no part in the search."""

from modelsmith.llm import topk_search as tk


def test_null_ids_take_no_part(spark, make):
    big = (1 << 53) + 1
    frame = tk.quantise(make([(None, [9.0]), (big, [2.0]), (1, [1.0])], "vec_id long, embedding array<float>"))
    got = sorted(tuple(r) for r in tk.top_k(frame, frame, least_blocks=1).collect())
    assert got == [(1, 1, big, 512 * 256), (big, 1, 1, 512 * 256)]
