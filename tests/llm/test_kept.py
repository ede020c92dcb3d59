"""A worker process holds the models of one operator, not of all that it has served."""

import pickle
import weakref
from types import SimpleNamespace

from modelsmith.llm import decontamination, piece_codec
from modelsmith.llm.kept import kept
from modelsmith.llm.registry import tokenizer_path


def test_another_operator_takes_the_place():
    path = tokenizer_path("piece_bpe_32k.model")
    codec = weakref.ref(piece_codec.codec(path))
    assert piece_codec.codec(path) is codec()
    sent = SimpleNamespace(value=pickle.dumps({b" a b ": ["x"]}))
    automaton, names = decontamination._built("run", sent)
    assert codec() is None and names == ["x"]
    assert decontamination._built("run", sent)[0] is automaton
    assert piece_codec.codec(path).encode("a")


def test_idle_workers_hold_no_index(spark, make):
    """After scoring, the worker processes hold none of the models of it."""
    from modelsmith.llm import toxicity
    from modelsmith.llm.ship import map_arrow

    docs = make([(i, f"word{i % 7} other{i % 3}") for i in range(60)], "doc_id long, text string")
    labels = make([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert toxicity.nearest_labelled(docs, labels).count() == 60

    def held(batches):
        import gc

        import pyarrow as pa

        from modelsmith.llm.toxicity import BlockMaxIndex

        for batch in batches:
            n = sum(isinstance(x, BlockMaxIndex) for x in gc.get_objects())
            yield pa.record_batch([pa.array([n] * batch.num_rows, pa.int64())], ["n"])

    assert {r.n for r in map_arrow(docs.select("doc_id").repartition(4), held, "n long").collect()} == {0}


def test_parts_of_one_owner_stay_together():
    made = []
    for part in ("vocabulary", "index", "vocabulary"):
        kept("owner", part, lambda part=part: made.append(part) or part)
    assert made == ["vocabulary", "index"]
