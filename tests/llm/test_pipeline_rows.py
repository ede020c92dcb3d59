"""The pipeline's decisions fall on the rows that were judged, whatever their ids."""

import tempfile

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(make, rows):
    return make([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)


def _kept(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in frame.collect()), key=repr)


def _text(name):
    return " ".join(f"{name}{k}" for k in range(40))


def test_near_duplicates_keep_one_row_a_component(spark, make):
    a, b, c, d, e = (_text(x) for x in "abcde")
    docs = _docs(make, [(None, a), (None, b), (None, b), (8, c), (8, d), (9, d), (None, d), (7, e), (7, e)])
    want = [(False, 7, e), (False, 8, c), (False, 8, d), (True, 0, a), (True, 0, b)]
    assert _kept(cp.drop_near_duplicates(spark, docs, "")) == sorted(want, key=repr)


def test_contaminated_rows_go_whatever_their_id(spark, make):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    make([(0, _text("bench"))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = _docs(make, [(None, _text("bench")), (None, "clean"), (3, _text("bench")), (3, "clean too"), (4, None)])
    assert _kept(cp.drop_contaminated(spark, docs, folder)) == sorted([(True, 0, "clean"), (False, 3, "clean too"), (False, 4, None)], key=repr)


def test_toxic_rows_go_whatever_their_id(spark, make):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    make([(i, i % 2) for i in range(80)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    taught = [(i, "hatrix molvan" if i % 2 else "sunny garden") for i in range(80)]
    odd = [(None, "molvan hatrix"), (None, "garden sunny"), (200, "hatrix molvan"), (200, "sunny garden")]
    kept = cp.drop_toxic(spark, _docs(make, taught + odd), folder)
    assert kept.columns == list(cp.COLUMNS)
    assert _kept(kept) == sorted([(i is None, i or 0, t) for i, t in taught + odd if "hatrix" not in t], key=repr)
