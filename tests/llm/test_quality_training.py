"""What the quality classifier is trained on, and its class prior."""

import numpy as np

from modelsmith.llm import quality as ql


def _rows(n0, n1):
    return [(i, "drab junk words" if i < n0 else "fine clear prose", int(i >= n0)) for i in range(n0 + n1)]


def _train(make, rows, monkeypatch, labels=None, **options):
    seen = []

    def learn(self, bags, labels, **_):
        seen.append((len(bags), labels.tolist()))
        self.bias = np.array([0.0, np.log(sum(labels) / (len(labels) - sum(labels)))], np.float32)  # training that learns the odds it meets

    monkeypatch.setattr(ql.Embeddings, "learn", learn)
    taught = labels or [(i, y) for i, _, y in rows]
    _, bias = ql.train(make([r[:2] for r in rows], "doc_id long, text string"), make(taught, "doc_id long, quality int"), **options)
    return bias, seen


def test_prior_counts_once(spark, make, monkeypatch):
    for sample in (1000, 20):  # all rows, and ten of each class
        bias, _ = _train(make, _rows(10, 90), monkeypatch, sample=sample)
        assert np.isclose(bias, np.log(9), atol=1e-6), sample


def test_an_id_teaches_once(spark, make, monkeypatch):
    rows = _rows(6, 6)
    labels = [(i, y) for i, _, y in rows for _ in range(1 + 5 * (i == 0))]
    _, seen = _train(make, rows + [(0, "drab junk", 0)] * 50, monkeypatch, labels, sample=8)
    assert [(n, sorted(y)) for n, y in seen] == [(8, [0] * 4 + [1] * 4)]
