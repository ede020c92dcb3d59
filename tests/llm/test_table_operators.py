"""Operators 1, 2, 4, 8, 9, 10 and the pipeline."""

import random
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelsmith.llm import line_dedup as ld
from modelsmith.llm import quality as ql
from modelsmith.llm import sharding, toxicity
from modelsmith.llm import topk_search as tk
from modelsmith.llm import url_filters as uf
from modelsmith.llm.prefix import prefix_sums
from modelsmith.llm.tables import held_out, table
from tests.conftest import SF_CHECK, SF_SMALL

SF_LARGER = "/root/testdata/sf0.1"


# --- 1: url filters


def test_urls_and_rules(spark, make):
    urls = ["https://A.Example.NET/en/1?q", "http://b.example.com/de/x", "x://net/", "x://a.net", "x://net?x", "no scheme", None, "", "://", "http://fr.org/fr/", "http://org/fr/#f", "http://exampleXnet/en/", "HTTP://U:p@H.net:80/a"]
    pages = make([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, n int")
    labels = make([(0, 1), (1, None)], "doc_id long, quality int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge_urls(pages, labels).collect()}
    assert got == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("b.example.com", "/de/x", "example.com/de/", "block"), 2: ("net", "/", "net/", "block"),
        3: ("a.net", "", None, "allow"), 4: ("net", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("fr.org", "/fr/", "org/fr/", "allow"), 10: ("org", "/fr/", "org/fr/", "allow"), 11: ("examplexnet", "/en/", None, "allow"),
        12: ("u:p@h.net:80", "/a", None, "allow")}
    assert uf.judge_urls(pages.where("false"), labels).count() == 0
    assert uf.judge_urls(pages, labels.where("false")).where("verdict = 'allow' or rule is not null").count() == len(urls)


def test_reputation_shrinks_and_blocks(spark, make):
    hosts = [("bad.s.com", 200, 190), ("one.s.com", 1, 1), ("good.s.com", 300, 3), ("a.t.com", 100, 2), ("b.t.com", 0, 0)]
    pages, labels, i = [], [], 0
    for host, n, bad in hosts:
        for k in range(max(n, 1)):
            pages.append((i, f"http://{host}/p{k}"))
            if n:
                labels.append((i, int(k >= bad)))
            i += 1
    judged = uf.judge_urls(make(pages, "page_id long, url string"), make(labels, "doc_id long, quality int"))
    got = {r.host: r.verdict for r in judged.select("host", "verdict").distinct().collect()}
    assert got == {"bad.s.com": "block", "one.s.com": "allow", "good.s.com": "allow", "a.t.com": "allow", "b.t.com": "allow"}


def test_multi_label_suffix(spark):
    domain, suffix = uf.domain_parts(F.col("h"), ["co.uk"])
    got = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.y.com",), ("localhost",)], "h string").select("h", domain.alias("d"), suffix.alias("s")).collect()
    assert {r.h: (r.d, r.s) for r in got} == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "localhost": ("localhost", "localhost")}


# --- 2: line dedup


def _dedup(texts, least):
    """Brute force: every run of every start, in order."""
    earlier, out = set(), []
    for text in texts:
        lines = None if text is None else text.split("\n")
        gone = set()
        for i in range(len(lines or ())):
            words, best = 0, i
            for j in range(i, len(lines)):
                words += len([w for w in lines[j].split(" ") if w])
                if tuple(lines[i : j + 1]) not in earlier:
                    break
                best = j + 1 if words >= least else best
            gone.update(range(i, best))
            for j in range(i, len(lines)):
                earlier.add(tuple(lines[i : j + 1]))
        out.append((None if lines is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return out


@pytest.mark.parametrize("least", [1, 6])
def test_line_dedup_brute_force(spark, make, least):
    random.seed(least)
    vocab = ["a b", "c", "d e f", "", "g h", "i  j ", " k"]
    texts = []
    for k in range(30):
        again = k % 5 == 3
        texts.append(random.choice(texts) if again else None if k % 11 == 10 else "\n".join(random.choice(vocab) for _ in range(random.randint(1, 12))))
    got = {r.doc_id: r for r in ld.dedup_lines(make(list(enumerate(texts)), "doc_id long, text string"), least).collect()}
    for i, (text, gone) in enumerate(_dedup(texts, least)):
        assert (got[i].text, got[i].n_deleted or 0) == (text, gone), i


def test_line_dedup_odd_rows(spark, odd, none):
    got = ld.dedup_lines(odd)
    assert set(got.columns) == set(odd.columns) | {"n_deleted"} and got.count() == odd.count()
    texts = sorted((r.doc_id or 0, r.text or "", r.n_deleted or 0) for r in got.collect())
    line = " ".join(f"w{i}" for i in range(60))
    assert (0, line, 0) in texts and (6, "", 1) in texts and (7, "x\ny", 1) in texts  # a null id comes first
    assert sorted(len(t) for i, t, _ in texts if i == 5)[0] == 0
    assert ld.dedup_lines(none).count() == 0


def test_line_dedup_carries_clashing_columns(make):
    line = " ".join(f"w{i}" for i in range(60))
    docs = make([(1, line, 77, 5, "c", 9), (2, line, 78, 6, "d", 9)], "doc_id long, text string, _row long, _hash long, cut string, pos int")
    got = ld.dedup_lines(docs)
    assert sorted((r.doc_id, r.text, r["_row"], r["_hash"], r.cut, r.pos, r.n_deleted) for r in got.collect()) == [(1, line, 77, 5, "c", 9, 0), (2, "", 78, 6, "d", 9, 1)]


# --- 4, 8: learned scores


def _split(rows, mod, rest):
    return [r for r in rows if (zlib.crc32(str(r.doc_id).encode()) % mod == rest) == r.held_out]


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    rows = toxicity.judge_toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert len(_split(rows, 4, 2)) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    good = np.mean([r.predicted == r.toxic for r in held])
    assert good > 0.85 and np.mean([r.score for r in held if r.toxic]) > 3 * np.mean([r.score for r in held if not r.toxic])


@pytest.mark.parametrize("dense", [1, 7, 16])
def test_nearest_is_exact(dense):
    random.seed(4)
    vectors = []
    for _ in range(700):
        at = np.array(sorted(random.sample(range(40), random.randint(0, 5))), np.int64)
        w = np.array([random.choice([1.0, 2.0, 3.0]) for _ in at])
        vectors.append((at, w / np.linalg.norm(w) if len(at) else w))
    ids, labels = list(range(700)), [random.randint(0, 1) for _ in range(700)]
    random.shuffle(ids)
    index = toxicity.BlockMaxIndex(ids, labels, vectors, 40, block=16, dense=dense)
    full = np.zeros((700, 40))
    for i, (at, w) in enumerate(vectors):
        full[i, at] = w
    for q, (at, w) in enumerate(vectors[:200]):
        if len(at):
            cosine = np.round(full @ full[q], 12)
            want = sorted((-c, i) for c, i in zip(cosine, ids) if c > 0)[:15]
            found, got = index.nearest(at, w, 15)
            assert [int(index.ids[f]) for f in found] == [i for _, i in want] and np.allclose(got, [-c for c, _ in want])


def test_toxicity_finds_rare_kinds(spark, make):
    """A kind of toxic text with about a thirtieth of the marked rows is found among rows that were not taught."""
    random.seed(12)
    plain = [f"word{i:02d}" for i in range(60)]
    docs, labels, kinds = [], [], {}
    for i in range(2000):
        kind = random.choices(["rare", "usual", "clean"], [1, 30, 69])[0]
        own = {"rare": ["bomeka", "zuvilo"], "usual": ["hatrix", "molvan", "krelub"], "clean": []}[kind]
        docs.append((i, " ".join([*random.sample(plain, 15), *own])))
        labels.append((i, int(kind != "clean")))
        kinds[i] = kind
    rows = toxicity.judge_toxicity(make(docs, "doc_id long, text string"), make(labels, "doc_id long, toxic int"), mod=2, rest=0).where("held_out").collect()
    for kind, want in (("rare", 1), ("usual", 1), ("clean", 0)):
        got = [r.predicted for r in rows if kinds[r.doc_id] == kind]
        assert got and np.mean([g == want for g in got]) > 0.95, kind


def test_toxicity_scores_by_brute_force(make):
    """Every step again in plain Python: counts, frequencies, relevance, cosines, neighbours and votes."""
    rng = random.Random(21)
    pool = [f"{rng.choice(['alp', 'bet', 'gam', 'Ünd', 'x'])}{rng.choice('aeiou')}{i % 7}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 12))) + rng.choice(["", " BOMEKA", "_bomeki!"])) for i in range(160)] + [(500, None), (3, "twice"), (None, pool[0])]
    labels = [(i, int("bome" in (t or "").lower()) if rng.random() > 0.1 else rng.randint(0, 1)) for i, t in docs if i is not None and i < 120] + [(7, 1)] * 60 + [(9999, 1), (8, None), (9, 5)]
    rows = toxicity.nearest_labelled(make(docs, "doc_id long, text string"), make(labels, "doc_id long, toxic int"), k=5).collect()
    teach = {}
    for i, y in labels:
        if y in (0, 1) and i != 9999:
            teach[i] = max(y, teach.get(i, 0))
    texts = {i: min(t or "" for j, t in docs if j == i) for i in teach}

    def terms(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c if c.isalnum() or ord(c) >= 128 else " " for c in text or "")
        out = {}
        for w in low.split():
            out[w, 0] = out.get((w, 0), 0) + 1
            if len(w) >= 4:
                out[w[:4], 1] = out.get((w[:4], 1), 0) + 1
        return out

    held = {i: terms(texts[i]) for i in teach}
    known = {t for h in held.values() for t in h}
    every = [set(terms(t)) & known for _, t in docs]
    n_marked = sum(teach.values())
    weight = {}
    for t in known:
        df, h, m = sum(t in e for e in every), sum(t in x for x in held.values()), sum(t in held[i] for i in teach if teach[i])
        a, b, c, d = m + 0.5, h - m + 0.5, n_marked - m + 0.5, len(teach) - n_marked - h + m + 0.5
        weight[t] = (np.log((1 + len(docs)) / (1 + df)) + 1) * np.log(a * d / (b * c)) ** 2 / (1 / a + 1 / b + 1 / c + 1 / d)

    def vector(counts):
        v = {t: (1 + np.log(n)) * weight[t] for t, n in counts.items() if t in known}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else {}

    vectors, rate = {i: vector(h) for i, h in held.items()}, n_marked / len(teach)
    empty = [teach[i] for i in teach if not vectors[i]]
    want = []
    for i, text in docs:
        v = vector(terms(text))
        near = sorted((-round(sum(x * u.get(t, 0) for t, x in v.items()), 10), j) for j, u in vectors.items())[:5]
        near = [(j, -c) for c, j in near if c < 0]
        votes = [(1 / (0.05 + max(1 - c, 0)), teach[j]) for j, c in near]
        score = (sum(w * y for w, y in votes) + rate) / (sum(w for w, _ in votes) + 1) if v else (sum(empty) + rate) / (len(empty) + 1)
        want.append((i, text, score, near))
    assert len(rows) == len(want)
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    for got, (i, s, near) in zip(sorted(((r.doc_id, r.score, [(x.doc_id, x.cosine) for x in r.neighbours]) for r in rows), key=order), sorted(((i, s, near) for i, _, s, near in want), key=order), strict=True):
        assert got[0] == i and abs(got[1] - s) < 1e-6 and [round(c, 6) for _, c in got[2]] == [round(c, 6) for _, c in near], (got, i, s, near)


def test_sample_is_of_labelled_documents(make):
    docs = make([(i, "t") for i in range(100)], "doc_id long, text string")
    labels = make([(5, 1)] * 50 + [(i, 0) for i in range(20, 70)] + [(i, 1) for i in range(200, 400)], "doc_id long, toxic int")
    got = [r.doc_id for r in toxicity.sampled_labels(labels, docs, 40, "toxic", "doc_id").collect()]
    assert len(got) == len(set(got)) == 40 and all(i < 100 for i in got)


def test_toxicity_recall_of_each_language(spark):
    docs, labels = table(spark, SF_LARGER, "documents"), table(spark, SF_LARGER, "labels")
    judged = toxicity.judge_toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = [r for r in judged.select("lang", "toxic", "held_out", "predicted").collect() if r.held_out]
    marked = {lang: [r.predicted for r in rows if r.toxic and r.lang == lang] for lang in {r.lang for r in rows}}
    assert all(np.mean(p) >= 0.9 for p in marked.values() if len(p) >= 10), {k: np.mean(p) for k, p in marked.items() if p}
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.05


def test_learned_scores_odd_rows(spark, make, odd, none):
    labels = make([(i, i % 2, i % 2) for i in range(1, 9)] + [(3, None, None), (None, 1, 1), (50, 0, 0)], "doc_id long, toxic int, quality int")
    for judge in (toxicity.judge_toxicity, ql.judge_quality):
        rows = judge(odd, labels).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert judge(none, labels).count() == 0
        assert judge(odd, labels.where("false")).count() == odd.count()


def test_quality_held_out(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    rows = ql.judge_quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert len(_split(rows, 5, 0)) == len(rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.85


def test_quality_blocks_score_like_single_texts():
    random = np.random.default_rng(1)
    weights = random.normal(size=1 << ql.BUCKET_BITS).astype(np.float32)
    texts = [None, "", "a", "ab", "abc", "ab cd", "x x x", " é  ü ", "word " * 500]
    for text, score in zip(texts, ql.score_texts(texts, weights, 0.25), strict=True):
        bucket, n = ql.bag(text)
        want = 0.25 + float((weights[bucket] * n).sum()) / max(1, int(n.sum()))
        assert np.isclose(score, 1 / (1 + np.exp(-want)), atol=1e-6)
    (_, _, again), (_, _, other) = ql.features(b"foo foo")[-1], ql.features(b"bar bar")[-1]
    assert list(again) == list(other)


# --- 9: sharding


def test_shards(spark, odd, none):
    docs = table(spark, SF_SMALL, "documents").unionByName(odd.select("doc_id", "text"), allowMissingColumns=True)
    rows = sharding.shard_by_bytes(docs).collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    total, before, slots = sum(w[2] for w in want), 0, {}
    expected = []
    for known, i, size, crc in want:
        shard = before * 24 // total
        slots[shard] = slots.get(shard, -1) + 1
        expected.append((known, i, size, crc, shard, slots[shard]))
        before += size
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32, r.shard, r.slot) for r in rows) == sorted(expected)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert sharding.shard_by_bytes(none).count() == 0


def test_prefix_sums_split_a_hot_key(spark, make):
    rows = make([(7, 1)] * 500 + [(i, 2) for i in range(20)], "k long, v long")
    got = sorted((r.number, r.before, r.k) for r in prefix_sums(rows, ["k"], "v").collect())
    assert [g[0] for g in got] == list(range(520)) and [g[2] for g in got] == sorted(g[2] for g in got)
    assert got[-1][1] == 500 + 38


# --- 10: top-k


def _top(rows, queries, k):
    out = []
    for q, v in {(q, tuple(v)) for q, v in queries}:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_topk_brute_force(spark, make):
    random.seed(2)
    rows = [(i, [random.choice([0.0, 0.0, 0.01, -0.02, 0.5]) for _ in range(random.choice([6, 6, 4]))]) for i in range(300)]
    rows += [(400, None), (401, [None, 1.0]), (402, [float("nan"), 1.0]), (403, [float("inf")]), (404, []), (20, rows[20][1]), (7, rows[7][1])]
    usable = [(i, [int(np.floor(x * 256)) for x in np.array(v, np.float32).astype(float)]) for i, v in rows if v is not None and None not in v and all(np.isfinite(v))]
    frame = tk.quantise(make([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, q string"))
    assert sorted((r.vec_id, tuple(r.q)) for r in frame.collect()) == sorted((i, tuple(v)) for i, v in usable)
    queries = [x for x in usable if x[0] % 20 == 0]
    want = _top(usable, queries, 5)
    for sizes in ({}, {"query_block": 3, "candidate_block": 16, "least_blocks": 1}):
        got = sorted(tuple(r) for r in tk.top_k(frame, frame.where("vec_id % 20 = 0"), **sizes).collect())
        assert got == want
    few = frame.where("vec_id in (0, 1, 2)")
    assert sorted(tuple(r) for r in tk.top_k(few, few).collect()) == _top([x for x in usable if x[0] < 3], [x for x in usable if x[0] < 3], 5)
    assert tk.top_k(frame.where("false"), few).count() == 0 and tk.top_k(few, few.where("false")).count() == 0


# --- pipeline


def test_pipeline_stages(spark, make):
    import corpus_pipeline as cp

    line = " ".join(f"w{i}" for i in range(60))
    docs = make(
        [(1, f"one\n{line}", "en", "s", 5), (2, f"two\n{line}", "en", "s", 5), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "same text", "en", "s", 9),
         (5, "same text", "en", "s", 9), (6, "Same  text", "en", "s", 9), (7, "before " + " ".join(f"b{i}" for i in range(12)), "en", "s", 1), (None, "odd", "en", "s", 3)],
        "doc_id long, text string, lang string, source string, n_chars long")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    make([(0, " ".join(f"B{i}" for i in range(12)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    clean = cp.drop_contaminated(spark, docs, folder)
    assert clean.columns == list(cp.COLUMNS) and clean.count() == docs.count() - 1 and not clean.where("doc_id = 7").count()
    deduped = cp.dedup_lines(spark, docs, folder)
    assert deduped.columns == list(cp.COLUMNS) and {r.doc_id: r.text for r in deduped.collect() if r.doc_id in (1, 2)} == {1: f"one\n{line}", 2: "two"}
    near = cp.drop_near_duplicates(spark, docs, folder)
    ids = sorted((r.doc_id or 0) for r in near.collect())
    assert ids.count(5) == 1 and 6 not in ids and (3 in ids) != (4 in ids)
    assert cp.encode(spark, docs, folder).count() == docs.count()
    assert [n for n, _ in cp.STAGES][2].startswith("simhash") and len(cp.STAGES) == 5


def test_pipeline_runs(spark):
    import corpus_pipeline as cp

    docs = table(spark, SF_SMALL, "documents")
    out = cp.run(spark, SF_SMALL)
    assert 0 < out.count() <= docs.count() and out.select("doc_id").distinct().count() == out.count()


def test_held_out(spark):
    got = {r.i: r.h for r in spark.range(50).select(F.col("id").alias("i"), held_out(F.col("id"), 4, 2).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}
