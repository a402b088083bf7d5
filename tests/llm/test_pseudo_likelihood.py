"""Pseudo-likelihood against plain counting, and held-out perplexity."""

import math
import re
from collections import Counter

import numpy as np

from orderstar.llm import pseudo_likelihood as L
from orderstar.llm.textops import flat

import pyarrow as pa


def test_scores_sum_the_models_conditionals(spark):
    texts = [None, "", "one", "The cat sat on the mat. " * 20, "über ß x", "a " * 3000]
    docs = spark.createDataFrame([(t, i, 2) for i, t in enumerate(texts)], "text string, doc_id long, n_words int")
    model = L.fit(docs)
    got = {r.doc_id: r for r in L.scores(docs, model).collect()}
    for i, t in enumerate(texts):
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or "")
        ws = re.findall(r"[^\x20\x09-\x0D]+", low)
        one = [[int(x[0]) for x in L.buckets(*flat(pa.array([w])))[:2]] for w in ws]
        c = [int(model.own[b]) if model.own[b] >= 0 else L.OWN + t for b, t in one]
        edge = [L.CLASSES, *c, L.CLASSES]
        want = sum(float(model.log_class[edge[k], edge[k + 2], c[k]]) + float(model.log_word[one[k][0]]) for k in range(len(c)))
        assert got[i].n_words == len(ws) and abs(got[i].log_likelihood - want) < 1e-3 * (1 + abs(want))
    assert got[0].mean_log_prob is None and got[1].pseudo_perplexity is None


def test_network_learns_both_sides():
    r = np.random.default_rng(0)
    counts = np.zeros((9, 9, 8), np.int64)
    for _ in range(40000):
        a, b = r.integers(0, 8, 2)
        counts[a, b, (a + b) % 8 if r.random() < 0.8 else r.integers(0, 8)] += 1
    p = np.exp(L.train(counts, width=24, steps=600))
    assert np.allclose(p.sum(axis=2), 1) and np.mean([p[a, b, (a + b) % 8] for a in range(8) for b in range(8)]) > 0.6


def test_held_out_perplexity_beats_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = L.fit(docs.where("doc_id % 4 > 0"))
    held = L.scores(docs.where("doc_id % 4 = 0"), model).agg({"log_likelihood": "sum", "n_words": "sum"}).first()
    total = model.log_class[:, :, :]
    flatter = L.Model(model.own, model.log_word, np.broadcast_to(np.log(np.exp(total).mean(axis=(0, 1))), total.shape))
    base = L.scores(docs.where("doc_id % 4 = 0"), flatter).agg({"log_likelihood": "sum"}).first()
    assert math.exp(-held["sum(log_likelihood)"] / held["sum(n_words)"]) < 0.9 * math.exp(-base["sum(log_likelihood)"] / held["sum(n_words)"])


def test_empty_table(spark):
    assert L.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def _words(text):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def _class_and_bucket(model, w):
    b, tail = (int(x[0]) for x in L.buckets(*flat(pa.array([w])))[:2])
    return (int(model.own[b]) if model.own[b] >= 0 else L.OWN + tail), b


def _brute_force(model, docs, corpus, own):
    """Log-likelihoods by dictionaries of the words themselves; ``own``: the documents are the corpus."""
    seen, events = Counter(), lambda ws: [(kind, *k) for i in range(len(ws) - 4) for kind, k in _keys(ws, i + 2).items() if kind in "wcm"] + [
        (kind, ws[i], ws[i + far]) for kind, far in (("n", 1), ("s", 2)) for i in range(len(ws) - far) if ws[i] or ws[i + far]
    ]
    pad = lambda t: [None, None, *_words(t), None, None]
    edges = [0, 0, 0]
    for t in corpus:
        seen.update(events(pad(t)))
        edges[1] += len(_words(t)) > 0
        edges[2] += (len(_words(t)) > 0) + (len(_words(t)) > 1)
    total, distinct = Counter(), Counter()
    for k, n in seen.items():
        if k[0] == "w":
            c = _class_and_bucket(model, k[1])[0]
            total[c] += n
            distinct[c] += 1
    out = []
    for t in docs:
        ws, score = pad(t), 0.0
        for i in range(2, len(ws) - 2):
            n = {k: seen[k, *v] - own for k, v in _keys(ws, i).items()}
            c, b = _class_and_bucket(model, ws[i])
            share = math.exp(float(model.log_word[b]))
            rest = total[c] - own
            inside = share if not rest else (n["w"] - L.DISCOUNT) / rest if n["w"] else L.DISCOUNT * (distinct[c] - own) * share / rest
            l, r = (L.CLASSES if x is None else _class_and_bucket(model, x)[0] for x in (ws[i - 1], ws[i + 1]))
            p0, near = math.exp(float(model.log_class[l, r, c])) * inside, 0.0
            for share, step in zip(L.SIDES, (-1, -2, 1, 2)):
                pair = ("ns"[abs(step) - 1], *((ws[i + step], ws[i]) if step < 0 else (ws[i], ws[i + step])))
                given = edges[abs(step)] if ws[i + step] is None else seen["w", ws[i + step]]
                near += share * (seen[pair] - own + L.PAIR * p0) / (given - own + L.PAIR)
            score += math.log((n["m"] + L.BOTH * near) / (n["c"] + L.BOTH))
        out.append(score)
    return out


def _keys(ws, i):
    return {"w": (ws[i],), "c": (ws[i - 1], ws[i + 1]), "m": (ws[i - 1], ws[i], ws[i + 1])}


def _random_texts(n, seed):
    r = np.random.default_rng(seed)
    return [" ".join(f"w{int(x)}" for x in r.zipf(1.4, r.integers(0, 30)) % 60) for _ in range(n)]


def test_every_word_is_scored_by_the_rest_of_the_corpus(spark):
    texts = [None, "", "one", "two words", "a a a a", "The cat sat on the mat. " * 20, "Über ß x", *_random_texts(60, 3)]
    texts += texts[-3:]  # repeated rows count
    docs = spark.createDataFrame([(t, None if i % 7 == 6 else i, 2) for i, t in enumerate(texts)], "text string, doc_id long, n_words int").repartition(3)
    got = L.digest(docs).collect()
    want = _brute_force(L.fit(docs), texts, texts, 1)
    assert got[0].asDict().keys() == {"doc_id", "n_words", "log_likelihood", "mean_log_prob", "pseudo_perplexity"}
    some = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, (t, w) in enumerate(zip(texts, want)):
        if i % 7 != 6:
            assert some[i].n_words == len(_words(t)) and abs(some[i].log_likelihood - w) < 1e-6 * (1 + abs(w))
    lost = sorted(w for i, w in enumerate(want) if i % 7 == 6)
    assert np.allclose(sorted(r.log_likelihood for r in got if r.doc_id is None), lost)
    assert some[0].mean_log_prob is None and some[1].pseudo_perplexity is None


def test_counts_meet_over_blocks(monkeypatch):
    """The same scores whether documents share a block or not, and for documents outside the corpus."""
    class Held:
        def __init__(self, value):
            self.value = value

    texts, others = _random_texts(40, 5), _random_texts(10, 6)
    r = np.random.default_rng(1)
    own = np.full(L.BUCKETS, -1, np.int8)
    own[[_class_and_bucket(L.Model(own, None, None), f"w{i}")[1] for i in range(1, 4)]] = range(3)
    model = L.Model(own, np.log(r.random(L.BUCKETS)).astype(np.float32), np.log(r.dirichlet(np.ones(L.CLASSES), (L.CLASSES + 1, L.CLASSES + 1))).astype(np.float32))
    monkeypatch.setattr(L, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("P", (), {"partitionId": lambda self: 0})())}))
    for size in (1, 300, 1 << 22):
        monkeypatch.setattr(L, "BLOCK_BYTES", size)
        batch = lambda ts: iter([pa.record_batch({"doc_id": pa.array([k], pa.int64()), "text": pa.array([t])}) for k, t in enumerate(ts)])
        inside = [{**row, "counted": True, "asks": True} for b in L._blocks(Held(model), 1)(batch(texts)) for row in b.to_pylist()]
        outside = [{**row, "counted": False, "asks": True} for b in L._blocks(Held(model), -1)(batch(others)) for row in b.to_pylist()]
        assert len({r["block"] for r in inside + outside}) == len(inside + outside)
        schema = pa.schema([*next(L._blocks(Held(model), 1)(batch(["x"]))).schema, ("counted", pa.bool_()), ("asks", pa.bool_())])
        found, distinct, total = [], 0, 0
        for kind in range(5):
            rows = [pa.RecordBatch.from_pylist([row], schema=schema) for row in inside + outside]
            events = pa.Table.from_batches(list(L._events(kind, 4)(iter(rows))))
            for part in range(4):
                mine = events.filter(pa.array([p == part for p in events["part"].to_pylist()]))
                for row in L._sums(kind)(mine).to_pylist():
                    if row["block"] is None:
                        distinct, total = distinct + np.frombuffer(row["differs"], np.int64), total + np.frombuffer(row["total"], np.int64)
                    else:
                        found.append(row)
        n = [len(_words(t)) for t in texts]
        corpus = L.Corpus(model, distinct, total, (sum(x > 0 for x in n), sum(x > 0 for x in n) + sum(x > 1 for x in n)))
        for rows, some, is_own in ((inside, texts, 1), (outside, others, 0)):
            got = []
            for row in rows:
                out = L._scored(Held(corpus))(pa.Table.from_pylist([row]), pa.Table.from_pylist([f for f in found if f["block"] == row["block"]]))
                got += out["log_likelihood"].to_pylist()
            assert np.allclose(got, _brute_force(model, some, texts, is_own))


def test_a_swapped_word_changes_its_neighbours(spark):
    """Two words of one ending class, once each, were the same to their neighbours before."""
    base = [f"{x} red kalo {y}" for x in ("a", "b") for y in ("c", "d") for _ in range(20)] + ["filler words of other texts " * 3] * 30
    docs = lambda w: spark.createDataFrame([(i, t) for i, t in enumerate([*base, f"a red {w} c", "q zalo w"])], "doc_id long, text string")
    near, far = (next(r for r in L.digest(docs(w)).collect() if r.doc_id == len(base)) for w in ("kalo", "zalo"))
    assert near.log_likelihood > far.log_likelihood + 2


def test_repeated_documents_stand_out(spark):
    texts = [" ".join(f"x{int(v)}" for v in np.random.default_rng(i).integers(0, 400, 40)) for i in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:8]])], "doc_id long, text string")
    mean = {r.doc_id: r.mean_log_prob for r in L.digest(docs).collect()}
    assert min(mean[i] for i in (*range(8), *range(80, 88))) > max(mean[i] for i in range(8, 80)) + 1


def test_held_out_perplexity_is_under_that_of_classes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    corpus, rest = docs.where("doc_id % 4 > 0"), docs.where("doc_id % 4 = 0")
    model = L.fit(corpus)
    before, now = (x.agg({"log_likelihood": "sum"}).first()[0] for x in (L.scores(rest, model), L.likelihoods(rest, model, corpus)))
    n = L.scores(rest, model).agg({"n_words": "sum"}).first()[0]
    assert math.exp(-now / n) < 0.5 * math.exp(-before / n)
