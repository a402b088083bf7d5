"""Jaccard join against all pairs."""

import re

import numpy as np
import pyarrow as pa
import pytest

from orderstar.llm import jaccard_join as J


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                s = len(sets[a] & sets[b])
                if 100 * s >= 80 * (len(sets[a]) + len(sets[b]) - s):
                    x, y = sorted((top(a), top(b)))
                    up[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus(seed):
    r = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "One two"), (4, "oNE  two"), (5, "two one"), (6, "x " * 50), (7, "X " * 900)]
    passage = " ".join(r.choice(vocab, 40))
    base = [" ".join(r.choice(vocab, int(r.integers(12, 90)))) for _ in range(25)] + [passage + " " + " ".join(r.choice(vocab, k)) for k in (2, 3, 6, 9, 12, 15)]
    for i in range(8, 260):
        w = base[int(r.integers(0, len(base)))].split()
        for _ in range(int(r.integers(0, 4))):
            w[int(r.integers(0, len(w)))] = str(r.choice(vocab))
        if r.random() < 0.3:
            w = w[: len(w) - int(r.integers(0, 8))]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,frequent", [(1, (50, 1000)), (3, (4, 60))])
def test_components_match_all_pairs(spark, seed, frequent):
    rows = corpus(seed)
    docs = spark.createDataFrame([(t, i, 1, "k") for i, t in rows], "text string, doc_id long, node int, key string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_classes(docs, frequent_from=frequent[0], frequent_most=frequent[1]).collect()}
    assert got == brute(rows)


def test_sketches_bound_the_symmetric_difference():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 1 << 62, int(n), dtype=np.uint64)) for n in (1, 30, 200, 300, 900, 5000)]
    sets += [np.union1d(s, s[:10] + np.uint64(1)) for s in sets]
    pairs = [(a, b) for a in sets for b in sets]
    got = J.differences([J.parity(a) for a, _ in pairs], [J.parity(b) for _, b in pairs])
    real = np.array([len(np.setxor1d(a, b)) for a, b in pairs])
    assert (got <= real).all() and (got[real == 0] == 0).all()
    x, y = (r.integers(0, 1 << 62, 5000, dtype=np.uint64) for _ in range(2))
    assert J.differences([J.parity(x)], [J.parity(y)])[0] > 3000


def test_empty_and_repeated_rows(spark):
    assert J.similar_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (9, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in J.similar_classes(docs).collect()) == [(0, 2, 7), (7, 2, 7), (7, 2, 7), (9, 0, 9)]


def test_rows_that_share_an_id_do_not_multiply(spark, monkeypatch):
    """Near copies without an id, and under one id: every handed-on set and link is there once."""
    r = np.random.default_rng(2)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(150):
        w = list(base)
        w[-1] = f"x{r.integers(0, 10**9)}"
        texts.append(" ".join(w))
    other = " ".join(f"y{i}" for i in range(30))
    rows = [(None, t) for t in texts] + [(5, t) for t in texts[:40]] + [(5, other)]
    held, real = {}, J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: held.setdefault(name, real(df, name)))
    monkeypatch.setattr(J, "discard", lambda *tables: None)
    found = J.similar_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    nodes = held["op5-nodes"].count()
    for name, df in held.items():
        if name.endswith(("-sets", "-wanted")):
            assert df.count() <= nodes
            assert df.select(df.columns[0], *df.columns[1:2]).distinct().count() == df.count(), name
        if name.endswith("-links"):
            assert df.count() <= nodes * 4, name
    assert {x.component_id for x in found if x.n_shingles > 30} == {5}
    assert len({x.component for x in found}) == 2 and len(found) == len(rows)


def test_only_copies_go(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, a + " more"), (None, a), (4, None), (5, ""), (5, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {(r.doc_id, r.h) for r in J.copies(docs).collect()}
    h = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    assert gone == {(2, h[a]), (3, h[a + " more"]), (5, h[b])}


def test_keys_of_the_same_nodes_are_one_group(spark, monkeypatch):
    """Near copies share many keys; the pairs these name are compared once."""
    r = np.random.default_rng(6)
    rows = []
    for c in range(12):
        base = [f"c{c}w{i}" for i in range(120)]
        for k in range(1 + c % 4):
            at = int(r.integers(0, 120))
            rows.append((len(rows), " ".join([*base[:at], f"x{c}y{k}", *base[at + 1 :]])))
    held, real = {}, J.stage
    monkeypatch.setattr(J, "stage", lambda df, name: held.setdefault(name, real(df, name)))
    monkeypatch.setattr(J, "discard", lambda *tables: None)
    found = J.similar_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    groups = {}
    for x in held["op5-index"].collect():
        groups.setdefault(x.key, set()).add(x.node)
    assert groups and len(set(map(frozenset, groups.values()))) == len(groups)
    shared = held["op5-keys"].agg({"key": "count", "c": "sum"}).first()
    kept = held["op5-index"].select("key", "c", "times").distinct().agg({"times": "sum", "c": "sum"}).first()
    assert sorted(shared) == sorted(kept) and kept["sum(times)"] > 2 * len(groups)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found} == brute(rows)


def test_sets_and_keys_of_a_slice_are_those_of_each_text():
    texts = [t for _, t in corpus(5)]
    data, offsets = J.flat(pa.array(texts, pa.string()))
    tokens, bounds = J.token_sets(data, offsets, 5)
    alone = [J.token_sets(*J.flat(pa.array([t], pa.string())), 5)[0] for t in texts]
    assert [len(x) for x in alone] == [n for _, (n, _) in sorted(brute(list(enumerate(texts))).items())]
    assert np.array_equal(tokens, np.concatenate(alone)) and np.array_equal(np.diff(bounds), [len(x) for x in alone])
    assert all((np.diff(x.astype(object)) > 0).all() for x in alone)
    token, n = np.unique(tokens, return_counts=True)
    for frequent in (token[:0], token[n >= 20], token[n >= 2]):
        key, at = J.index_keys(tokens, bounds, frequent, 80)
        for i, x in enumerate(alone):
            assert np.array_equal(key[at == i], J.prefix_keys(x, frequent, 80))
