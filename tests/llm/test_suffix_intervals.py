"""Substring removal against brute force."""

import hashlib

import numpy as np
import pytest

from orderstar.llm import suffix_intervals as S


def brute(rows, length):
    docs = sorted((i, (t or "").encode()) for i, t in rows)
    seen, out = set(), {}
    for i, b in docs:
        cover = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                cover[p : p + length] = True
            seen.add(w)
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = int(np.sum(np.diff(np.concatenate(([0], cover.astype(int)))) == 1))
        out[i] = (len(b), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    r = np.random.default_rng(seed)
    vocab = ["la", "ber", "ción", "the", "ß", "onz", "tr", "x"]
    make = lambda n: " ".join("".join(r.choice(vocab, r.integers(1, 4))) for _ in range(n))
    shared = [make(30) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "a" * 700), (3, "ab" * 300), (4, make(5))]
    for i in range(5, 60):
        t = make(int(r.integers(5, 60)))
        for _ in range(int(r.integers(0, 3))):
            t += make(int(r.integers(0, 3))) + shared[r.integers(0, 4)] + make(3)
        if i % 7 == 0:
            t = rows[-1][1] or t
        if i % 7 == 1:
            u = list(rows[-1][1] or t)
            u[len(u) // 2] = "#"
            t = "".join(u)
        rows.append((i, t))
    return rows


@pytest.mark.parametrize("seed,dense", [(1, 2000), (2, 3)])
def test_remove_repeats_matches_brute_force(spark, seed, dense):
    rows = corpus(seed)
    docs = spark.createDataFrame([(t, i, "x", 7) for i, t in rows], "text string, doc_id long, id string, g int").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in S.remove_repeats(docs, dense=dense).collect()}
    assert got == brute(rows, 100)


def test_empty_table(spark):
    assert S.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_interval_tree_reports_nested_groups():
    # AAAA+x, AAAA+y twice, each with a different byte before: depth 4 holds three, depth 5 two of them
    text = [b"1AAAAx", b"2AAAAyz", b"3AAAAyw"]
    offsets = np.cumsum([0, *map(len, text)])
    groups = S.suffix_groups(np.frombuffer(b"".join(text), np.uint8), offsets, 4)
    assert sorted((d, len(m)) for d, m in groups) == [(4, 3), (5, 2)]


@pytest.mark.parametrize("dense", [2000, 1])
def test_texts_under_one_id_are_documents(spark, dense):
    r = np.random.default_rng(4)
    make = lambda n: "".join(r.choice(list("abcdefgh"), n))
    shared = make(150)
    texts = [make(20) + shared + make(30), make(400) + shared + make(700), shared[10:140] + make(5)]
    for i in (None, 7):
        docs = spark.createDataFrame([(i, t) for t in texts], "doc_id long, text string").repartition(3)
        got = S.remove_repeats(docs, dense=dense).collect()
        # one occurrence stays whole, nothing that occurs once goes
        assert {x.doc_id for x in got} == {i} and sorted(x.n_bytes for x in got) == sorted(map(len, texts))
        for x in got:
            text = next(t for t in texts if len(t) == x.n_bytes)
            rest = text.replace(shared, "").replace(shared[10:140], "")
            kept = x.kept.decode()
            assert kept == text or kept.replace(shared[:10], "").replace(shared[140:], "") == rest
        assert any(x.n_removed == 0 for x in got) and sum(x.n_removed for x in got) >= 260


def test_no_id_is_not_the_smallest_id(spark):
    """A real id of -2**63 stays itself, beside a document without one that has the same text."""
    text = "".join(f"{i * 7919 % 1000:03d}" for i in range(60))
    rows = [(None, text), (-(1 << 63), text), (-(1 << 63), "short"), (3, "q" + text)]
    from orderstar.llm import suffix_intervals

    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_intervals.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert [(a, b, c) for a, b, c, _ in got] == [(False, -(1 << 63), 5), (False, -(1 << 63), 180), (False, 3, 181), (True, 0, 180)]
    removed = {(a, b, c): d for a, b, c, d in got}
    assert removed[False, 3, 181] == 180 and removed[False, -(1 << 63), 180] + removed[True, 0, 180] == 180
