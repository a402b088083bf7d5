"""Packing: pieces equal the library's, sequences are gapless and within every capacity, the plan equals a one-by-one best fit."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderstar.llm import vector_packing as P
from orderstar.llm.token_files import Encoder
from tests.llm.test_token_files import ODD, PATH, Counted, sample, whole


def one_by_one(lengths, tokens, documents, cost, weights, rule):
    """Best fit of single pieces, longest first; a sequence goes on taking equal pieces, as the score of a class does not change its order."""
    cap = (tokens, documents or tokens, cost or tokens * tokens)
    bins = []
    for length in sorted(lengths, reverse=True):
        item = (length, 1, length * length)
        best = None
        for b, left in enumerate(bins):
            if all(a >= i for a, i in zip(left, item)):
                if rule == "dot":
                    score = sum(w * i / c * a / c for w, i, a, c in zip(weights, item, left, cap))
                else:
                    score = sum(w * ((a - i) / c) ** 2 for w, i, a, c in zip(weights, item, left, cap))
                if best is None or score < best[0] - 1e-15:
                    best = (score, b)
        if best is None:
            bins.append([c - i for c, i in zip(cap, item)])
        else:
            bins[best[1]] = [a - i for a, i in zip(bins[best[1]], item)]
    return bins


def expand(rows):
    bins = defaultdict(list)
    for length, begin, end, first, each, used in rows:
        for k in range(end - begin):
            bins[first + k // each].append((used + k % each * length, length))
    return bins


def check(bins, tokens, documents=None, cost=None):
    assert sorted(bins) == list(range(len(bins)))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= tokens and len(places) <= (documents or tokens) and sum(n * n for _, n in places) <= (cost or tokens * tokens)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(None, None), (5, None), (None, 3000), (7, 2000)])
def test_plan_equals_one_by_one(rule, limits):
    rng = random.Random(hash((rule, limits)) % 1000)
    for trial in range(6):
        lengths = [min(44, int(rng.paretovariate(0.8))) for _ in range(rng.randint(1, 400))]
        bins = expand(P.plan(Counter(lengths), 64, *limits, rule=rule))
        check(bins, 64, *limits)
        assert Counter(n for places in bins.values() for _, n in places) == Counter(lengths)
        want = one_by_one(lengths, 64, *limits, P.WEIGHTS, rule)
        assert abs(len(bins) - len(want)) <= max(1, len(want) // 50)
    with pytest.raises(ValueError):
        P.plan({60: 1}, 64, None, 3000)


def test_plan_is_near_the_bound_at_any_count():
    """The same shape of a corpus 1 and 100,000 times: as few sequences as the tokens need, but for one in a hundred, from few plan rows."""
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 20000).astype(int) + 1, 4096)
    once = Counter(lengths.tolist())
    for times in (1, 100_000):
        rows = P.plan({k: v * times for k, v in once.items()})
        used = max(first + -(-(end - begin) // each) for _, begin, end, first, each, _ in rows)
        assert used <= 1.01 * -(-sum(k * v * times for k, v in once.items()) // 4096) + 1
        assert len(rows) < 20_000


def test_pieces_and_sequences(spark):
    texts = ODD + sample(spark) + ["long text of many words " * 4000] + ["copy of one"] * 300
    docs = spark.createDataFrame([(t, 3 * i % 500 if i % 50 else None, "z", "y") for i, t in enumerate(texts)], "text string, doc_id long, start string, part string").repartition(6)
    found = P.pieces(docs, PATH, keep_ids=True)
    placed = P.pack(found)
    rows = placed.collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    check(bins, 4096)
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 4096) * 1.02 + 1
    got = Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows)
    want = Counter()
    for i, ids in enumerate(whole(texts)):
        for a in range(0, len(ids), 4096):
            want[3 * i % 500 if i % 50 else None, a // 4096, a, len(ids[a : a + 4096]), np.array(ids[a : a + 4096], "<u4").tobytes()] += 1
    assert got == want
    packed = {r.sequence_id: r for r in P.sequences(placed).collect()}
    assert sorted(packed) == sorted(bins)
    assert all(r.n_tokens == len(r.ids) // 4 == sum(p.length for p in r.pieces) for r in packed.values())
    one = next(r for r in rows if r.offset > 0)
    assert packed[one.sequence_id].ids[4 * one.offset : 4 * (one.offset + one.length)] == one.ids
    plain = P.digest(docs, PATH)
    assert plain.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and plain.count() == len(rows)


def test_pieces_send_letters_to_the_model(monkeypatch):
    """Only pieces with other characters than letters take the tokenizer's whole way; ids and crc stay the library's."""
    import pyarrow as pa
    from types import SimpleNamespace

    enc = Encoder(PATH)
    enc.tokenizer = Counted(enc.tokenizer)
    monkeypatch.setattr(P, "encoder", lambda path: enc)
    monkeypatch.setattr(P, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["plain words of été 東京", "x1 and it's", None, "q " * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array([4, 4, None, 1], pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    (out,) = P._pieces(PATH, 1, 4096, True)(iter([batch]))
    want = [(d, ids[a : a + 4096]) for d, ids in zip([4, 4, None, 1], whole(texts)) for a in range(0, len(ids), 4096)]
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in out.to_pylist()]
    assert got == want and [zlib.crc32(r["ids"]) for r in out.to_pylist()] == out.column("ids_crc32").to_pylist()
    assert {*enc.tokenizer.seen} == {"x1", "it's"}


def test_empty(spark):
    assert P.digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
