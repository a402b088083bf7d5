"""Segment scan against brute force, scores against the definition, held-out accuracy."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderstar.llm import toxicity as T
from orderstar.llm.textops import flat


def brute_segments(score):
    """Maximal segments by the recursive definition: the best segment, then both sides."""
    if not len(score) or max(score) <= 0:
        return []
    total = np.concatenate(([0.0], np.cumsum(score)))
    best = max(((round(total[j] - total[i], 9), -(j - i), -i) for i in range(len(score)) for j in range(i + 1, len(score) + 1)))
    value, n, i = best
    i, n = -i, -n
    left, right = brute_segments(score[:i]), brute_segments(score[i + n :])
    return [*left, (value, i, i + n), *((s, a + i + n, b + i + n) for s, a, b in right)]


def test_segments_match_the_definition():
    r = np.random.default_rng(2)
    for _ in range(150):
        score = r.choice([-3.25, -1.125, -0.5, 0.75, 2.0, 3.5], int(r.integers(1, 30))) + r.normal(0, 1e-3, 1)
        got = [(round(s, 9), a, b) for s, a, b in T.segments(score)]
        want = brute_segments(list(score))
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want] and np.allclose([s for s, *_ in got], [s for s, *_ in want])


def test_features_fold_case_and_edges():
    data, offsets = flat(pa.array(["Ärger, (ärger) ÄRGER!!", "été", None]))
    _, _, first, f, _ = T.features(data, offsets)
    assert first.tolist() == [0, 3, 4, 4] and (f[:, 0] == f[:, 1]).all() and (f[:, 0] == f[:, 2]).all() and f[1, 3] == 0


def corpus(spark, n=900):
    r = np.random.default_rng(6)
    vocab = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "se", "vo") for c in ("n", "s", "l", "")]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = list(r.choice(vocab, int(r.integers(15, 60))))
        if toxic:
            at = int(r.integers(0, len(words)))
            words[at:at] = [f"{r.choice(['grumpf', 'blorkig'])}{r.choice(vocab)}", "Scummy!"][: int(r.integers(1, 3))]
        rows.append((i, " ".join(words), "x"))
        if i % 4:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = T.digest(docs, labels).collect()
    assert len(got) == 900 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 5 == 0) for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.fit(docs, labels), T.fit(docs, flipped)
    assert a.curve == b.curve and np.array_equal(a.keys, b.keys) and np.array_equal(a.weights, b.weights)


def test_odd_inputs(spark):
    docs, labels = corpus(spark)
    model = T.fit(docs, labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "  \n"), (None, "scummy grumpfkaran"), (4, "kara " * 50000), (4, "kara " * 50000)], "doc_id long, text string")
    got = {(r.doc_id, r.n_segments): r for r in T.scores(odd, model).collect()}
    assert got[1, 0].score == got[2, 0].score == got[3, 0].score < 0.3 and not got[None, max(k[1] for k in got if k[0] is None)].held_out
    assert T.keep_clean(odd, model).count() == 5 and T.keep_clean(odd, model).columns == odd.columns
    assert T.toxic_segments(odd, model).where("doc_id is null").count() >= 1
    none = T.fit(docs, labels.where("toxic = 0"))
    assert all(r.score < 1e-6 and r.predicted == 0 for r in T.scores(odd, none).collect())
    assert T.digest(docs.limit(0), labels.limit(0)).count() == 0
