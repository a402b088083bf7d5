"""Toxicity by maximum-scoring segments.

*Model.* Labelled documents give log-odds for words and for word beginnings of 4 to 7 characters, with an
informative Dirichlet prior; near copies count once, and a feature counts where its surplus is far from chance. A word
scores the largest of its features' log-odds less a standard error, every other word scores ``-GAP``. The background distribution
of word scores in clean documents gives the extreme-value parameters: ``lam`` solves ``E[exp(lam * s)] = 1`` and
``K`` is matched to the best segments of clean documents.

*Scoring.* A linear scan (Ruzzo and Tompa) finds all maximal-scoring segments of a text; a segment of score S in a
text of n words has the normalised score ``lam * S - ln(K n)``, positive where less than one such segment
is expected by chance. A logistic curve, fitted on labelled documents that the lexicon did not see, turns the
best segment and the sum of the significant ones into a probability.

The model is fitted on at most ``fit_rows`` labelled documents (those with the smallest id hashes) whose
``crc32(doc_id) mod 3`` is not 1; at most ``FEATURES`` features are kept, so the model that goes to every task is
bounded. Scores depend on the text only.

Cases: a null or empty text has no segment and gets the score of that; null labels are ignored, several
labels of a document count as toxic if one is; without any toxic or any clean label every score is 0; a null
doc_id is never held out; repeated rows get equal scores;
very long texts are read whole, as a slice of their own; an empty table gives an empty result; further columns are ignored by
:func:`scores` and kept by :func:`keep_clean`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstar.llm.jaccard_join import shingles
from orderstar.llm.sparkops import stage
from orderstar.llm.textops import LOWER, U, flat, mix, prefix_hash, range_hash, signed, slices, words

FIT_ROWS = 20_000
FEATURES = 20_000
PREFIXES = (4, 5, 6, 7)
MIN_TOXIC = 3
#: A feature counts from this likelihood-ratio statistic on (far beyond chance among millions of words), and where
#: its log-odds less their standard error reach MIN_WEIGHT.
MIN_SURPRISE = 20.0
MIN_WEIGHT = 2.5
PRIOR = 1.0
GAP = 0.5
THRESHOLD = 0.7
#: Word scores are counted in bins of half a unit.
BINS = 16
FAMILY = np.array([3, 5, 7, 11], U) * U(0x9E3779B97F4A7C15)

EDGE = np.zeros(256, bool)
EDGE[[b for b in range(0x21, 0x7F) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]] = True


@dataclass
class Model:
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    lam: float = 1.0
    log_k: float = 0.0
    curve: tuple[float, float, float] = (-60.0, 0.0, 0.0)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends (without ASCII punctuation at the ends), first word of each document, and the
    features: a row of hashes per kind (0 where a word is too short for it)."""
    low = LOWER[data]
    accent = np.flatnonzero(low[:-1] == 0xC3) + 1  # two-byte Latin capitals
    upper = accent[(low[accent] >= 0x80) & (low[accent] <= 0x9E) & (low[accent] != 0x97)]
    low[upper] += 0x20
    start, end, first = words(low, offsets)
    if not len(start):
        return start, end, first, np.zeros((1 + len(PREFIXES), 0), U), low
    for _ in range(3):
        start = start + ((end - start > 1) & EDGE[low[start]])
        end = end - ((end - start > 1) & EDGE[low[end - 1]])
    prefix = prefix_hash(low)
    lead = np.flatnonzero((low & 0xC0) != 0x80)
    at, stop = np.searchsorted(lead, start), np.searchsorted(lead, end)
    out = np.zeros((1 + len(PREFIXES), len(start)), U)
    out[0] = range_hash(prefix, start, end)
    for i, k in enumerate(PREFIXES):
        long = np.flatnonzero(stop - at > k)
        out[i + 1, long] = range_hash(prefix, start[long], lead[at[long] + k]) + U(k)
    return start, end, first, out, low


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest shingle hashes of a text, which near copies mostly share."""
    for batch in slices(batches):
        least = [mix(s ^ FAMILY[:, None]).min(axis=1) if len(s) else np.zeros(len(FAMILY), U) for s in shingles(*flat(batch.column("text")), 5)]
        columns = np.array(least, U).reshape(-1, len(FAMILY)).T
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(signed(np.ascontiguousarray(c))) for c in columns)], names=[*batch.schema.names, *(f"f{i}" for i in range(len(FAMILY)))])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, toxic and clean."""
    for batch in slices(batches):
        _, _, first, f, _ = features(*flat(batch.column("text")))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        keys, n = [[], []], [0, 0]
        for i, label in enumerate(toxic.tolist()):
            own = np.unique(f[:, first[i] : first[i + 1]])
            keys[label].append(own[own != 0])
            n[label] += 1
        for label in (0, 1):
            if keys[label]:
                key, count = np.unique(np.concatenate(keys[label]), return_counts=True)
                zero = np.zeros(len(key), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(count if label else zero), pa.array(zero if label else count)], names=["key", "t", "c"])


def word_scores(model: Model, f: np.ndarray) -> np.ndarray:
    out = np.full(f.shape[1], -GAP)
    if not len(model.keys):
        return out
    seen = np.zeros(1 << 20, bool)
    seen[(model.keys >> U(44)).astype(np.int64)] = True
    for row in f:
        maybe = np.flatnonzero(seen[(row >> U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model.keys, row[maybe]), len(model.keys) - 1)
        hit = model.keys[at] == row[maybe]
        np.maximum.at(out, maybe[hit], model.weights[at[hit]])
    return out


def segments(score: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments ``(score, begin, end)`` of a sequence (Ruzzo and Tompa), in order."""
    total = np.concatenate(([0.0], np.cumsum(score)))
    held: list[tuple[float, float, int, int]] = []  # sum before, sum after, begin, end
    for i in np.flatnonzero(score > 0).tolist():
        left, right, begin = total[i], total[i + 1], i
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= left:
                j -= 1
            if j < 0 or held[j][1] >= right:
                held.append((left, right, begin, i + 1))
                break
            left, begin = held[j][0], held[j][2]
            del held[j:]
            j -= 1
    return [(r - l, b, e) for l, r, b, e in held]


def evidence(model: Model, score: np.ndarray) -> tuple[float, float, list]:
    """Normalised score of the best segment, the sum of the significant ones, and these."""
    found = segments(score)
    if not found:
        return 0.0, 0.0, []
    norm = [(model.lam * s - model.log_k - float(np.log(len(score))), s, b, e) for s, b, e in found]
    good = [x for x in norm if x[0] > 0]
    return max(0.0, max(norm)[0] + 5.0), sum(x[0] for x in good), good


def _calibration(model: Model):
    def rows(batches):
        for batch in slices(batches):
            _, _, first, f, _ = features(*flat(batch.column("text")))
            score = word_scores(model, f)
            best, n, hist = [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own = score[a:b]
                best.append(max((s for s, *_ in segments(own)), default=0.0))
                n.append(b - a)
                hist.append(np.bincount(np.minimum(np.maximum(own, 0) * 2, BINS - 1).astype(int), minlength=BINS).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(best), pa.array(n, pa.int64()), pa.array(hist, pa.list_(pa.int64())), batch.column("toxic")],
                names=["best", "n", "hist", "toxic"],
            )

    return rows


def _inputs(model: Model):
    """The two inputs of the curve, and the label, of calibration documents."""

    def rows(batches):
        for batch in slices(batches):
            _, _, first, f, _ = features(*flat(batch.column("text")))
            score = word_scores(model, f)
            both = [shaped(*evidence(model, score[a:b])[:2]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            x, y = zip(*both)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), pa.array(y, pa.float64()), batch.column("toxic")], names=["x", "y", "toxic"])

    return rows


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def shaped(best: float, significant: float) -> tuple[float, float]:
    """The two inputs of the curve."""
    return min(best, 40.0), float(np.log1p(significant))


def _rate(y: np.ndarray, x: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve with a small ridge, by Newton steps: of the fits on both inputs or on either, that of the smallest
    loss in which more evidence never lowers the score."""
    best = (np.inf, (0.0, 0.0, 0.0))
    for used in ([0, 1], [0], [1]):
        z = np.column_stack((np.ones(len(x)), x[:, used]))
        w, ridge = np.zeros(z.shape[1]), np.diag([1e-3] + [1e-2] * len(used))
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w = w + np.clip(np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (y - p) - ridge @ w), -1, 1)
        loss = float(np.logaddexp(0, np.where(y > 0, -1, 1) * (z @ w)).sum())
        if loss < best[0] and (w[1:] >= 0).all():
            full = [0.0, 0.0]
            for k, v in zip(used, w[1:]):
                full[k] = float(v)
            best = (loss, (float(w[0]), *full))
    return best[1]


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled documents outside the held-out third. Only bounded results reach
    the driver: ``FEATURES`` features and a few numbers for each calibration document."""
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("label_id").isNotNull() & ~held_out(F.col("label_id")))
        .groupBy("label_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).select("label_id", "text", "toxic")
    known = stage(known, "op2-known")  # at most ``fit_rows`` labels' documents, read three times
    third = F.pmod(F.xxhash64("label_id", F.lit("calibrate")), F.lit(3)) == 0
    # near copies count once for the lexicon, or their chance words would look toxic
    keys = [f"f{i}" for i in range(len(FAMILY))]
    lexicon = known.where(~third).select("text", "toxic").mapInArrow(_families, "text string, toxic int, " + ", ".join(f"{k} long" for k in keys))
    for k in keys:
        lexicon = lexicon.dropDuplicates([k])
    lexicon = lexicon.select("text", "toxic")
    total = {r.toxic: r["count"] for r in ids.groupBy("toxic").count().collect()}
    if len(total) < 2:
        return Model()
    nt, nc = total[1] * 2 / 3, total[0] * 2 / 3
    counts = lexicon.mapInArrow(_counts, "key long, t long, c long").groupBy("key").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") >= MIN_TOXIC)
    # the prior gives a feature the pseudo-counts PRIOR, split between the classes as all documents are
    at, ac = PRIOR * nt / (nt + nc), PRIOR * nc / (nt + nc)
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + at) / (nt + PRIOR)) - F.log((c + ac) / (nc + PRIOR))
    error = F.sqrt(1 / (t + at) + 1 / (c + ac))
    both = t + c
    fits = lambda n, share: F.when(n > 0, n * F.log(n / (both * share))).otherwise(0.0)
    surprise = 2 * (fits(t, nt / (nt + nc)) + fits(c, nc / (nt + nc)))
    strong = counts.select("key", odds.alias("d"), error.alias("e"), surprise.alias("g")).where((F.col("g") >= MIN_SURPRISE) & (F.col("d") - F.col("e") >= MIN_WEIGHT))
    top = strong.orderBy(F.desc("g"), "key").limit(FEATURES).collect()
    if not top:
        return Model()
    keys = np.array([r.key for r in top], np.int64).view(U)
    order = np.argsort(keys)
    weights = np.clip([r.d - r.e for r in top], MIN_WEIGHT, BINS / 2 - 0.5)
    model = Model(keys[order], weights[order])
    rows = known.where(third).select("text", "toxic").mapInArrow(_calibration(model), "best double, n long, hist array<long>, toxic int").collect()
    clean = [r for r in rows if not r.toxic and r.n]
    hist = np.array([r.hist for r in clean]).sum(axis=0) if clean else np.zeros(BINS)
    p = (hist + np.r_[1.0, np.full(BINS - 1, 1e-3)]) / (hist.sum() + 1 + (BINS - 1) * 1e-3)
    s = np.r_[-GAP, np.arange(1, BINS) / 2 + 0.25]
    low, high = 1e-3, 20.0
    for _ in range(80):
        lam = (low + high) / 2
        low, high = (low, lam) if p @ np.exp(lam * s) > 1 else (lam, high)
    model.lam = max(lam, 0.05)
    model.log_k = float(np.mean([model.lam * r.best - np.log(r.n) for r in clean]) - 0.5772) if clean else 0.0
    if rows and 0 < sum(r.toxic for r in rows) < len(rows):
        found = known.where(third).select("text", "toxic").mapInArrow(_inputs(model), "x double, y double, toxic int").collect()
        model.curve = _rate(np.array([r.toxic for r in found], float), np.array([(r.x, r.y) for r in found]))
    return model


def _score(model: Model):
    def of(batch: pa.RecordBatch, text: str) -> tuple[list[float], list[int]]:
        _, _, first, f, _ = features(*flat(batch.column(text)))
        score = word_scores(model, f)
        hits = np.concatenate(([0], np.cumsum(score > 0)))
        out, count = [], []
        a, b, c = model.curve
        for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
            best, significant, good = evidence(model, score[i:j]) if hits[j] > hits[i] else (0.0, 0.0, [])
            x, y = shaped(best, significant)
            out.append(float(1 / (1 + np.exp(-(a + b * x + c * y)))))
            count.append(len(good))
        return out, count

    return of


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted, n_segments`` (significant segments)."""
    of = _score(model)

    def rows(batches):
        for batch in slices(batches):
            score, count = of(batch, "text")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(count, pa.int64())], names=["doc_id", "held_out", "score", "n_segments"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    out = plain.mapInArrow(rows, "doc_id long, held_out boolean, score double, n_segments long")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_segments")


def toxic_segments(docs: DataFrame, model: Model) -> DataFrame:
    """The significant segments: ``doc_id, segment, text, raw_score, normalised`` (passages for review)."""

    def rows(batches):
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            start, end, first, f, _ = features(data, offsets)
            score = word_scores(model, f)
            ids = batch.column("doc_id").to_pylist()
            out = []
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                for k, (norm, raw, x, y) in enumerate(evidence(model, score[a:b])[2]):
                    out.append({"doc_id": ids[i], "segment": k, "text": data[start[a + x] : end[a + y - 1]].tobytes().decode(), "raw_score": raw, "normalised": norm})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("segment", pa.int64()), ("text", pa.string()), ("raw_score", pa.float64()), ("normalised", pa.float64())]))

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(rows, "doc_id long, segment long, text string, raw_score double, normalised double")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under the threshold."""
    of = _score(model)

    def rows(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(np.array(of(batch, "text")[0]) < THRESHOLD))

    return docs.mapInArrow(rows, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query."""
    return scores(docs, fit(docs, labels))
