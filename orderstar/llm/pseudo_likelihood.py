"""Language-model scoring by masked pseudo-likelihood.

A word's probability is that of the word itself given the words on both sides, from counts over the whole corpus, which back
off to a network of word classes. Every count is without the word's own occurrence, so a score tells what the rest of the
corpus says about a document.

* Words are lower-cased and named by 64 bits: their class and 58 bits of a hash.
* Spark counts, exactly and over all documents, the words, the pairs of neighbours, the pairs with one word between them, the
  surroundings (a word's two neighbours) and the words in their surroundings. The counts grow with the corpus and are
  joined to the documents' words through written tables.
* A word's distribution given one of the two words to its left or right backs off (``PAIR``) to the network's; the four are
  mixed by ``SIDES``. That given both neighbours backs off (``BOTH``) to the mixture.
* The network's words lie in ``CLASSES`` classes: words are hashed to ``BUCKETS`` buckets, the commonest ``OWN`` buckets are
  classes of their own; the other words share ``CLASSES - OWN`` classes by their last two bytes. Spark counts how often
  each class stands between each pair of classes (a document's edge is a class, too). These ``(CLASSES + 1) ** 2`` contexts hold
  everything the corpus says to a network of classes whose window is one word to each side, so training on them is training on every token.
* The network embeds the left and the right class, adds them, and predicts the class through a ``tanh`` layer and a
  softmax; it is trained in numpy on the driver, by Adam on the full-corpus likelihood, from the bounded
  table of counts. Its predictions for all contexts are a table again, which goes to every task (1 MB). Within a class, words
  have their exact shares, less ``DISCOUNT`` occurrences each, which go to words that the corpus has nowhere else, by their buckets.
* A document's score is the sum over all its words of ``log p(word | neighbours)``. (:func:`scores` is the network alone, with buckets for words.)

How it is counted: documents are packed into blocks of about ``BLOCK_BYTES`` of text and written as a table of word numbers. For each
kind of count a block sends its distinct keys with their counts, dealt by key; where a key's sum differs from the
block's own count, the sum goes back to the block. A common key costs one entry a block.

Cases: null and empty texts have 0 words, log-likelihood 0 and null means; without any word in the corpus the model is uniform;
a null id and repeated rows pass through, and each repeated row counts; very long texts are read whole, as a slice and a block of their own;
 an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.llm.sparkops import discard, stage
from orderstar.llm.textops import LOWER, U, flat, mix, prefix_hash, range_hash, release, slices, words

BUCKETS = 1 << 18
CLASSES = 64
OWN = 40
WIDTH = 24
STEPS = 400
#: Added to the count of every bucket and of every class in a context.
SMOOTH = 0.1
#: Taken from each word's count within its class.
DISCOUNT = 0.75
#: Weight of the distribution that a count backs off to, in occurrences.
PAIR, BOTH = 4.0, 2.0
#: Shares of the words one and two to the left, one and two to the right.
SIDES = (0.35, 0.15, 0.35, 0.15)
#: Name of a document's edge.
EDGE = U(0xFFFFFFFFFFFFFFFF)
WORD, NEXT, SKIP, AROUND, CENTRE = range(5)
BLOCK_BYTES = 4 << 20
#: Words per part that keys are dealt to; parts at least; parts that blocks are scored in one after the other.
PART_WORDS, PARTS, ROUNDS = 1 << 21, 64, 3


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending class (0 .. CLASSES - OWN) of each word, and each document's first word."""
    low = LOWER[data]
    start, end, first = words(low, offsets)
    h = range_hash(prefix_hash(low), start, end)
    tail = low[end - 1].astype(U) * U(256) + low[np.maximum(end - 2, start)].astype(U)
    return h, (mix(tail + U(1)) % U(CLASSES - OWN)).astype(np.int64), first


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and ending class of each word, and each document's first word."""
    h, tail, first = _hashes(data, offsets)
    return (h >> U(64 - 18)).astype(np.int64), tail, first


def _table(counts: np.ndarray, name: str) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=[name, "n"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each bucket and their first ending class; a row per bucket that occurs, once per task."""
    counts, lowest = np.zeros(BUCKETS, np.int64), np.full(BUCKETS, CLASSES)
    for batch in slices(batches):
        b, tail, _ = buckets(*flat(batch.column("text")))
        counts += np.bincount(b, minlength=BUCKETS)
        np.minimum.at(lowest, b, tail)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(lowest[at]), pa.array(counts[at])], names=["bucket", "tail", "n"])


@dataclass
class Model:
    own: np.ndarray  # the class of a bucket, or -1
    log_word: np.ndarray  # log p(bucket | its class)
    log_class: np.ndarray  # [left, right, class]


def classes_of(own: np.ndarray, b: np.ndarray, tail: np.ndarray) -> np.ndarray:
    return np.where(own[b] >= 0, own[b], OWN + tail)


def contexts(c: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes left and right of every word; CLASSES at the edges of a document."""
    left, right = np.full(len(c), CLASSES), np.full(len(c), CLASSES)
    left[1:], right[:-1] = c[:-1], c[1:]
    some = np.diff(first) > 0
    left[first[:-1][some]] = CLASSES
    right[first[1:][some] - 1] = CLASSES
    return left, right


def _context_counts(own: np.ndarray):
    def rows(batches):
        counts = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int64)
        for batch in slices(batches):
            b, tail, first = buckets(*flat(batch.column("text")))
            if len(b):
                c = classes_of(own, b, tail)
                left, right = contexts(c, first)
                counts += np.bincount((left * (CLASSES + 1) + right) * CLASSES + c, minlength=len(counts))
        yield _table(counts, "key")

    return rows


def train(counts: np.ndarray, width: int = WIDTH, steps: int = STEPS, seed: int = 7) -> np.ndarray:
    """Log probabilities ``[left, right, class]`` of a network trained on counts of the same shape."""
    k = counts.shape[2]
    weight = counts.sum(axis=2)
    left, right = np.nonzero(weight)
    if not len(left):
        return np.full(counts.shape, -np.log(k))
    target, mass = counts[left, right].astype(np.float64), weight[left, right].astype(np.float64)
    scale = 1 / mass.sum()
    r = np.random.default_rng(seed)
    p = {"l": r.normal(0, 0.3, (k + 1, width)), "r": r.normal(0, 0.3, (k + 1, width)), "h": np.zeros(width), "o": r.normal(0, 0.3, (width, k)), "b": np.log((target.sum(axis=0) + SMOOTH) * scale)}
    m, v = ({n: np.zeros_like(x) for n, x in p.items()} for _ in range(2))
    one_left, one_right = np.eye(k + 1)[left], np.eye(k + 1)[right]

    def forward(a, b):
        h = np.tanh(p["l"][a] + p["r"][b] + p["h"])
        z = h @ p["o"] + p["b"]
        z -= z.max(axis=1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    for step in range(1, steps + 1):
        h, log_p = forward(left, right)
        dz = (np.exp(log_p) * mass[:, None] - target) * scale
        dh = (dz @ p["o"].T) * (1 - h * h)
        grad = {"l": one_left.T @ dh, "r": one_right.T @ dh, "h": dh.sum(axis=0), "o": h.T @ dz, "b": dz.sum(axis=0)}
        rate = 0.05 * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grad.items():
            m[n] = 0.9 * m[n] + 0.1 * g
            v[n] = 0.99 * v[n] + 0.01 * g * g
            p[n] = p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-9)
    a, b = np.divmod(np.arange((k + 1) ** 2), k + 1)
    return forward(a, b)[1].reshape(k + 1, k + 1, k)


def fit(docs: DataFrame) -> Model:
    """Counts of the whole corpus by Spark, the network on the driver; only bounded tables are collected."""
    text = docs.select(F.col("text").cast("string").alias("text"))
    rows = text.mapInArrow(_word_counts, "bucket long, tail long, n long").groupBy("bucket").agg(F.sum("n").alias("n"), F.min("tail").alias("tail")).toPandas()
    n, tail = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    n[rows["bucket"]], tail[rows["bucket"]] = rows["n"], rows["tail"]
    own = np.full(BUCKETS, -1, np.int8)
    top = np.lexsort((np.arange(BUCKETS), -n))[:OWN]
    own[top] = np.arange(OWN)
    # a bucket outside the top is a word of the first ending class among its words
    c = classes_of(own, np.arange(BUCKETS), tail)
    size, total = np.bincount(c, minlength=CLASSES), np.bincount(c, n, minlength=CLASSES)
    log_word = np.where(own >= 0, 0.0, np.log((n + SMOOTH) / (total[c] + SMOOTH * size[c]))).astype(np.float32)
    cells = text.mapInArrow(_context_counts(own), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int64)
    counts[cells["key"]] = cells["n"]
    return Model(own, log_word, train(counts.reshape(CLASSES + 1, CLASSES + 1, CLASSES)).astype(np.float32))


def score_slice(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed conditional log-probability of each document."""
    b, tail, first = buckets(data, offsets)
    if not len(b):
        return np.diff(first), np.zeros(len(first) - 1)
    c = classes_of(model.own, b, tail)
    left, right = contexts(c, first)
    log_p = model.log_class[left, right, c].astype(np.float64) + model.log_word[b]
    total = np.concatenate(([0.0], np.cumsum(log_p)))
    return np.diff(first), total[first[1:]] - total[first[:-1]]


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, n_words, log_likelihood, mean_log_prob, pseudo_perplexity``."""
    packed = docs.sparkSession.sparkContext.broadcast(model)  # 2.5 MB, whatever the corpus

    def rows(batches):
        for batch in slices(batches):
            n, total = score_slice(packed.value, *flat(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(total)], names=["doc_id", "n_words", "log_likelihood"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mean = F.try_divide("log_likelihood", "n_words")
    return plain.mapInArrow(rows, "doc_id long, n_words long, log_likelihood double").select("*", mean.alias("mean_log_prob"), F.exp(-mean).alias("pseudo_perplexity"))


# ------------------------------------------------------------------ counts of the words themselves


def names(own: np.ndarray, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """A word's class in the top 6 bits, the top 58 bits of its hash below."""
    c = classes_of(own, (h >> U(64 - 18)).astype(np.int64), tail)
    return (c.astype(U) << U(58)) | (h >> U(6))


def _class(name: np.ndarray) -> np.ndarray:
    return (name >> U(58)).astype(np.int64)


def _bucket(name: np.ndarray) -> np.ndarray:
    return ((name << U(6)) >> U(64 - 18)).astype(np.int64)


def _unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``textops.mix``."""
    for factor in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD):
        x = (x ^ (x >> U(33))) * U(pow(factor, -1, 1 << 64))
    return x ^ (x >> U(33))


def _pack(x: np.ndarray) -> bytes:
    """Non-negative integers as planes of bytes, the low ones first, without planes of zeros."""
    planes = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:planes].tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(data, np.uint8).reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


def _blocks(own, sign: int):
    """Rows ``block, ids, sizes, names, codes``: the documents of a block, words of each, distinct names, and each word's
    number among these. Blocks are numbered up (``sign`` 1) or down."""

    def block(number, held):
        name, codes = np.unique(np.concatenate([x for _, x, _ in held]), return_inverse=True)
        sizes = np.concatenate([np.diff(f) for _, _, f in held])
        ids = pa.concat_arrays([x for x, _, _ in held])
        row = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
        row += [pa.array([x], pa.binary()) for x in (_pack(sizes), name.tobytes(), _pack(codes))]
        row += [pa.array([int(x)]) for x in (sizes.sum(), (sizes > 0).sum(), (sizes > 1).sum())]
        return pa.RecordBatch.from_arrays(row, names=["block", "ids", "sizes", "names", "codes", "n", "n1", "n2"])

    def rows(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            if held and size + len(data) > BLOCK_BYTES:
                yield block(number if sign > 0 else -1 - number, held)
                number, held, size = number + 1, [], 0
            h, tail, first = _hashes(data, offsets)
            held.append((batch.column("doc_id"), names(own.value.own, h, tail), first))
            size += len(data)
        if held:
            yield block(number if sign > 0 else -1 - number, held)

    return rows


BLOCKS = "block long, ids array<long>, sizes binary, names binary, codes binary, n long, n1 long, n2 long"


def _tokens(docs: DataFrame, model, sign: int, counted: bool, asks: bool) -> DataFrame:
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = plain.mapInArrow(_blocks(model, sign), BLOCKS)
    return stage(blocks.withColumns({"counted": F.lit(counted), "asks": F.lit(asks)}), "op6-words")


class _Block:
    """The words of a block between two edges before, between and after its documents."""

    def __init__(self, row: dict):
        self.name = np.frombuffer(row["names"], U)
        self.sizes = _unpack(row["sizes"], len(row["ids"]))
        self.code = _unpack(row["codes"], row["n"])
        self.at = np.arange(row["n"]) + 2 * np.repeat(np.arange(1, len(self.sizes) + 1), self.sizes)
        width = row["n"] + 2 * (len(self.sizes) + 1)
        # the edge's number is the last
        self.padded = np.full(width, len(self.name))
        self.padded[self.at] = self.code
        self.all = np.concatenate((self.name, [EDGE]))

    def distinct(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys of a kind in order, and how often each occurs."""
        if kind != WORD:
            return np.unique(self.keys(kind)[0], return_counts=True)
        keys = mix(self.name)
        order = np.argsort(keys)
        return keys[order], np.bincount(self.code, minlength=len(keys))[order]

    def places(self, kind: int) -> list[np.ndarray]:
        """Where each word finds its keys among the :meth:`distinct` ones."""
        if kind == WORD:
            rank = np.empty(len(self.name), np.int64)
            rank[np.argsort(mix(self.name))] = np.arange(len(rank))
            return [rank[self.code]]
        keys, events = self.keys(kind)
        inverse = np.unique(keys, return_inverse=True)[1]
        return [inverse[e] for e in events]

    def keys(self, kind: int) -> tuple[np.ndarray, list]:
        """The keys of all events of a kind, and where each word finds its own among them."""
        left, right = self.all * U(0x9E3779B97F4A7C15), mix(self.all ^ U(0x165667B19E3779F9))
        if kind in (NEXT, SKIP):
            far = kind - NEXT + 1
            a, b = self.padded[:-far], self.padded[far:]
            some = np.flatnonzero((a < len(self.name)) | (b < len(self.name)))
            back = np.zeros(len(a), np.int64)
            back[some] = np.arange(len(some))
            return mix(left[a[some]] + right[b[some]] + U(far)), [back[self.at - far], back[self.at]]
        around = left[self.padded[self.at - 1]] + right[self.padded[self.at + 1]]
        return mix(around if kind == AROUND else mix(around) + self.all[self.code]), [slice(None)]


def _events(kind: int, parts: int):
    """Rows ``part, block, start, keys, counts``: a block's distinct keys of a kind in order, cut by part."""

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if not row["n"]:
                    continue
                keys, counts = _Block(row).distinct(kind)
                cut = np.searchsorted((keys >> U(32)) * U(parts) >> U(32), np.arange(parts + 1, dtype=U))
                part = np.flatnonzero(np.diff(cut))
                ends = np.append(cut[part], len(keys))
                n = len(part)
                columns = [pa.array(part), pa.array([row["block"]] * n), pa.array(cut[part]), _cut(keys, ends), _cut(counts.astype(np.uint32), ends)]
                columns += [pa.array([row[x]] * n) for x in ("counted", "asks")]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "start", "keys", "counts", "counted", "asks"])
        release()

    return rows


EVENTS = "part long, block long, start long, keys binary, counts binary, counted boolean, asks boolean"


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``values`` as binary cells that begin at ``ends``; the last one is the end."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _sums(kind: int):
    """For a part, rows ``block, kind, start, n, differs, total``: where a block's own counts are not the corpus's, and these. For
    words also a row without block: the distinct words and all words of each class."""

    def rows(table: pa.Table) -> pa.Table:
        key, offsets = flat(table.column("keys").combine_chunks())
        key = np.frombuffer(key.tobytes(), U)
        count = np.frombuffer(flat(table.column("counts").combine_chunks())[0].tobytes(), np.uint32).astype(np.int64)
        ends = offsets // 8
        counted = table.column("counted").to_numpy()
        if not counted.all():
            count = count * np.repeat(counted, np.diff(ends))
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        sums = np.add.reduceat(count[order], at) if len(at) else count
        total = np.empty(len(key), np.int64)
        total[order] = np.repeat(sums, np.diff(np.append(at, len(key))))
        differs = total != count
        out = []
        for i, (block, start, asks) in enumerate(zip(*(table.column(x).to_pylist() for x in ("block", "start", "asks")))):
            d = differs[ends[i] : ends[i + 1]]
            if asks and d.any():
                out.append((block, kind, start, len(d), np.packbits(d).tobytes(), _pack(total[ends[i] : ends[i + 1]][d])))
        if kind == WORD:
            c = _class(_unmix(key[at]))[sums > 0]
            out.append((None, kind, 0, 0, np.bincount(c, minlength=CLASSES).tobytes(), np.bincount(c, sums[sums > 0], CLASSES).astype(np.int64).tobytes()))
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=["block", "kind", "start", "n", "differs", "total"])

    return rows


SUMS = "block long, kind int, start long, n long, differs binary, total binary"


@dataclass
class Corpus:
    model: Model
    distinct: np.ndarray  # words of each class
    total: np.ndarray  # occurrences of each class
    edges: tuple[int, int]  # occurrences with an edge one or two to the left


def _conditionals(corpus: Corpus, block: _Block, found: list[dict], counted: bool) -> np.ndarray:
    """``p(word | neighbours)`` of each word of a block, without its own occurrence if the block was counted."""
    own = int(counted)
    counts: dict[int, list[np.ndarray]] = {}
    per_name = np.zeros(0)
    for kind in (WORD, NEXT, SKIP, AROUND, CENTRE):
        n = block.distinct(kind)[1] * own
        for r in found:
            if r["kind"] == kind:
                at = r["start"] + np.flatnonzero(np.unpackbits(np.frombuffer(r["differs"], np.uint8), count=r["n"]))
                n[at] = _unpack(r["total"], len(at))
        counts[kind] = [n[p] - own for p in block.places(kind)]
        if kind == WORD:
            per_name = np.zeros(len(block.all), np.int64)
            per_name[block.code] = counts[WORD][0] + own
    n, m, at = counts[WORD][0], corpus.model, block.at
    cls = np.append(_class(block.name), CLASSES)
    c = cls[block.code]
    # within its class: less the discount where it occurs elsewhere, else its bucket's part of all discounts
    q = np.exp(m.log_word[_bucket(block.name)].astype(np.float64))[block.code]
    rest = corpus.total[c] - own
    new = DISCOUNT * (corpus.distinct[c] - own * (n == 0)) * q
    in_class = np.where(rest > 0, np.where(n > 0, n - DISCOUNT, new) / np.maximum(rest, 1), q)
    p0 = np.exp(m.log_class[cls[block.padded[at - 1]], cls[block.padded[at + 1]], c].astype(np.float64)) * in_class
    near = np.zeros(len(at))
    sides = ((-1, counts[NEXT][0]), (-2, counts[SKIP][0]), (1, counts[NEXT][1]), (2, counts[SKIP][1]))
    for share, (step, pair) in zip(SIDES, sides):
        per_name[-1] = corpus.edges[abs(step) - 1]
        near += share * (pair + PAIR * p0) / (per_name[block.padded[at + step]] - own + PAIR)
    return (counts[CENTRE][0] + BOTH * near) / (counts[AROUND][0] + BOTH)


def _scored(corpus):
    def rows(tokens: pa.Table, sums: pa.Table) -> pa.Table:
        found, out = sums.to_pylist(), []
        for row in tokens.to_pylist():
            block = _Block(row)
            total = np.concatenate(([0.0], np.cumsum(np.log(_conditionals(corpus.value, block, found, row["counted"])))))
            first = np.concatenate(([0], np.cumsum(block.sizes)))
            out.append(pa.table([pa.array(row["ids"], pa.int64()), pa.array(block.sizes, pa.int64()), pa.array(total[first[1:]] - total[first[:-1]])], names=["doc_id", "n_words", "log_likelihood"]))
        release()
        return pa.concat_tables(out)

    return rows


def likelihoods(docs: DataFrame, model: Model, corpus: DataFrame | None = None) -> DataFrame:
    """Per row ``doc_id, n_words, log_likelihood, mean_log_prob, pseudo_perplexity`` by the counts of the whole corpus: of ``docs``
    themselves, every word without its own occurrence, or of another ``corpus``."""
    sc = docs.sparkSession.sparkContext
    packed = sc.broadcast(model)
    tables = [_tokens(docs, packed, 1, corpus is None, True)]
    if corpus is not None:
        tables.append(_tokens(corpus, packed, -1, True, False))
    tokens = tables[0] if corpus is None else tables[0].unionByName(tables[1])
    size = tokens.agg(F.sum("n"), F.sum(F.when(F.col("counted"), F.col("n1"))), F.sum(F.when(F.col("counted"), F.col("n2")))).first()
    n, n1, n2 = (int(x or 0) for x in size)
    parts = max(PARTS, n // PART_WORDS)
    sums = [
        stage(tokens.mapInArrow(_events(kind, parts), EVENTS).groupBy("part").applyInArrow(_sums(kind), SUMS), "op6-sums")
        for kind in (WORD, NEXT, SKIP, AROUND, CENTRE)
    ]
    distinct, total = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in sums[WORD].where("block IS NULL").select("differs", "total").toLocalIterator():
        distinct += np.frombuffer(row["differs"], np.int64)
        total += np.frombuffer(row["total"], np.int64)
    whole = sc.broadcast(Corpus(model, distinct, total, (n1, n1 + n2)))
    answers = sums[0].where("block IS NOT NULL")
    for other in sums[1:]:
        answers = answers.unionByName(other)
    done = []
    for i in range(ROUNDS):
        mine = F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == i
        pair = tables[0].where(mine).groupBy("block").cogroup(answers.where(mine).groupBy("block"))
        done.append(stage(pair.applyInArrow(_scored(whole), "doc_id long, n_words long, log_likelihood double"), "op6-scores"))
    discard(*tables, *sums)
    out = done[0].unionByName(done[1]).unionByName(done[2])
    mean = F.try_divide("log_likelihood", "n_words")
    return out.select("*", mean.alias("mean_log_prob"), F.exp(-mean).alias("pseudo_perplexity"))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query: every word of the corpus scored by the rest of the corpus."""
    return likelihoods(docs, fit(docs))
