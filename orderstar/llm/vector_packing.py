"""Best-fit packing of documents into sequences, under several capacities at once.

A sequence has room for so many tokens, documents and so much attention cost (the sum of squared lengths). Documents
are placed in decreasing length, each into the open sequence that fits best: of those where every capacity suffices, the
one with the least weighted norm of what is left (``rule="norm"``) or the least weighted dot product of the document and
what is left (``rule="dot"``); a new sequence opens only where none fits. Longer documents are cut into whole sequences and a
rest first.

How it is spread. Documents of equal length are interchangeable, so the packing needs only the number of pieces of each
length: a histogram of at most ``tokens`` rows, whatever the corpus (:func:`plan`). Open sequences of equal content are one
class with a count, and a class takes as many equal pieces as fit. The plan's rows say where the pieces of one length go, by
their rank. Ranks come from counts: a task numbers its own pieces of every length while it writes them, the counts of
tasks are added up, so no length (also one that a third of all pieces have) is sorted or gathered. Tokens are counted and
checked in the tasks; texts are not shuffled.

Cases: a null text counts as empty and has only the end id; empty texts are pieces of one token; rows of equal or null
doc_id are documents of their own; very long texts are encoded whole, by the task that reads them; an empty table has
no sequences; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import flat, slices
from orderstar.llm.token_files import encoder

TOKENS = 4096
#: Weights of tokens, documents and attention cost in the choice of a sequence.
WEIGHTS = (1.0, 1 / 16, 1 / 16)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, rank long"


# ---------------------------------------------------------------- the plan


class _Open:
    """Classes of open sequences: residual capacities, first sequence, number of sequences and tokens used."""

    def __init__(self, dimensions: int):
        self.left = np.zeros((64, dimensions))
        self.rows = np.zeros((64, 3), np.int64)
        self.size = 0

    def add(self, left: np.ndarray, first: int, count: int, used: int) -> None:
        if self.size == len(self.left):
            self.left, self.rows = (np.concatenate((x, np.zeros_like(x))) for x in (self.left, self.rows))
        self.left[self.size], self.rows[self.size] = left, (first, count, used)
        self.size += 1

    def drop(self, i: int) -> None:
        self.size -= 1
        self.left[i], self.rows[i] = self.left[self.size], self.rows[self.size]


def plan(
    counts: Mapping[int, int], tokens: int = TOKENS, documents: int | None = None, cost: int | None = None, weights: Sequence[float] = WEIGHTS, rule: str = "norm"
) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``length, begin, end, first, each, used`` for a histogram of lengths: the piece of rank k (begin <= k < end) goes into
    sequence ``first + (k - begin) // each`` at ``used + (k - begin) % each * length``.

    ``documents`` and ``cost`` None: as much as ``tokens`` allow, so they never bind. A length whose own cost is beyond the
    capacity raises an error."""
    capacity = np.array([tokens, documents or tokens, cost or tokens * tokens], float)
    weight = np.asarray(weights, float)
    open_, out, sequences = _Open(3), [], 0
    for length in sorted(counts, reverse=True):
        item = np.array([length, 1, length * length], float)
        if (item > capacity).any():
            raise ValueError(f"no sequence can take a piece of {length} tokens")
        rank, rest = 0, counts[length]
        while rest:
            left = open_.left[: open_.size]
            fits = np.flatnonzero((left >= item).all(axis=1))
            if len(fits):
                if rule == "dot":
                    score = (weight * (item / capacity) * (left[fits] / capacity)).sum(axis=1)
                else:
                    score = (weight * ((left[fits] - item) / capacity) ** 2).sum(axis=1)
                # equal scores: the earlier sequence
                i = int(fits[np.lexsort((open_.rows[fits, 0], score))[0]])
                room, (first, count, used) = open_.left[i].copy(), open_.rows[i].tolist()
                open_.drop(i)
                each = int((room // item).min())
            else:
                room, first, used = capacity, sequences, 0
                each = int((room // item).min())
                count = -(-rest // each)
                sequences += count
            taken = min(rest, count * each)
            out.append((length, rank, rank + taken, first, each, used))
            full, part = divmod(taken, each)
            for n, k, at in ((full, each, first), (int(part > 0), part, first + full), (count - full - (part > 0), 0, first + full + (part > 0))):
                after = room - k * item
                if n and after[0] > 0 and after[1] > 0:
                    open_.add(after, at, n, used + k * length)
            rank, rest = rank + taken, rest - taken
    return out


# ---------------------------------------------------------------- pieces and places


def _pieces(tokenizer: str, end_id: int, tokens: int, keep_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(tokens + 1, np.int64)
        enc = encoder(tokenizer)
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            ids, bounds = enc.encode(data, offsets)
            n = len(bounds) - 1
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
            bounds = bounds + np.arange(n + 1)
            size = np.diff(bounds)
            cuts = -(-size // tokens)
            doc = np.repeat(np.arange(n), cuts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * tokens
            length = np.minimum(size[doc] - start, tokens)
            begin = bounds[doc] + start
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist())]
            # rank among the task's pieces of this length
            order = np.argsort(length, kind="stable")
            of, counts = np.unique(length, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts)
            rank += seen[length]
            seen[of] += counts
            columns = [
                batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(np.full(len(doc), part, np.int64)), pa.array(rank),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            if keep_ids:
                columns.append(pa.array([bytes(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, tokens: int = TOKENS, keep_ids: bool = False) -> DataFrame:
    """The written pieces of all documents, numbered within ``part`` and length; ``ids`` (little-endian 32-bit) on request."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return stage(texts.mapInArrow(_pieces(tokenizer, end_id, tokens, keep_ids), PIECES + ", ids binary" * keep_ids), "op13-pieces")


def _place(rows_: list[tuple]):
    table = np.array(sorted(rows_), np.int64).reshape(-1, 6)
    key = (table[:, 0] << 44) + table[:, 1]  # ranks below 2**44

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            _, begin, _, first, each, used = table[at].T
            k = rank - begin
            keep = [i for i, c in enumerate(batch.schema.names) if c not in ("part", "rank")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(first + k // each), pa.array(used + k % each * length)],
                names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"],
            )

    return rows


def pack(found: DataFrame, tokens: int = TOKENS, **options) -> DataFrame:
    """The pieces with their ``sequence_id`` and ``offset``; ``options`` as for :func:`plan`."""
    counts = stage(found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "op13-counts")
    # at most ``tokens`` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = found.join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before")).select(*found.columns)
    kept = [f"{n} {t}" for n, t in found.dtypes if n not in ("part", "rank")]
    return ranked.mapInArrow(_place(plan(histogram, tokens, **options)), ", ".join([*kept, "sequence_id long", "offset long"]))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences, from pieces with their ids: ``sequence_id, n_tokens, pieces`` (array of offset, doc_id, piece, length) and
    ``ids`` (binary); no group holds more than a sequence."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    whole = placed.groupBy("sequence_id").agg(rows.alias("r"))
    return whole.select(
        "sequence_id",
        F.aggregate("r", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
        F.transform("r", lambda x: F.struct(x["offset"].alias("offset"), x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["length"].alias("length"))).alias("pieces"),
        F.aggregate("r", F.lit(bytearray()), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )


def digest(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """The registered query: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(pieces(docs, str(tokenizer), end_id))
