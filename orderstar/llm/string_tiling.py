"""Benchmark decontamination by greedy string tiling.

Tokens are words, lower-cased, without ASCII punctuation at their ends; each character of a script without blanks is a
token, without the full-width marks after it. Seeds are the Karp-Rabin hashes of all
``least``-token windows of the benchmark items; a hash run over a document joins them. The seeds of a document
and an item lie on diagonals, whose unbroken stretches are the matches. Tiling marks the longest match,
then the longest among what is left unmarked on both sides, and so on down to ``least`` tokens. Tiles do not
overlap but may come in any order, so reordered passages are caught. A document is contaminated by an item of ``n`` tokens
when the tiles within some stretch of ``SPREAD * n`` tokens cover ``coverage * n`` of the item's tokens, and ``SHORTEST`` of them
at least (all of them, if it has fewer). So what a long text has scattered over it does not add up. An item
of fewer than ``SHORTEST`` tokens must be held in one tile; those of one or two tokens are found by hashes of their own.

The benchmark is read in blocks of at most about ``BLOCK_ITEMS`` items or ``BLOCK_CHARS`` characters, each of which
goes to every task; the documents pass once per block, and no document is shuffled. With several blocks each pass is
written, so the driver holds one block at a time.

Cases: null and empty texts are clean; null item texts and items without a token are not searched for; very long
texts are searched whole; repeated rows get equal verdicts; an empty benchmark or table gives
an empty result; further columns are ignored by :func:`matches` and kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import JOINED, LOWER, UNSPACED, U, code_points, flat, mix, prefix_hash, range_hash, slices, units

LEAST = 3
COVERAGE = 0.6
SHORTEST = 8
SPREAD = 5
BLOCK_ITEMS = 5_000
BLOCK_CHARS = 4_000_000

EDGE = np.zeros(256, bool)
EDGE[[b for b in range(0x21, 0x7F) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice and each document's first index."""
    low = LOWER[data]
    start, end, first = units(low, offsets)
    for _ in range(4):
        if len(start):
            start = start + ((end - start > 1) & EDGE[low[start]])
            end = end - ((end - start > 1) & EDGE[low[end - 1]])
            wide = np.flatnonzero((end - start > 3) & (low[end - 1] >= 0x80))
            code = code_points(low, end[wide] - 3)
            end[wide[(low[end[wide] - 3] >= 0xE0) & JOINED[code] & UNSPACED[code]]] -= 3
    return range_hash(prefix_hash(low), start, end), first


def windows(h: np.ndarray, least: int) -> np.ndarray:
    out = np.zeros(max(len(h) - least + 1, 0), U)
    for t in range(least):
        out = out * U(0x9E3779B97F4A7C15) + mix(h[t : t + len(out)] + U(t))
    return mix(out)


@dataclass
class Block:
    """Seeds of a block of items: sorted window hashes, and the item and place of each."""

    ids: list
    sizes: np.ndarray
    key: np.ndarray
    item: np.ndarray
    place: np.ndarray
    #: Items of fewer tokens than a seed has, by their number of tokens: sorted hashes, and the item of each.
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple], least: int) -> Block:
        data, offsets = flat(pa.array([t for _, t in rows], pa.string()))
        h, first = tokens(data, offsets)
        size = np.diff(first)
        key, item, place, short = [], [], [], {}
        for n in range(1, least):
            few = np.flatnonzero(size == n)
            hashes = np.array([windows(h[a : a + n], n)[0] for a in first[few].tolist()], U)
            order = np.argsort(hashes, kind="stable")
            short[n] = hashes[order], few[order]
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if b - a >= least:
                w = windows(h[a:b], least)
                key.append(w)
                item.append(np.full(len(w), i))
                place.append(np.arange(len(w)))
        if not key:
            return cls([i for i, _ in rows], size, np.zeros(0, U), np.zeros(0, int), np.zeros(0, int), short)
        key, item, place = map(np.concatenate, (key, item, place))
        order = np.argsort(key, kind="stable")
        return cls([i for i, _ in rows], size, key[order], item[order], place[order], short)


def needed(size: int, coverage: float) -> float:
    """Tokens of an item that tiles must cover."""
    return max(coverage * size, min(size, SHORTEST))


def best_tiles(place: np.ndarray, where: np.ndarray, size: int, least: int, need: float) -> tuple[int, list[tuple[int, int, int]]]:
    """Most tokens covered by the tiles of a stretch of ``SPREAD * size`` document tokens, and these tiles, from all seeds of a
    document and an item; (0, []) if no stretch reaches ``need``. A stretch is tiled only if the item tokens of its seeds
    are more than the best so far."""
    order = np.lexsort((place, where))
    place, where = place[order], where[order]
    most = SPREAD * size
    stop = np.searchsorted(where, where + most - least, side="right")
    held = np.zeros(size, np.int64)  # seeds of the stretch that hold each item token
    best: tuple[int, list] = (0, [])
    right, bound = 0, 0
    places, stops = place.tolist(), stop.tolist()
    for left, end in enumerate(stops):
        grown = end > right
        for k in range(right, end):
            token = held[places[k] : places[k] + least]
            bound += int((token == 0).sum())
            token += 1
        right = end
        if grown and bound >= need and bound > best[0]:  # else part of an earlier stretch
            tiles = tile(np.column_stack((place[left:end], where[left:end])), least)
            covered = sum(t[0] for t in tiles)
            if covered >= need and covered > best[0] and (size >= SHORTEST or len(tiles) == 1):
                best = (covered, tiles)
        token = held[places[left] : places[left] + least]
        token -= 1
        bound -= int((token == 0).sum())
        if best[0] == size:
            break
    return best


def tile(pairs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the seeds ``(place in item, place in document)`` of a pair: tiles
    ``(length, place in item, place in document)``."""
    order = np.lexsort((pairs[:, 0], pairs[:, 1] - pairs[:, 0]))
    i, j = pairs[order, 0], pairs[order, 1]
    new = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1))))
    length = np.diff(np.concatenate((new, [len(i)]))) + least - 1
    heap = [(-n, a, b) for n, a, b in zip(length.tolist(), i[new].tolist(), j[new].tolist())]
    heapq.heapify(heap)
    mine, theirs, out = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [a + k not in mine and b + k not in theirs for k in range(n)]
        if all(free):
            mine.update(range(a, a + n))
            theirs.update(range(b, b + n))
            out.append((n, a, b))
            continue
        k = 0
        while k < n:
            stop = k
            while stop < n and free[stop]:
                stop += 1
            if stop - k >= least:
                heapq.heappush(heap, (k - stop, a + k, b + k))
            k = max(stop, k) + 1
    return out


def search(block: Block, data: np.ndarray, offsets: np.ndarray, least: int, coverage: float) -> Iterator[tuple[int, int, int, list]]:
    """``(document, item, covered tokens, tiles)`` for the contaminated documents of a slice."""
    h, first = tokens(data, offsets)
    for n, (hashes, items) in block.short.items():
        w = windows(h, n)
        if not len(hashes) or not len(w):
            continue
        at = np.flatnonzero(np.isin(w, hashes))
        doc = np.searchsorted(first, at, side="right") - 1
        at, doc = at[at + n <= first[doc + 1]], doc[at + n <= first[doc + 1]]
        left, right = np.searchsorted(hashes, w[at]), np.searchsorted(hashes, w[at], side="right")
        _, once = np.unique(doc * len(hashes) + left, return_index=True)
        for d, a, x, y in zip(doc[once].tolist(), at[once].tolist(), left[once].tolist(), right[once].tolist()):
            for i in items[x:y].tolist():
                yield d, i, n, [(n, 0, a - int(first[d]))]
    w = windows(h, least)
    if not len(w) or not len(block.key):
        return
    seen = np.zeros(1 << 18, bool)
    seen[(block.key >> U(46)).astype(np.int64)] = True
    at = np.flatnonzero(seen[(w >> U(46)).astype(np.int64)])
    left, right = np.searchsorted(block.key, w[at]), np.searchsorted(block.key, w[at], side="right")
    at, left, n = at[right > left], left[right > left], (right - left)[right > left]
    doc = np.searchsorted(first, at, side="right") - 1
    whole = at + least <= first[doc + 1]
    at, left, n, doc = at[whole], left[whole], n[whole], doc[whole]
    hit = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
    item, place, where, doc = block.item[hit], block.place[hit], np.repeat(at - first[doc], n), np.repeat(doc, n)
    order = np.lexsort((place, item, doc))
    item, place, where, doc = item[order], place[order], where[order], doc[order]
    edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]), [True]))) if len(doc) else []
    for a, b in zip(edge[:-1], edge[1:]):
        size = int(block.sizes[item[a]])
        distinct = np.unique(place[a:b])
        bound = int(np.minimum(np.diff(np.append(distinct, distinct[-1] + least)), least).sum())
        need = needed(size, coverage)
        if bound >= need:
            covered, tiles = best_tiles(place[a:b], where[a:b], size, least, need)
            if covered:
                yield int(doc[a]), int(item[a]), covered, tiles


def blocks(benchmark: DataFrame, least: int = LEAST) -> Iterator[tuple[Block, bool]]:
    """The benchmark in blocks of bounded size, and whether there are several."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    count = max(1, -(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield Block.of([(r.item_id, r.text) for r in items.where(part == k).orderBy("item_id", "text").collect()], least), count > 1


def matches(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """Contaminated documents: ``doc_id, item_id, coverage, n_tiles, longest_tile`` for each pair."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, coverage double, n_tiles int, longest_tile int"

    def rows(block: Block):
        def of(batches):
            for batch in slices(batches):
                ids = batch.column("doc_id").to_pylist()
                found = list(search(block, *flat(batch.column("text")), least, coverage))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[d] for d, *_ in found], pa.int64()),
                        pa.array([block.ids[i] for _, i, *_ in found], pa.int64()),
                        pa.array([c / int(block.sizes[i]) for _, i, c, _ in found], pa.float64()),
                        pa.array([len(t) for *_, t in found], pa.int32()),
                        pa.array([max(t)[0] for *_, t in found], pa.int32()),
                    ],
                    names=["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"],
                )

        return of

    out = None
    for block, several in blocks(benchmark, least):
        part = plain.mapInArrow(rows(block), schema)
        if several:  # one block at a time in the driver
            part = stage(part, "op8-matches")
        out = part if out is None else out.union(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, that no item contaminates."""

    def rows(block: Block):
        def of(batches):
            for batch in slices(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, *_ in search(block, *flat(batch.column("text")), least, coverage)]] = False
                yield batch.filter(pa.array(keep))

        return of

    for block, several in blocks(benchmark, least):
        docs = docs.mapInArrow(rows(block), docs.schema)
        if several:
            docs = stage(docs, "op8-kept")
    return docs


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The registered query: one row per contaminated document, with its items from most covered on."""
    found = matches(docs, benchmark)
    items = F.sort_array(F.collect_set(F.struct("coverage", "item_id", "n_tiles")), asc=False)
    return found.groupBy("doc_id").agg(F.max("coverage").alias("coverage"), F.max("longest_tile").alias("longest_tile"), F.transform(items, lambda x: x["item_id"]).alias("item_ids"))
