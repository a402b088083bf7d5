"""Substring deduplication by sliding sentence spans.

A sentence ends with a word whose last character, closing quotes and brackets aside, is ``.``, ``!``, ``?`` or such a mark of
another script (full-width ones also inside a word), or at a line break. Each character of a script without blanks is a
word. Long sentences and text without marks are cut further at content-defined words: in every ``WINDOW`` neighbouring words
that are ``EDGE`` words from both ends of the sentence, a new unit begins at the word with the smallest hash. Where a unit
begins depends on at most ``EDGE + WINDOW`` words around it, so a passage is cut alike between any neighbours; sentences of
under ``2 * EDGE + WINDOW - 1`` words stay whole. Units count as sentences in all that follows.

From every sentence on, the shortest run of at least ``RUN`` sentences and ``MIN_WORDS`` words is a span, known by a 128-bit hash of its words.
Spans that occur again are joined globally; the first occurrence (smallest doc_id, then place) stays, and a
sentence covered by any other occurrence of a repeated span is removed.

Hashes that occur once leave after a count per hash; the join that brings the repeated ones back has written
tables on both sides, so Spark can split a hash with very many occurrences. A document's spans meet in its row.

Cases: null and empty texts stay as they are with 0 sentences; a text of fewer than ``RUN`` sentences or
``MIN_WORDS`` words has no span; a null id comes before all others; repeated rows (equal id and text) are one
occurrence and stay alike; different texts under one id, a null id too, are documents of their own (a document is its id
and the hash of its text, ``row``), ordered by the hash; very long texts are read whole, as a slice of their own; 
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import U, code_points, flat, mix, powers, prefix_hash, range_hash, runs, signed, slices, units

RUN = 2
MIN_WORDS = 12

#: Words between a cut inside a sentence and its ends, and words of which one begins a unit.
EDGE = 4
WINDOW = 8

STOP, CLOSING = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
STOP[[*map(ord, ".!?…‼؟۔।॥።။។。！？．｡")]] = True
CLOSING[[*map(ord, "\"')]}>*_`«»‘’“”›〉》」』】〕＂＇）］｝")]] = True
PLAIN = np.zeros(256, bool)
PLAIN[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True


def stops(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each word ends a sentence: its last character that is not a closing sign is a stop."""
    out = np.zeros(len(start), bool)
    todo = np.flatnonzero(~PLAIN[data[end - 1]])
    stop = end[todo]
    while len(todo):
        at = stop - 1
        for _ in range(2):  # back to the first byte of the character (three bytes at most matter)
            at = np.where(((data[at] & 0xC0) == 0x80) & (at > start[todo]), at - 1, at)
        code = code_points(data, at)
        out[todo] = STOP[code]
        more = CLOSING[code] & (at > start[todo])
        todo, stop = todo[more], at[more]
    return out


def cuts(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The words inside long sentences at which a new unit begins."""
    size = np.diff(begin)
    long = np.flatnonzero(size >= 2 * EDGE + WINDOW - 1)
    n = size[long] - 2 * EDGE - WINDOW + 2  # windows of each
    at = np.arange(int(n.sum())) + np.repeat(begin[long] + EDGE - (np.cumsum(n) - n), n)
    best, low = at, range_hash(prefix, start[at], end[at])
    for k in range(1, WINDOW):
        h = range_hash(prefix, start[at + k], end[at + k])
        best, low = np.where(h < low, at + k, best), np.minimum(h, low)
    return np.unique(best)


def sentences(data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray):
    """Word starts and ends, the first word of each sentence (and the end), the first sentence of each document."""
    start, end, first = units(data, offsets)
    if not len(start):
        return start, end, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    last = stops(data, start, end)
    last[:-1] |= lines[start[1:]] > lines[end[:-1]]
    last[first[1:][np.diff(first) > 0] - 1] = True
    begin = np.concatenate(([0], np.flatnonzero(last) + 1))
    begin = np.sort(np.concatenate((begin, cuts(prefix, start, end, begin))))
    return start, end, begin, np.searchsorted(begin[:-1], first)


def spans(begin: np.ndarray, first: np.ndarray, run: int, least: int):
    """Sentence spans ``(document, first, last + 1)``."""
    n = len(begin) - 1
    at = np.arange(n)
    doc = np.searchsorted(first, at, side="right") - 1
    stop = np.maximum(at + run, np.searchsorted(begin, begin[:-1] + least))
    keep = stop <= first[doc + 1]
    return doc[keep], at[keep], stop[keep]


def span_rows(run: int, least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            prefix = prefix_hash(data)
            start, end, begin, first = sentences(data, offsets, prefix)
            doc, a, b = spans(begin, first, run, least)
            h = range_hash(prefix, start, end)
            forward, inverse = powers(len(h) + 1)
            both = []
            for salt in (1, 2):
                total = np.concatenate((np.zeros(1, U), np.cumsum(mix(h + U(salt)) * forward[:-1])))
                both.append(mix((total[begin[b]] - total[begin[a]]) * inverse[begin[a]] + (begin[b] - begin[a]).astype(U)))
            ids, texts = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "row"))
            place = (a - first[doc]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(both[0])), pa.array(signed(both[1])), pa.array(ids[doc]), pa.array(texts[doc]), pa.array(place), pa.array((b - first[doc]).astype(np.int32))],
                names=["h", "k", "id", "row", "lo", "hi"],
            )

    return rows


def hash_rows(run: int, least: int):
    inner = span_rows(run, least)
    return lambda batches: (b.select(["h"]) for b in inner(batches))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offsets = flat(batch.column("text"))
        start, end, begin, first = sentences(data, offsets, prefix_hash(data))
        lists = batch.column("spans").to_pylist()
        raw = batch.column("text")
        n_sentences, removed, n_spans, kept = np.diff(first), [], [], []
        for i, mine in enumerate(lists):
            if not mine:
                removed.append(0)
                n_spans.append(0)
                kept.append(raw[i].as_py())
                continue
            lo, hi = (np.minimum([s[c] for s in mine], n_sentences[i]) for c in ("lo", "hi"))
            lo, hi = runs(lo, hi)
            mask = np.ones(offsets[i + 1] - offsets[i], bool)
            for a, b in zip((first[i] + lo).tolist(), (first[i] + hi).tolist()):
                # from the run's first word up to the next kept word, or the end
                stop = start[begin[b]] if b < first[i + 1] else offsets[i + 1]
                mask[start[begin[a]] - offsets[i] : stop - offsets[i]] = False
            removed.append(int((hi - lo).sum()))
            n_spans.append(len(lo))
            kept.append(data[offsets[i] : offsets[i + 1]][mask].tobytes().decode())
        yield pa.RecordBatch.from_arrays(
            [pc.if_else(batch.column("missing"), None, batch.column("id")), pa.array(n_sentences, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_sentences", "n_removed", "n_spans", "text"],
        )


def remove_spans(docs: DataFrame, run: int = RUN, least: int = MIN_WORDS) -> DataFrame:
    """Per document: ``doc_id, n_sentences, n_removed, n_spans`` (maximal removed runs) and the kept ``text``."""
    nothing = F.lit(-(1 << 63)).cast("long")
    missing = F.col("doc_id").isNull()
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), nothing).alias("id"), F.col("text").cast("string").alias("text"), missing.alias("missing"))
    # a document without an id is none of that number
    docs = docs.withColumn("row", F.xxhash64(F.coalesce("text", F.lit("")), "missing"))
    again = stage(docs.mapInArrow(hash_rows(run, least), "h long").groupBy("h").count().where("count > 1").select("h"), "op9-hashes")
    found = stage(docs.mapInArrow(span_rows(run, least), "h long, k long, id long, row long, lo int, hi int").join(again, "h"), "op9-found")
    low = stage(found.groupBy("h", "k").agg(F.min(F.struct("id", "row", "lo")).alias("low")), "op9-low")
    later = found.join(low, ["h", "k"]).where(F.struct("id", "row", "lo") != F.col("low")).select("id", "row", "lo", "hi")
    lists = stage(later.groupBy("id", "row").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "op9-spans")
    cut = docs.join(lists, ["id", "row"], "left").mapInArrow(_cut, "doc_id long, n_sentences long, n_removed long, n_spans long, text string")
    return cut


def digest(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return remove_spans(docs)
