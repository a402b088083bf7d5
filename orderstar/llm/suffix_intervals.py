"""Substring deduplication by the common-prefix interval tree of an enhanced suffix array.

A byte is removed when a string of ``length`` bytes that covers it also starts earlier (in a document of a
smaller id, or earlier in the same document; of the texts under one id, that of the smaller hash is first). Matches may overlap and never cross documents.

The suffixes are sampled by content so that the corpus never meets in one array. Every window of ``length``
bytes belongs to the smallest of its ``GRAM``-byte grams (the leftmost of equal ones), its *anchor*; equal
windows have equal anchors at equal places, so only windows of one anchor gram need comparing. The windows of
one anchor occurrence are a range, and the bytes they span are its *context*.

1. Anchors whose gram occurs once are dropped (a count per gram, then a join).
2. Equal contexts of a gram form a class. All windows of an occurrence that is not the first of its class
   occur earlier, whatever the size of the class.
3. Only the first occurrence of each class, where a gram has several, needs its bytes. The contexts of a gram
   meet in one task, which builds the suffix array of all their windows with the lengths of common prefixes,
   keeps the groups with different left extensions, and scans it with a stack: each interval of the tree is a
   maximal repeat group with all its occurrences. Every occurrence but the first is covered.
   A gram with more than ``dense`` contexts is not gathered: its windows are rows that Spark groups by hash,
   which gives the same cover.
4. The covered runs of a document are united and cut out.

Cases: a null text counts as empty and keeps its row; texts under ``length`` bytes are kept whole; a null id
comes before all others; repeated rows (equal id and text) are one occurrence and are kept alike; different texts under
one id, a null id too, are documents of their own (a document is its id and the hash of its text, ``row``); 
very long texts are read whole, as a slice of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import U, flat, mix, prefix_hash, range_hash, runs, signed, slices, slide

LENGTH = 100
GRAM = 32
#: Contexts of a gram that one task may gather; beyond it the windows are grouped by Spark instead.
DENSE = 2000
#: Bytes of contexts a task gathers before it sorts them.
GATHER_BYTES = 2 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray, length: int, gram: int):
    """Anchors of all documents of a batch: positions, document indexes, first and last + 1 window start."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    begin = np.arange(len(data) - gram + 1)
    h = range_hash(prefix, begin, begin + gram)
    doc_end = np.repeat(offsets[1:], np.diff(offsets))
    h[begin + gram > doc_end[begin]] = U(0xFFFFFFFFFFFFFFFF)
    low = slide(h, length - gram + 1, np.minimum)
    starts = np.flatnonzero(np.arange(len(low)) + length <= doc_end[: len(low)])
    if not len(starts):
        return none, none, none, none
    low = low[starts]
    at = starts.copy()  # the anchor of each window: the first position from its start on with the smallest hash
    # candidates: positions that are the smallest of some window
    width = length - gram + 1
    full = np.zeros(len(h), U)
    full[starts] = low
    padded = np.concatenate((np.zeros(width - 1, U), full))
    candidate = np.flatnonzero((slide(padded, width, np.maximum) == h) & (h != U(0xFFFFFFFFFFFFFFFF)))
    index = np.searchsorted(candidate, starts)
    todo = np.arange(len(starts))
    while len(todo):
        at[todo] = candidate[index[todo]]
        todo = todo[h[at[todo]] != low[todo]]
        index[todo] += 1
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]))))
    first = starts[new]
    last = starts[np.concatenate((new[1:] - 1, [len(starts) - 1]))] + 1
    doc = np.searchsorted(offsets, at[new], side="right") - 1
    return at[new], doc, first, last


def anchor_rows(length: int, gram: int):
    """One row per anchor. A context that a document repeats counts once there: its later occurrences are
    covered whatever other documents hold, and come as united ranges (``own``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            prefix = prefix_hash(data)
            at, doc, first, last = anchors(data, offsets, prefix, length, gram)
            ids, texts = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "row"))
            g = range_hash(prefix, at, at + gram)
            c = mix(range_hash(prefix, first, last - 1 + length) + (at - first).astype(U) * U(0x9E3779B97F4A7C15))
            order = np.lexsort((first, c, g, doc))
            again = np.zeros(len(at), bool)
            x, y = order[1:], order[:-1]
            again[x] = (doc[x] == doc[y]) & (g[x] == g[y]) & (c[x] == c[y])
            # shifted by the document, so that runs of different documents do not touch
            lo, hi = runs((first + doc)[again], (last - 1 + length + doc)[again])
            some = np.flatnonzero(again)
            owner = doc[some[np.searchsorted((first + doc)[some], lo)]] if len(lo) else doc[:0]
            mark = g[some[np.searchsorted((first + doc)[some], lo)]] if len(lo) else g[:0]
            lo, hi = lo - owner, hi - owner
            g, c, doc, first, n = g[~again], c[~again], doc[~again], first[~again], (last - first)[~again]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((signed(g), signed(mark)))),
                    pa.array(np.concatenate((signed(c), np.zeros(len(lo), np.int64)))),
                    pa.array(np.concatenate((ids[doc], ids[owner]))),
                    pa.array(np.concatenate((texts[doc], texts[owner]))),
                    pa.array(np.concatenate((first - offsets[doc], lo - offsets[owner]))),
                    pa.array(np.concatenate((n, hi - lo - length + 1)).astype(np.int32)),
                    pa.array(np.arange(len(g) + len(lo)) >= len(g)),
                ],
                names=["g", "c", "id", "row", "first", "n", "own"],
            )

    return rows


def gram_rows(length: int, gram: int):
    """The grams of the anchors (twice where a document repeats a context: it need not occur elsewhere)."""
    inner = anchor_rows(length, gram)
    return lambda batches: (b.select(["g"]) for b in inner(batches))


def context_rows(length: int):
    """The bytes of the listed windows: one row per context."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            wanted = batch.column("wanted")
            item = wanted.values.flatten() if hasattr(wanted.values, "flatten") else wanted.values
            lo = wanted.offsets.to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lo))
            fields = {wanted.type.value_type.field(i).name: np.asarray(item[i])[lo[0] : lo[-1]] for i in range(len(item))}
            begin = offsets[doc] + fields["first"]
            size = fields["n"] - 1 + length
            at = np.zeros(len(size) + 1, np.int64)
            np.cumsum(size, out=at[1:])
            take = np.arange(at[-1]) - np.repeat(at[:-1] - begin, size)
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(data[take])])
            ids, texts = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "row"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(fields["g"]), pa.array(fields["q"]), pa.array(ids[doc]), pa.array(texts[doc]), pa.array(fields["first"]), binary.cast(pa.binary())],
                names=["g", "q", "id", "row", "first", "context"],
            )

    return rows


def suffix_groups(data: np.ndarray, offsets: np.ndarray, length: int):
    """Maximal repeat groups of at least ``length`` bytes among the suffixes of several byte strings.

    Returns a list of ``(depth, members)``, the members being positions in ``data``. The suffix array orders
    the suffixes by the rank of their first ``length`` bytes and then by the following bytes. Groups whose
    members all have the same byte before them are left to the longer group that starts one byte earlier.
    """
    prefix = prefix_hash(data)
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    total = int(windows.sum())
    if not total:
        return []
    start = np.arange(total) + np.repeat(offsets[:-1] - (np.cumsum(windows) - windows), windows)
    stop = np.repeat(offsets[1:], windows)
    key = range_hash(prefix, start, start + length)
    order = np.argsort(key, kind="stable")
    same = np.concatenate(([False], key[order][1:] == key[order][:-1]))
    head = np.flatnonzero(~same)
    count = np.diff(np.concatenate((head, [total])))
    # left extension: the byte before, or one of its own for the first window of a string
    opening = np.zeros(len(data) + 1, bool)
    opening[offsets[:-1]] = True
    left = np.where(opening[start], -1 - np.arange(total), data[np.maximum(start - 1, 0)].astype(np.int64))[order]
    diverse = (np.minimum.reduceat(left, head) != np.maximum.reduceat(left, head)) & (count > 1)
    out = []
    for h, n in zip(head[diverse].tolist(), count[diverse].tolist()):
        members = order[h : h + n]
        p, room = start[members], stop[members] - start[members] - length
        out += _intervals(data, p, room, length)
    return out


def _intervals(data: np.ndarray, p: np.ndarray, room: np.ndarray, length: int):
    """Stack scan over the suffixes ``p`` that share ``length`` bytes: ``(depth, members)`` of each interval
    of the common-prefix interval tree."""
    tails = [data[a + length : a + length + r].tobytes() for a, r in zip(p.tolist(), room.tolist())]
    order = sorted(range(len(p)), key=tails.__getitem__)
    lcp = [0]
    for i in range(1, len(order)):
        a, b = tails[order[i - 1]], tails[order[i]]
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            lcp.append(n)
        else:
            x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
            lcp.append(int(np.argmax(x != y)))
    lcp.append(-1)
    out, stack = [], []  # (depth, left bound)
    for i in range(1, len(lcp)):
        bound = i - 1
        while stack and stack[-1][0] > lcp[i]:
            depth, bound = stack.pop()
            out.append((length + depth, p[order[bound:i]]))
        if i < len(order) and (not stack or stack[-1][0] < lcp[i]):
            stack.append((lcp[i], bound))
    return out


def group_rows(length: int):
    """Cover of the contexts of each gram: rows come sorted by gram, and a gram is never cut."""

    def cover(ids, rows, first, texts):
        # documents by their rank
        order = np.lexsort((rows, ids))
        ids, rows, rank = ids[order], rows[order], np.zeros(len(ids), np.int64)
        new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])))[: len(ids)]
        rank[order] = np.cumsum(new) - 1
        ids, rows = ids[new], rows[new]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        data = np.frombuffer(b"".join(texts), np.uint8)
        who, lo, hi = [], [], []
        for depth, members in suffix_groups(data, offsets, length):
            owner = np.searchsorted(offsets, members, side="right") - 1
            place = first[owner] + members - offsets[owner]
            least = np.lexsort((place, rank[owner]))[0]
            keep = (rank[owner] != rank[owner[least]]) | (place != place[least])
            who.append(rank[owner][keep])
            lo.append(place[keep])
            hi.append(place[keep] + depth)
        who, lo, hi = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, lo, hi))
        # the groups of a tree are nested and overlap: one row per covered run of a document
        order = np.lexsort((lo, who))
        who, lo, hi = who[order], lo[order], hi[order]
        out = []
        edge = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1], [True]))) if len(who) else []
        for a, b in zip(edge[:-1], edge[1:]):
            x, y = runs(lo[a:b], hi[a:b])
            out.append((np.full(len(x), who[a]), x, y))
        who, lo, hi = (np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(3))
        return ids[who], rows[who], lo, hi

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0

        def done(whole: bool):
            nonlocal held, size
            g = np.concatenate([x[0] for x in held])
            cut = len(g) if whole else int(np.searchsorted(-(g[::-1] == g[-1]).astype(int), 0))
            cut = len(g) if whole else len(g) - cut
            ids, rows, first = (np.concatenate([x[i] for x in held]) for i in (1, 2, 3))
            texts = [t for x in held for t in x[4]]
            out = cover(ids[:cut], rows[:cut], first[:cut], texts[:cut])
            held = [(g[cut:], ids[cut:], rows[cut:], first[cut:], texts[cut:])]
            size = sum(map(len, texts[cut:]))
            return pa.RecordBatch.from_arrays([*map(pa.array, out)], names=["id", "row", "lo", "hi"])

        for batch in batches:
            texts = batch.column("context").to_pylist()
            held.append((*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "id", "row", "first")), texts))
            size += sum(map(len, texts))
            if size > GATHER_BYTES:
                yield done(False)
        if held:
            yield done(True)

    return rows


def window_rows(length: int):
    """Every window of a context by its hash (for grams with very many contexts)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "context"):
            data, offsets = flat(batch.column("context"))
            prefix = prefix_hash(data)
            windows = np.diff(offsets) - length + 1
            inside = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
            start = np.repeat(offsets[:-1], windows) + inside
            second = mix(range_hash(prefix, start, start + length // 2) * U(3) + range_hash(prefix, start + length // 2, start + length))
            ids, texts, first = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), windows) for c in ("id", "row", "first"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(range_hash(prefix, start, start + length))), pa.array(signed(second)), pa.array(ids), pa.array(texts), pa.array(first + inside)],
                names=["h", "k", "id", "row", "lo"],
            )

    return rows


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, dense: int = DENSE) -> DataFrame:
    """``(id, row, lo, hi)``: byte ranges of ``docs (id, row, text)`` that occur earlier; ranges may overlap."""
    docs = docs.select("id", "row", "text")
    row = "g long, c long, id long, row long, first long, n int, own boolean"
    shared = stage(docs.mapInArrow(gram_rows(length, gram), "g long").groupBy("g").count().where("count > 1").select("g"), "op10-grams")
    found = stage(docs.mapInArrow(anchor_rows(length, gram), row).join(shared, "g"), "op10-anchors")
    span = ("id", "row", F.col("first").alias("lo"), (F.col("first") + F.col("n") - 1 + length).alias("hi"))
    own, found = found.where("own").select(*span), found.where("not own").drop("own")
    classes = stage(found.groupBy("g", "c").agg(F.min(F.struct("id", "row", "first", "n")).alias("low")), "op10-classes")
    several = stage(classes.groupBy("g").agg(F.count(F.lit(1)).alias("q")).where("q > 1"), "op10-several")
    later = (
        found.join(classes.select("g", "c", "low"), ["g", "c"])
        .where(F.struct("low.id", "low.row", "low.first") != F.struct("id", "row", "first"))
        .select(*span)
    )
    heads = classes.join(several, "g").select("low.id", "low.row", F.struct("g", "q", "low.first", "low.n").alias("w"))
    wanted = stage(heads.groupBy("id", "row").agg(F.collect_list("w").alias("wanted")), "op10-heads")
    contexts = stage(
        docs.join(wanted, ["id", "row"]).select("id", "row", "text", "wanted").mapInArrow(context_rows(length), "g long, q long, id long, row long, first long, context binary"),
        "op10-contexts",
    )
    few = contexts.where(F.col("q") <= dense).select("g", "id", "row", "first", "context")
    spread = few.repartition("g").sortWithinPartitions("g").mapInArrow(group_rows(length), "id long, row long, lo long, hi long")
    many = stage(
        contexts.where(F.col("q") > dense).select("id", "row", "first", "context").mapInArrow(window_rows(length), "h long, k long, id long, row long, lo long"), "op10-windows"
    )
    low = stage(many.groupBy("h", "k").agg(F.min(F.struct("id", "row", "lo")).alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "k", "low"), "op10-low")
    hot = many.join(low, ["h", "k"]).where(F.struct("id", "row", "lo") != F.col("low")).select("id", "row", "lo", (F.col("lo") + length).alias("hi"))
    return own.union(later).union(spread).union(hot)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offsets = flat(batch.column("text"))
        spans = batch.column("spans")
        lists = spans.to_pylist()
        kept, removed, n_spans = [], [], []
        for i in range(batch.num_rows):
            text = data[offsets[i] : offsets[i + 1]]
            mine = lists[i]
            if mine:
                lo, hi = (np.minimum([s[k] for s in mine], len(text)) for k in ("lo", "hi"))
                lo, hi = runs(lo, hi)
                mask = np.zeros(len(text) + 1, np.int8)
                mask[lo] += 1
                mask[hi] -= 1
                text = text[np.cumsum(mask[:-1]) == 0]
            else:
                lo = hi = ()
            kept.append(text.tobytes())
            removed.append(int(np.sum(np.subtract(hi, lo))) if len(lo) else 0)
            n_spans.append(len(lo))
        yield pa.RecordBatch.from_arrays(
            [pc.if_else(batch.column("missing"), None, batch.column("id")), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, dense: int = DENSE) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes)."""
    nothing = F.lit(-(1 << 63)).cast("long")
    missing = F.col("doc_id").isNull()
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), nothing).alias("id"), F.col("text").cast("string").alias("text"), missing.alias("missing"))
    # a document without an id is none of that number
    docs = docs.withColumn("row", F.xxhash64(F.coalesce("text", F.lit("")), "missing"))
    spans = repeated_spans(docs, length, gram, dense)
    lists = stage(spans.groupBy("id", "row").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "op10-spans")
    cut = docs.join(lists, ["id", "row"], "left").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut


def digest(docs: DataFrame) -> DataFrame:
    """The registered query: the lengths and the hash of the kept bytes."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
