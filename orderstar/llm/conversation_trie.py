"""Prefix trie of conversations, from adaptive radix trees over fixed-width turn ids.

A turn's id is 16 bytes, big-endian: the first half of the SHA-256 of its role and text. A conversation is the
concatenation of its turns' ids, so the byte order of the keys is the order of the trie and a shared prefix of
turns is a shared prefix of bytes. An adaptive radix tree (:class:`Node`: 4, 16, 48 or 256 children, grown when
full; single-child paths are compressed) takes the sorted keys of a slice; of its byte depths only the
multiples of 16 become nodes of the trie (:func:`trie_nodes`).

How it is spread. Conversations are ranked by a range partitioning (``turn_blocks``), so no task needs all turns of one
of them; keys are cut into segments of 64 turns, each named by a hash of what precedes it. Equal segments
collapse before the trees are built, so a conversation with very many copies is one key. Segments are ranged by
their bytes; a task builds trees of at most 20,000 keys or 8 MB. A node off the border paths of its tree
has all its members there and is final. Nodes on a border path ("open": at most the turns of two keys for each
tree) are merged by their hash, and what they add to the nodes above them is summed in Spark. Segments below
segments are summed by pointer doubling. The ids of a node's ended conversations are packed into chunks in
sorted order, and a hash runs over the chunks of a node as a stream.

Cases: a null role or text counts as empty; rows with a null conv_id belong to no conversation and are left out; a
null turn comes first, equal turns are ordered by their turn id, repeated rows are turns of their own; very
long texts only pass the hash; an empty table has no nodes (not even a root); further columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import flat
from orderstar.operators.sizing import broadcast_if_within

#: Bytes of a turn id, turns of a key, keys and bytes of a tree, and bytes of a chunk of conversation ids.
ID = 16
SEGMENT = 64
TREE_KEYS = 20_000
TREE_BYTES = 8 << 20
CHUNK_BYTES = 1 << 16
WHOLE = 1 << 30
ZERO = bytes(ID)


# ---------------------------------------------------------------- adaptive radix tree


class Node:
    """A node of the tree: the compressed ``path`` that leads to it, the number of the key that ends here (or -1) and
    its children by their next byte, in the smallest of four layouts."""

    __slots__ = ("path", "end", "layout", "keys", "kids")

    def __init__(self, path: bytes, end: int = -1):
        self.path, self.end, self.layout, self.keys, self.kids = path, end, 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            i = self.keys.find(byte)
            return self.kids[i] if i >= 0 else None
        if self.layout == 48:
            return self.kids[self.keys[byte] - 1] if self.keys[byte] else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        """Adds a child, or replaces the one under ``byte``; a full layout grows first."""
        if self.layout <= 16:
            i = bisect_left(self.keys, byte)
            if i < len(self.keys) and self.keys[i] == byte:
                self.kids[i] = kid
            elif len(self.keys) < self.layout:
                self.keys.insert(i, byte)
                self.kids.insert(i, kid)
            else:
                self._grow()
                self.put(byte, kid)
        elif self.layout == 48:
            if self.keys[byte]:
                self.kids[self.keys[byte] - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.keys[byte] = len(self.kids)
            else:
                self._grow()
                self.put(byte, kid)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:  # a slot number for every byte
            index = bytearray(256)
            for slot, byte in enumerate(self.keys):
                index[byte] = slot + 1
            self.layout, self.keys = 48, index
        else:  # a child for every byte
            self.layout, self.kids, self.keys = 256, [self.kids[s - 1] if s else None for s in self.keys], bytearray()

    def children(self) -> list[Node]:
        """In the order of their bytes."""
        if self.layout <= 16:
            return self.kids
        if self.layout == 48:
            return [self.kids[s - 1] for s in self.keys if s]
        return [kid for kid in self.kids if kid is not None]


def shared(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def insert(root: Node, key: bytes, number: int) -> None:
    """Adds ``key``; ``root`` has an empty path. A path that only begins like the key is split."""
    above, node, at = None, root, 0
    while True:
        same = shared(node.path, key[at : at + len(node.path)])
        if same < len(node.path):
            upper = Node(node.path[:same])
            above.put(node.path[0], upper)
            node.path = node.path[same:]
            upper.put(node.path[0], node)
            node = upper
        at += same
        if at == len(key):
            node.end = number
            return
        kid = node.child(key[at])
        if kid is None:
            node.put(key[at], Node(key[at:], number))
            return
        above, node = node, kid


def trie_nodes(root: Node) -> tuple[list[int], list[int], list[int]]:
    """The turn-aligned depths of a tree in the order of their keys, parents first: parent's index (-1 for the first, at
    depth 0), depth in turns, number of the key that ends there (or -1)."""
    parent, depth, key = [-1], [0], [-1]
    stack = [(root, 0, 0)]
    while stack:
        node, begin, above = stack.pop()
        end = begin + len(node.path)
        for d in range(begin // ID + 1, end // ID + 1):
            parent.append(above)
            depth.append(d)
            key.append(-1)
            above = len(parent) - 1
        if node.end >= 0:
            key[above] = node.end
        stack.extend((kid, end, above) for kid in reversed(node.children()))
    return parent, depth, key


# ---------------------------------------------------------------- turns, blocks and segments


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, id, n_words`` of every row; texts go no further than this."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_id = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(turn_id, 1, 2 * ID)).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("n_words"),
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most 64 turns of a conversation, from rows in order; ``at`` counts the conversation's rows in this
    partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv_id").to_numpy()
        run = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        size = np.diff(np.append(run, n))
        local = np.arange(n) - np.repeat(run, size)
        begin = np.flatnonzero(local % SEGMENT == 0)
        if conv[0] == last:
            local[: size[0]] += seen
        last, seen = conv[-1], int(local[-1]) + 1
        ends = np.append(begin[1:], n)
        ids, _ = flat(batch.column("id"))
        offsets = np.append(begin, n).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(conv[begin]), pa.array(np.full(len(begin), part, np.int64)), pa.array(local[begin]), pa.array(ends - begin),
                pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets * np.int32(ID)), pa.py_buffer(np.ascontiguousarray(ids))]),
                pa.ListArray.from_arrays(pa.array(offsets), batch.column("n_words").cast(pa.int64())),
            ],
            names=["conv_id", "part", "at", "n", "ids", "words"],
        )


def turn_blocks(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, n, ids, words``: the turns of every conversation in order, in runs of at most 64, ``at`` being the
    first one's place.

    Rows are ranged by conversation, turn and id, so a conversation with very many turns lies in several partitions;
    the counts of its earlier partitions (at most one row for each partition, as only its first conversation can have
    begun before) are added to the places."""
    slim = stage(turns(conversations).withColumn("row", F.monotonically_increasing_id()), "op11-turns")
    order = ["conv_id", "turn", "id", "row"]
    runs = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = stage(runs.mapInArrow(_blocks, "conv_id long, part long, at long, n long, ids binary, words array<long>"), "op11-blocks")
    held = blocks.groupBy("conv_id", "part").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("before", F.sum("held").over(earlier)).where("before is not null").drop("held")
    return blocks.join(F.broadcast(before), ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "n", "ids", "words")


def _joined(pieces: str) -> list[Column]:
    """The ids and words of an array of structs (place, ids, words), one after the other."""
    ordered = F.sort_array(F.col(pieces))
    return [
        F.aggregate(ordered, F.lit(bytearray()), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.flatten(F.transform(ordered, lambda x: x["words"])).alias("words"),
    ]


def rebuilt(blocks: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """Every conversation c behind the first h turns of conversation ``c - c % group`` (as many as there are) instead of its
    own first h turns; h is the CRC-32 of c's decimal digits modulo ``most + 1``. Pieces ``conv_id, at, ids, words, total``; each
    conversation has a piece at place 0, which may be empty.

    At most ``most`` turns of a conversation are copied, to less than ``2 * group`` others."""
    first = F.when(F.col("at") < most, F.struct("at", F.substring("ids", 1, most * ID).alias("ids"), F.slice("words", 1, most).alias("words")))
    sizes = blocks.groupBy("conv_id").agg(F.sum("n").alias("size"), F.collect_list(first).alias("firsts"))
    # a first block may be shorter than ``most`` turns where a partition begins, so up to ``most`` blocks are joined
    sizes = stage(sizes.select("conv_id", "size", *_joined("firsts")), "op11-sizes")
    base = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"), F.col("ids").alias("base_ids"), F.col("words").alias("base_words"))
    lead = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    plan = (
        sizes.select("conv_id", "size", lead.alias("lead"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
        .join(base, "base", "left")
        .withColumn("taken", F.least("lead", F.coalesce("base_size", F.lit(0))))
        .withColumn("total", F.col("taken") + F.greatest(F.col("size") - F.col("lead"), F.lit(0)))
    )
    plan = stage(plan, "op11-plan")
    heads = plan.select(
        "conv_id", F.lit(0).cast("long").alias("at"),
        F.coalesce(F.expr(f"substring(base_ids, 1, int({ID} * taken))"), F.lit(bytearray())).alias("ids"),
        F.coalesce(F.expr("slice(base_words, 1, int(taken))"), F.expr("array_repeat(0L, 0)")).alias("words"), "total",
    )
    own = blocks.join(plan.select("conv_id", "lead", "taken", "total"), "conv_id").withColumn("skip", F.greatest(F.col("lead") - F.col("at"), F.lit(0))).where("skip < n")
    own = own.select(
        "conv_id", (F.col("at") + F.col("skip") - F.col("lead") + F.col("taken")).alias("at"),
        F.expr(f"substring(ids, int({ID} * skip + 1), int({ID} * (n - skip)))").alias("ids"), F.expr("slice(words, int(skip + 1), int(n - skip))").alias("words"), "total",
    )
    return heads.unionByName(own)


def as_they_are(blocks: DataFrame) -> DataFrame:
    """Pieces of the conversations without any change (see :func:`rebuilt`)."""
    totals = blocks.groupBy("conv_id").agg(F.sum("n").alias("total"))
    return blocks.join(totals, "conv_id").select("conv_id", "at", "ids", "words", "total")


def _hash(hexed: Column) -> list[Column]:
    return [F.conv(F.substring(hexed, a, 16), 16, -10).cast("long") for a in (1, 17)]


def _binary(*words: Column) -> Column:
    return F.unhex(F.concat(*(F.lpad(F.hex(w), 16, "0") for w in words)))


def segments(pieces: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, s, p, ids, words, key, goes_on``: the conversations' segments of ``segment`` turns; ``p`` names all turns before
    the segment, ``key`` all up to its end. The name is the exclusive or of a hash of every segment and its number, so it is
    a running sum that needs no order of evaluation."""
    end = F.col("at") + F.size("words")
    cut = pieces.withColumn("s", F.explode(F.expr(f"sequence(at div {segment}, greatest(at, at + size(words) - 1) div {segment})")))
    cut = cut.withColumn("from", F.greatest(F.col("at"), F.col("s") * segment)).withColumn("upto", F.least(end, (F.col("s") + 1) * segment))
    piece = F.expr(
        f"struct(`from` AS at, substring(ids, int({ID} * (`from` - at) + 1), int({ID} * (upto - `from`))) AS ids, slice(words, int(`from` - at + 1), int(upto - `from`)) AS words)"
    )
    parts = cut.groupBy("conv_id", "s").agg(F.collect_list(piece).alias("pieces"), F.max("total").alias("total"))
    hexed = F.sha2(F.concat(F.unhex(F.lpad(F.hex("s"), 8, "0")), F.col("ids")), 256)
    whole = parts.select("conv_id", "s", *_joined("pieces"), "total")
    h1, h2 = _hash(hexed)
    whole = stage(whole.withColumn("h1", h1).withColumn("h2", h2), "op11-segments")
    earlier = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    short = whole.where(f"total <= {segment}").withColumn("p1", F.lit(0).cast("long")).withColumn("p2", F.lit(0).cast("long"))
    long = whole.where(f"total > {segment}")
    for p, h in (("p1", "h1"), ("p2", "h2")):
        long = long.withColumn(p, F.coalesce(F.expr(f"bit_xor({h})").over(earlier), F.lit(0)))
    named = short.unionByName(long)
    key = _binary(F.col("p1").bitwiseXOR(F.col("h1")), F.col("p2").bitwiseXOR(F.col("h2")))
    return named.select("conv_id", "s", _binary(F.col("p1"), F.col("p2")).alias("p"), "ids", "words", key.alias("key"), (F.col("total") > (F.col("s") + 1) * segment).alias("goes_on"))


# ---------------------------------------------------------------- hashes of the ended conversations


def _runs_of(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, int]]:
    keys = batch.column("key").to_pylist()
    begin = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[begin]:
            yield keys[begin], begin, i
            begin = i


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of the sorted ids of a key."""
    out: list[tuple] = []
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        for key, begin, end in _runs_of(batch):
            for a in range(begin, end, CHUNK_BYTES // 16):
                b = min(end, a + CHUNK_BYTES // 16)
                out.append((key, ids[a], ",".join(map(str, ids[a:b]))))
            if len(out) >= 1000:
                yield _rows(out, ("key", "first", "text"))
                out = []
    if out:
        yield _rows(out, ("key", "first", "text"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of a key, read in order; only the hash's state is kept."""
    key, state, out = None, None, []
    for batch in batches:
        for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            if k != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if len(out) >= 10_000:
            yield _rows(out, ("key", "ends"))
            out = []
    if state is not None:
        out.append((key, state.hexdigest()))
    if out:
        yield _rows(out, ("key", "ends"))


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"key": pa.binary(), "first": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=list(names))


def ended(members: DataFrame) -> DataFrame:
    """``key, ends``: the hash of the ascending, comma-joined conv_ids of each key. A key with very many conversations is
    spread over the ranges; only its chunks of 64 KB meet."""
    order = ["key", "conv_id"]
    chunks = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack, "key binary, first long, text string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digest, "key binary, ends string")


# ---------------------------------------------------------------- trees


#: Columns of what a tree gives. kind: n node, o open node, t top of a tree's segments, l segment that goes on.
TREE_SCHEMA = (
    "kind string, nid binary, up binary, depth long, conv_id long, parent_conv_id long, n_convs long, words long, "
    "children long, leaves long, saved long, ends string, goes_on boolean, above array<binary>"
)
_KINDS = [
    pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.binary()),
]
_NAMES = [c.split()[0] for c in TREE_SCHEMA.split(", ")]


def name(s: int, p: bytes, prefix: bytes) -> bytes:
    """Hash of a node: the turns before its segment, and its part of the segment."""
    h = hashlib.sha256(s.to_bytes(4, "big") + prefix).digest()[:ID]
    return (int.from_bytes(p, "big") ^ int.from_bytes(h, "big")).to_bytes(ID, "big")


def tree_rows(rows: list[tuple], left: int, right: int, segment: int = SEGMENT) -> list[tuple]:
    """The trie nodes of the sorted ``rows`` (s, p, ids, conv_id, n, words, goes_on, ends) of one ``(s, p)``; the first ``left``
    turns of the first key and the first ``right`` turns of the last may be shared with other trees."""
    s, p = rows[0][:2]
    root = Node(b"")
    for i, row in enumerate(rows):
        insert(root, row[2], i)
    parent, depth, key = trie_nodes(root)
    size = len(parent)
    place = {k: i for i, k in enumerate(key) if k >= 0}
    opened, tall = bytearray(size), bytearray(size)
    for k, most in ((0, left), (len(rows) - 1, right)):
        i = place[k]
        while i > 0:
            if depth[i] <= most:
                opened[i] = 1
            i = parent[i]
    for k, row in enumerate(rows):
        i = place[k] if row[6] else 0
        while i > 0 and not tall[i]:
            tall[i] = 1
            i = parent[i]

    lead, n, conv = list(key), [0] * size, [None] * size
    kids, leaves, saved, words = [0] * size, [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        k = key[i]
        if k >= 0:
            n[i] += rows[k][4]
            conv[i] = rows[k][3] if conv[i] is None else min(conv[i], rows[k][3])
        if not i:
            break
        words[i] = rows[lead[i]][5][depth[i] - 1]
        up = parent[i]
        n[up] += n[i]
        conv[up] = conv[i] if conv[up] is None else min(conv[up], conv[i])
        if key[up] < 0:
            lead[up] = lead[i]
        if not opened[i]:
            if not kids[i] and not (k >= 0 and rows[k][6]):
                leaves[i] = 1
            saved[i] += (n[i] - 1) * words[i]
            kids[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]

    names: dict[int, bytes] = {0: p}

    def named(i: int) -> bytes:
        if i not in names:
            names[i] = name(s, p, rows[lead[i]][2][: ID * depth[i]])
        return names[i]

    def path(i: int) -> list[bytes]:
        """Names from depth 0 to the node."""
        out = []
        while i >= 0:
            out.append(named(i))
            i = parent[i]
        return out[::-1]

    ends_at = lambda i: rows[key[i]][7] if key[i] >= 0 else None
    base = s * segment
    # of a deeper segment's top only the sums count: its members are those of the node it hangs from
    top = [("t", p, None, base, None if s else conv[0], None, 0 if s else n[0], 0, kids[0], leaves[0], saved[0], ends_at(0), False, None)]
    out = top
    for i in range(1, size):
        up, k = parent[i], key[i]
        on = k >= 0 and rows[k][6]
        closed_up = up > 0 and not opened[up]
        out.append((
            "o" if opened[i] else "n", named(i) if opened[i] or tall[i] else None, None if closed_up else named(up), base + depth[i], conv[i], conv[up] if closed_up else None,
            n[i], words[i], kids[i], leaves[i], saved[i], ends_at(i), on, path(up) if opened[i] else None,
        ))
        if on:
            out.append(("l", named(i), p, base + depth[i], None, None, 0, 0, 0, 0, 0, None, True, path(i)[1:]))
    return out


def _trees(segment: int, tree_keys: int):
    """Trees over the sorted keys of a partition."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(left: int, right: int) -> pa.RecordBatch:
            columns = zip(*tree_rows(held, left, right, segment))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=_NAMES)

        held: list[tuple] = []
        left, size = WHOLE, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("s", "p", "ids", "conv_id", "n", "words", "goes_on", "ends"))):
                if held and row[:2] != held[0][:2]:  # all keys of the last segment group that lie in this partition are known
                    yield made(left, 0)
                    held, left, size = [], 0, 0
                elif len(held) >= tree_keys or size >= TREE_BYTES:
                    both = shared(held[-1][2], row[2]) // ID
                    yield made(left, both)
                    held, left, size = [], both, 0
                held.append(row)
                size += len(row[2])
        if held:
            yield made(left, WHOLE)

    return rows


# ---------------------------------------------------------------- the whole trie


def _deep_sums(tops: DataFrame, links: DataFrame) -> DataFrame:
    """``nid, leaves, saved`` of everything below a top, its deeper segments included: sums over the tree of tops by pointer
    doubling, in as many rounds as the logarithm of the most segments of a conversation."""
    tree = stage(tops.select("nid", "leaves", "saved").join(links.select("nid", F.col("up").alias("anc")), "nid", "left"), "op11-deep")
    while tree.where("anc is not null").limit(1).count():
        added = tree.where("anc is not null").groupBy(F.col("anc").alias("nid")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("v"))
        jump = tree.select(F.col("nid").alias("anc"), F.col("anc").alias("far"))
        tree = tree.join(added, "nid", "left").join(jump, "anc", "left")
        tree = stage(tree.select("nid", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("v", F.lit(0))).alias("saved"), F.col("far").alias("anc")), "op11-deep")
    return tree.drop("anc")


def trie(segs: DataFrame, segment: int = SEGMENT, tree_keys: int = TREE_KEYS) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256`` (see :func:`digest`), from the segments of the conversations."""
    segs = stage(segs, "op11-keyed")
    keys = segs.groupBy("key").agg(
        *(F.any_value(c).alias(c) for c in ("s", "p", "ids", "words")), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.max("goes_on").alias("goes_on")
    )
    keys = stage(keys.join(ended(segs.where("not goes_on")), "key", "left").drop("key"), "op11-keys")
    order = ["s", "p", "ids"]
    found = stage(keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_trees(segment, tree_keys), TREE_SCHEMA), "op11-trees")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "children", "leaves", "saved")]
    once = [F.any_value(c, ignoreNulls=True).alias(c) for c in ("up", "depth", "words", "above")]
    merged = [F.min("conv_id").alias("conv_id"), *once, *sums, F.max("ends").alias("ends"), F.max("goes_on").alias("goes_on")]
    opens = stage(found.where("kind = 'o'").groupBy("nid").agg(*merged), "op11-open")
    tops = found.where("kind = 't'").groupBy("nid").agg(*merged)
    # open children, by their parent: a top if they are the first turn of a segment
    of_top = (F.col("depth") - 1) % segment == 0
    born = opens.groupBy(F.col("up").alias("nid"), of_top.alias("top")).agg(F.count(F.lit(1)).alias("born"))
    all_kids = F.col("children") + F.coalesce("born", F.lit(0))
    opens = opens.join(born.where("not top").drop("top"), "nid", "left").withColumn("children", all_kids).drop("born")
    opens = opens.withColumn("leaves", F.col("leaves") + ((F.col("children") == 0) & ~F.col("goes_on")).cast("long"))
    opens = stage(opens.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words")), "op11-open")
    # what an open node adds to the open nodes above it
    above = opens.select(F.posexplode("above").alias("i", "nid"), "leaves", "saved")
    given = above.groupBy("nid", (F.col("i") == 0).alias("top")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("v"))
    more = lambda df: df.withColumn("leaves", F.col("leaves") + F.coalesce("l", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("v", F.lit(0))).drop("l", "v")
    given = stage(given, "op11-given")
    opens = more(opens.join(given.where("not top").drop("top"), "nid", "left"))
    tops = tops.join(born.where("top").drop("top"), "nid", "left").withColumn("children", all_kids).drop("born")
    tops = stage(more(tops.join(given.where("top").drop("top"), "nid", "left")), "op11-tops")

    links = found.where("kind = 'l'").select("nid", "up", "above")
    columns = ["nid", "up", "depth", "conv_id", "parent_conv_id", "n_convs", "children", "leaves", "saved", "ends"]
    nodes = found.where("kind = 'n'").select(*columns).unionByName(opens.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    if links.limit(1).count():
        deep = _deep_sums(tops, links)
        below = links.join(deep, "nid").select(F.explode("above").alias("nid"), "leaves", "saved").groupBy("nid").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("v"))
        nodes = more(nodes.join(below, "nid", "left"))
        nodes = nodes.join(tops.where("depth > 0").select("nid", F.col("children").alias("born")), "nid", "left").withColumn("children", all_kids).drop("born")
        tops = tops.drop("leaves", "saved").join(deep, "nid")
    root = tops.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    smallest = root.select("conv_id").first()
    known = nodes.where("nid is not null").select(F.col("nid").alias("up"), F.col("conv_id").alias("up_conv"))
    nodes = nodes.join(broadcast_if_within(known), "up", "left")
    parent = F.when(F.col("depth") == 1, F.lit(smallest and smallest[0]).cast("long")).otherwise(F.coalesce("parent_conv_id", "up_conv"))
    nodes = nodes.withColumn("parent_conv_id", parent).select(*columns)
    root = root.withColumn("leaves", F.when(F.col("children") == 0, 1).otherwise(F.col("leaves"))).select(*columns)
    return nodes.unionByName(root).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are (columns as in :func:`trie`)."""
    return trie(segments(as_they_are(turn_blocks(conversations))))


def digest(conversations: DataFrame) -> DataFrame:
    """The registered query: the trie of the rebuilt conversations."""
    return trie(segments(rebuilt(turn_blocks(conversations))))


#: DuckDB SQL for the rows of :func:`digest`: the nodes are the distinct prefixes of the rebuilt conversations, and a
#: node adds to each of its prefixes.
SQL = r"""
WITH t AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT c, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, id) AS turns,
           xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                           lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)), xor(crc, b)),
                           4294967295), 4294967295) % 4 AS h
    FROM t GROUP BY c),
built AS (
    SELECT a.c, coalesce(list_slice(b.turns, 1, a.h), []) || list_slice(a.turns, a.h + 1, len(a.turns)) AS turns
    FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 20),
levels AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM built),
member AS (
    SELECT c, d, min(c) OVER (PARTITION BY list_slice(turns, 1, d)) AS node, d = len(turns) AS ended,
           CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM levels),
nodes AS (
    SELECT node, d, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends
    FROM member GROUP BY node, d),
linked AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN member p ON p.c = n.node AND p.d = n.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
whole AS (SELECT l.*, coalesce(k.n_children, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.node = l.node AND k.d = l.d),
sums AS (
    SELECT a.node, a.d, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
    FROM whole u JOIN member a ON a.c = u.node AND a.d <= u.d GROUP BY a.node, a.d)
SELECT w.node AS conv_id, w.d AS depth, w.parent AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM whole w JOIN sums s ON s.node = w.node AND s.d = w.d
"""
