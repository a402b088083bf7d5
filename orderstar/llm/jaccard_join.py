"""N-gram Jaccard join by token-combination prefixes, and its connected components.

Two documents link when ``100 * |x & y| >= percent * |x | y|`` for their sets of ``size``-word shingles (words
``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a text of fewer words is one shingle; a text without words has none
and links with nothing).

* **Nodes.** Documents with equal sets are one node (128-bit set hash; the node key is its first half and
  the second half is checked), so copies are never expanded into pairs.
* **Index.** One global token order: rare tokens by hash, then the *frequent* tokens (those in at least
  ``frequent_from`` documents of some batches, the ``frequent_most`` commonest at most; any choice of them gives the same
  links). Rare tokens are indexed singly from the usual prefix of ``n - ceil(0.8 n) + 1`` tokens. Two linked
  sets whose first shared token is frequent share frequent tokens only, so at least 80 % of either set is
  frequent. Such sets extend the prefix to ``0.4 n + 3`` tokens and index pairs of neighbouring
  frequent tokens. Of the shared tokens in order, fewer pairs can be broken by tokens of one side only
  (``|x u y| - |x n y| <= 0.25 |x n y|``) than there are pairs in that prefix, so one pair is whole in both.
  Keys of the same nodes (near copies share many) name the same pairs, so one of them stands for all.
* **Candidates.** No pairs of a group become rows. First each node is checked against one centre (the member of its groups
  whose groups are largest), and the links' components are taken. Then the groups that still hold several
  components meet in tasks, in blocks of at most ``GROUP`` nodes, with sketches only: each member outside the largest component
  names the nearest member of another one; after these links, all possible links between different components that are
  left are named. So every pair that may link is either checked or already within one component.
* **Verification.** Symmetric-difference bounds from parity sketches (about a bit per token) drop what cannot
  link, the rest is intersected exactly.

Cases: null and blank texts keep their row with 0 shingles and a component of their own; repeated rows link like any
copies; rows that share an id, or have none, are told apart by their texts;
very long texts are read whole, as a slice of their own; an empty table gives an empty result; a component's id is its smallest non-null doc_id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.llm.sparkops import components, discard, stage
from orderstar.llm.textops import LOWER, SLICE_BYTES, U, flat, mix, prefix_hash, range_hash, release, signed, slices, words

SIZE = 5
PERCENT = 80
#: A token is frequent from so many documents on; at most so many tokens are (their hashes go to every task: 0.5 MB).
FREQUENT_FROM = 50
FREQUENT_MOST = 1 << 16
#: Parity sketches have as many bits as a set has tokens, rounded up to a power of two within these bounds.
SKETCH_BITS = (1024, 1 << 17)
#: Nodes of one block of a group.
GROUP = 1000
#: Of what :func:`_nodes` yields.
NODE_NAMES = ["doc_id", "h", "n_shingles", "node", "check", "sketch", "often"]


def token_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each document, one document after the other, and where each begins (``len + 1`` values)."""
    data = LOWER[data]
    start, end, first = words(data, offsets)
    h = range_hash(prefix_hash(data), start, end)
    many = max(len(h) - size + 1, 0)
    rolled = np.zeros(len(h), U)
    for t in range(size):
        rolled[:many] *= U(0x9E3779B97F4A7C15)
        rolled[:many] += mix(h[t : t + many] + U(t))
    rolled = mix(rolled)
    n = np.diff(first)
    for i in np.flatnonzero((n > 0) & (n < size)).tolist():
        whole = U(n[i])
        for x in h[first[i] : first[i + 1]]:
            whole = mix(np.array([whole], U) * U(0xD6E8FEB86659FD93) + x)[0]
        rolled[first[i]] = whole
    count = np.where(n < size, np.minimum(n, 1), n - size + 1)
    bounds = np.concatenate(([0], np.cumsum(count)))
    tokens = rolled[np.repeat(first[:-1] - bounds[:-1], count) + np.arange(bounds[-1])]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        tokens[a:b].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    new[bounds[:-1][count > 0]] = True
    return tokens[new], np.concatenate(([0], np.cumsum(new)))[bounds]


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    tokens, bounds = token_sets(data, offsets, size)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield tokens[a:b]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each set's values modulo 2**64."""
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def signatures(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set: its node."""
    return signed(mix(sums(mix(tokens + U(0x1234567)), bounds)))


def checks(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A second hash of each set."""
    return signed(mix(sums(mix(tokens ^ U(0xABCDEF987654321)), bounds) + np.diff(bounds).astype(U)))


def first_sets(node: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The places of one set per node, those without tokens left out."""
    return (at := np.flatnonzero(np.diff(bounds)))[np.unique(node[at], return_index=True)[1]]


def parity(tokens: np.ndarray) -> bytes:
    """Parities of the counts of tokens modulo the number of bits; halves XORed give the sketch of half the bits."""
    bits = min(max(SKETCH_BITS[0], 1 << (len(tokens) - 1).bit_length() if len(tokens) else 0), SKETCH_BITS[1])
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def differences(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Lower bounds of the symmetric differences of pairs of sets, from their sketches."""
    out = np.zeros(len(x), np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in zip(x, y)], np.int64).reshape(-1, 2)
    for a, b in np.unique(sizes, axis=0).tolist():
        at = np.flatnonzero((sizes[:, 0] == a) & (sizes[:, 1] == b))
        width, both = min(a, b), []
        for sketches, n in ((x, a), (y, b)):
            rows = np.frombuffer(b"".join(sketches[i] for i in at), np.uint8).reshape(len(at), n // width, width)
            both.append(np.bitwise_xor.reduce(rows, axis=1))
        out[at] = np.bitwise_count(both[0] ^ both[1]).sum(axis=1, dtype=np.int64)
    return out


def _nodes(size: int, least: int):
    """Each row's node; and, as rows with ``often``, the tokens in at least ``least`` different sets of a larger slice (as
    ``node``) and in how many (as ``n_shingles``)."""

    def rows(batches):
        for batch in slices(batches, most=8 * SLICE_BYTES):
            nodes, held = np.zeros(0, np.int64), []
            for part in slices([batch]):
                tokens, bounds = token_sets(*flat(part.column("text")), size)
                node, n = signatures(tokens, bounds), np.diff(bounds)
                empty = n == 0
                sketch = [parity(tokens[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("h"), pa.array(n), pa.array(node, mask=empty),
                        pa.array(checks(tokens, bounds), mask=empty), pa.array(sketch, pa.binary()), pa.array(np.zeros(len(n), bool)),
                    ],
                    names=NODE_NAMES,
                )
                at = first_sets(node, bounds)
                at = at[~np.isin(node[at], nodes)]
                nodes = np.concatenate((nodes, node[at]))
                held += [tokens[bounds[i] : bounds[i + 1]] for i in at.tolist()]
            if held:
                token, n = repeated(held, least)
                none = pa.nulls(len(token), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none, pa.array(n), pa.array(signed(token)), none, pa.nulls(len(token), pa.binary()), pa.array(np.ones(len(token), bool))],
                    names=NODE_NAMES,
                )

    return rows


def repeated(sets: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in at least ``least`` of the sets, and in how many; sorts in place and frees the list, as batches are large."""
    every = np.concatenate(sets)
    sets.clear()
    every.sort()
    token = np.unique(every[: max(len(every) - least + 1, 0)][every[least - 1 :] == every[: max(len(every) - least + 1, 0)]])
    return token, np.searchsorted(every, token, side="right") - np.searchsorted(every, token)


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Index keys of one set (sorted distinct hashes): single rare tokens, pairs of frequent ones."""
    n = len(tokens)
    need = -(-percent * n // 100)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        common = frequent[at] == tokens
        rare, often = tokens[~common], tokens[common]
    else:
        rare, often = tokens, tokens[:0]
    keys = rare[: n - need + 1]
    if len(often) >= need:
        extended = n - need + (need * (100 - percent)) // percent + 3
        often = often[: max(0, extended - len(rare))]
        keys = np.concatenate((keys, mix(often[:-1] * U(0x9E3779B97F4A7C15) + mix(often[1:]))))
    return keys


def index_keys(tokens: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`prefix_keys` of many sets, and for each key its set."""
    n = np.diff(bounds)
    need = -(-percent * n // 100)
    rare = np.ones(len(tokens), bool)
    if len(frequent):
        rare = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] != tokens
    before = np.concatenate(([0], np.cumsum(rare)))
    own = np.repeat(np.arange(len(n)), n)
    # sets with enough frequent tokens have pairs of them, too
    pairs = n - np.diff(before[bounds]) >= need
    keep = rare & (before[:-1] - before[bounds[own]] <= (n - need)[own]) & ~pairs[own]
    keys, sets = [tokens[keep]], [own[keep]]
    for i in np.flatnonzero(pairs & (n > 0)).tolist():
        more = prefix_keys(tokens[bounds[i] : bounds[i + 1]], frequent, percent)
        keys.append(more)
        sets.append(np.full(len(more), i))
    return np.concatenate(keys), np.concatenate(sets)


def _index(size: int, percent: int, frequent: list[int]):
    def rows(batches):
        often = np.array(frequent, np.int64).view(U)
        often.sort()
        for batch in slices(batches):
            tokens, bounds = token_sets(*flat(batch.column("text")), size)
            node = signatures(tokens, bounds)
            key, at = index_keys(tokens, bounds, often, percent)
            first = np.zeros(len(node), bool)
            first[first_sets(node, bounds)] = True
            key, at = key[first[at]], at[first[at]]
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(node[at])], names=["key", "node"])

    return rows


def _sets(size: int):
    def rows(batches):
        for batch in slices(batches):
            tokens, bounds = token_sets(*flat(batch.column("text")), size)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(tokens)))
            yield pa.RecordBatch.from_arrays([pa.array(signatures(tokens, bounds)), lists], names=["node", "tokens"])

    return rows


def _possible(percent: int):
    """Pairs whose sizes and sketches allow a link."""

    def rows(batches):
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("xn", "yn"))
            differ = differences(*(batch.column(c).to_pylist() for c in ("xs", "ys")))
            yield batch.select(["a", "b"]).filter(pa.array(allowed(x, y, differ, percent)))

    return rows


def allowed(x, y, differ, percent: int):
    """Whether sets of sizes x and y may link: |x ^ y| = x + y - 2s and 100 s >= p (x + y - s)
    =>  (100 + p) |x ^ y| <= (100 - p) (x + y)."""
    return (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & ((100 + percent) * differ <= (100 - percent) * (x + y))


def near_nodes(component: np.ndarray, side: np.ndarray, n: np.ndarray, sketches: list[bytes], percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every member of a group outside its largest component: the members of other components that may
    link with it, and how much they differ. With two sides only members of different sides are compared."""
    size = np.fromiter(map(len, sketches), np.int64, len(sketches))
    at, rows, half = {}, {}, {}
    for w in np.unique(size).tolist():
        at[w] = np.flatnonzero(size == w)
        rows[w] = np.frombuffer(b"".join(sketches[i] for i in at[w]), np.uint8).reshape(-1, w)
        half[w] = np.bitwise_xor.reduce(rows[w].reshape(-1, 2, w // 2), axis=1)
    place = np.zeros(len(size), np.int64)
    for w in at:
        place[at[w]] = np.arange(len(at[w]))
    parts, counts = np.unique(component, return_counts=True)
    largest = parts[np.argmax(counts)]
    two = len(np.unique(side)) > 1
    for i in np.flatnonzero(component != largest).tolist():
        w, found, differ = int(size[i]), [], []
        # sizes differ by a quarter at most, so sketches by a factor of two
        for other, mine in ((w, rows[w][place[i]]), (2 * w, rows[w][place[i]]), (w // 2, half[w][place[i]])):
            if other in at:
                theirs = half[other] if other == 2 * w else rows[other]
                found.append(at[other])
                differ.append(np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64))
        j, d = np.concatenate(found), np.concatenate(differ)
        good = (component[j] != component[i]) & allowed(n[i], n[j], d, percent)
        if two:
            good &= side[j] != side[i]
        if good.any():
            yield i, j[good], d[good]


def pair_differences(column: pa.Array, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """:func:`differences` of the sketches of rows i and j, from the column's bytes."""
    data, offsets = flat(column)
    size = np.diff(offsets)
    out = np.zeros(len(i), np.int64)
    for a, b in np.unique(np.stack((size[i], size[j]), axis=1), axis=0).tolist():
        at = np.flatnonzero((size[i] == a) & (size[j] == b))
        width, both = min(a, b), []
        for rows, n in ((i[at], a), (j[at], b)):
            cells = data[offsets[rows][:, None] + np.arange(n)].reshape(len(at), n // width, width)
            both.append(np.bitwise_xor.reduce(cells, axis=1))
        out[at] = np.bitwise_count(both[0] ^ both[1]).sum(axis=1, dtype=np.int64)
    return out


def _near(percent: int, best: bool):
    """Possible links of each group (rows come sorted by key and part; a group is never cut): of each member the
    nearest one only, or all. Groups of two, which most are, are compared together."""

    def twos(batch: pa.RecordBatch, i: np.ndarray, node, component, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        j = i + 1
        keep = component[i] != component[j]
        i, j = i[keep], j[keep]
        differ = pair_differences(batch.column("sketch"), i, j) if len(i) else np.zeros(0, np.int64)
        keep = allowed(n[i], n[j], differ, percent)
        i, j, differ = i[keep], j[keep], differ[keep]
        if not best:
            return np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), np.zeros(len(i))
        # of two components of one member each the smaller one counts as the largest
        swap = component[i] < component[j]
        return node[np.where(swap, j, i)], node[np.where(swap, i, j)], differ / (n[i] + n[j])

    def groups(batch: pa.RecordBatch, start: np.ndarray) -> pa.RecordBatch:
        node, component, side, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "component", "side", "n"))
        n = n.astype(np.int64)
        size = np.diff(np.append(start, batch.num_rows))
        a, b, d = ([x] for x in twos(batch, start[size == 2], node, component, n))
        for at, g in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            here = slice(at, at + g)
            sketches = batch.column("sketch").slice(at, g).to_pylist()
            mine, count = node[here], n[here]
            for i, j, differ in near_nodes(component[here], side[here], count, sketches, percent):
                if best:
                    k = int(np.lexsort((mine[j], differ / (count[j] + count[i])))[0])
                    a.append(mine[i : i + 1])
                    b.append(mine[j[k : k + 1]])
                    d.append(differ[k : k + 1] / (count[i] + count[j[k]]))
                else:
                    a.append(np.minimum(mine[i], mine[j]))
                    b.append(np.maximum(mine[i], mine[j]))
                    d.append(np.zeros(len(j)))
        a, b, d = (np.concatenate(x) for x in (a, b, d))
        if not best:  # a pair of a large group is named from both sides
            a, b = np.unique(np.stack((a, b)), axis=1)
            d = np.zeros(len(a))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.float64())], names=["a", "b", "d"])

    def rows(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key, part = (batch.column(c).to_numpy() for c in ("key", "part"))
            start = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]))))
            last = int(start[-1])
            held = batch.slice(last)
            if last:
                yield groups(batch.slice(0, last), start[:-1])
        if held is not None:
            yield groups(held, np.zeros(1, np.int64))
        release()

    return rows


def _verified(percent: int):
    def rows(batches):
        for batch in batches:
            good = []
            x, y = batch.column("x"), batch.column("y")
            for i in range(batch.num_rows):
                p, q = (np.asarray(c[i].values) for c in (x, y))
                both = len(p) + len(q) - len(np.union1d(p, q))
                good.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return rows


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The pairs ``(a, b)`` of nodes that link. Sketches come first; only the sets of pairs that they allow are made."""
    side = lambda k, p: nodes.select(F.col("node").alias(k), F.col("n").alias(f"{p}n"), F.col("sketch").alias(f"{p}s"))
    possible = stage(pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(_possible(percent), "a long, b long"), f"{name}-possible")
    some = possible.select(F.col("a").alias("node")).union(possible.select("b")).distinct()
    # a document is its id and the hash of its text: rows may share an id, or have none
    wanted = stage(nodes.join(some, "node").select(F.col("doc_id").alias("want"), F.col("h").alias("want_h")).distinct(), f"{name}-wanted")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("want")) & (F.col("h") == F.col("want_h"))).select("text")
    sets = texts.mapInArrow(_sets(size), "node long, tokens array<long>").dropDuplicates(["node"])
    sets = stage(sets, f"{name}-sets")
    # the sets are the largest of it
    whole = possible.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    links = stage(whole.mapInArrow(_verified(percent), "a long, b long"), f"{name}-links")
    discard(sets, possible, wanted)
    return links


def _merged(met: DataFrame, name: str) -> DataFrame:
    """One key for all keys of the same nodes (near copies share many): ``key, node``, the summed sizes ``c`` of the keys it
    stands for and their number ``times``. Equal groups are told by the xor of their nodes and of those' hashes, 128 bits."""
    group = met.groupBy("key").agg(F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"), F.count(F.lit(1)).alias("n"), F.max("c").alias("c"))
    kept = group.groupBy("x", "y", "n").agg(F.min("key").alias("key"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("times"))
    return met.select("key", "node").join(stage(kept.select("key", "c", "times"), f"{name}-groups"), "key")


def _cross(index: DataFrame, known: DataFrame, nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Index rows of keys with several components, with component, size and sketch, dealt by key. A key with more
    than ``GROUP`` nodes is dealt as pairs of blocks, so no task gets more than two blocks of a group. Also the written table
    behind them."""
    own = index.select("node").distinct().join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    placed = stage(index.select("key", "node").join(stage(own, f"{name}-own"), "node"), f"{name}-placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("c")).where("x < y")
    mixed = stage(mixed.select("key", F.ceil(F.col("c") / GROUP).cast("int").alias("blocks")), f"{name}-mixed")
    few = stage(placed.join(mixed, "key"), f"{name}-cross")
    discard(placed)
    rows = few.join(nodes.select("node", "n", "sketch"), "node")
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.least("side", "other") * F.col("blocks") + F.greatest("side", "other")
    return rows.select("key", part.alias("part"), "node", "component", "side", "n", "sketch").repartition("key", "part").sortWithinPartitions("key", "part", "node"), few


def similar_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, frequent_from: int = FREQUENT_FROM, frequent_most: int = FREQUENT_MOST) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: ``doc_id, n_shingles, component_id``."""
    return similar_texts(docs, size, percent, frequent_from, frequent_most).select("doc_id", "n_shingles", "component_id")


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, h`` (``xxhash64`` of the text) of the rows that another one stands for: in each component all but the row with the
    smallest doc_id, of several texts under that id the one with the smallest hash. Rows without an id are no copies."""
    rows = similar_texts(docs)
    first = F.min(F.when(F.col("doc_id") == F.col("component_id"), F.col("h"))).alias("first")
    kept = rows.where("component is not null").groupBy("component").agg(first)
    others = rows.join(kept, "component").where((F.col("doc_id") != F.col("component_id")) | (F.col("h") != F.col("first")))
    return others.where("doc_id is not null").select("doc_id", "h").distinct()


def similar_texts(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, frequent_from: int = FREQUENT_FROM, frequent_most: int = FREQUENT_MOST) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: ``doc_id, h, n_shingles, component, component_id``. ``h`` tells apart the texts of rows that
    share an id, ``component`` the components of equal id; it is null without words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    name = "op5"
    made = stage(docs.mapInArrow(_nodes(size, 3), "doc_id long, h long, n_shingles long, node long, check long, sketch binary, often boolean"), f"{name}-rows")
    rows = made.where("not often").drop("often")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "n_shingles", "sketch")).alias("low")
    nodes = stage(
        rows.where("node is not null").groupBy("node").agg(first, F.min("check").alias("c"), F.max("check").alias("d"))
        .select("node", F.col("low.n_shingles").alias("n"), "low.sketch", "low.h", F.when(F.col("c") == F.col("d"), F.col("low.doc_id")).otherwise(F.raise_error(F.lit("two shingle sets share a 64-bit hash"))).alias("doc_id")),
        f"{name}-nodes",
    )
    often = (
        made.where("often").groupBy(F.col("node").alias("token")).agg(F.sum("n_shingles").alias("n"))
        .where(F.col("n") >= frequent_from).orderBy(F.desc("n"), "token").limit(frequent_most)
    )
    frequent = [r.token for r in often.collect()]  # at most frequent_most hashes
    # written before the shared keys are known: its rows are made once
    every = stage(docs.select("text").mapInArrow(_index(size, percent, frequent), "key long, node long"), f"{name}-all-keys")
    shared = every.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("c")).where("low < high").select("key", "c")
    met = stage(every.join(stage(shared, f"{name}-keys"), "key").distinct(), f"{name}-met")
    discard(every)
    index = stage(_merged(met, name), f"{name}-index")
    discard(met)

    # the centre of a group is the member with the largest groups (of near copies, mostly the original)
    weight = stage(index.groupBy("node").agg(F.sum("c").alias("w")), f"{name}-weights")
    heavy = stage(index.select("key", "node", "times").join(weight, "node"), f"{name}-heavy")
    tops = stage(heavy.groupBy("key").agg(F.max(F.struct("w", "node")).alias("top")).select("key", "top.*").withColumnRenamed("node", "centre"), f"{name}-tops")
    centre = heavy.select("key", "node", "times").join(tops, "key").where("node <> centre").groupBy("node", "centre").agg(F.max("w").alias("w"), F.sum("times").alias("c"))
    centre = centre.groupBy("node").agg(F.max_by("centre", F.struct("w", "c", "centre")).alias("centre"))
    links = _links(centre.select(F.col("node").alias("a"), F.col("centre").alias("b")), nodes, docs, size, percent, f"{name}-centre")
    discard(heavy, tops)

    # the nearest members of other components, then all possible links that are left
    for step, best in (("nearest", True), ("rest", False)):
        known = stage(components(links, name), f"{name}-known")
        met, few = _cross(index, known, nodes, name)
        near = met.mapInArrow(_near(percent, best), "a long, b long, d double")
        if best:
            near = near.groupBy("a").agg(F.min_by("b", F.struct("d", "b")).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = stage(near.select("a", "b").distinct(), f"{name}-{step}")
        discard(few)
        links = stage(links.union(_links(pairs, nodes, docs, size, percent, f"{name}-{step}")), f"{name}-links")
    joined = stage(components(links, name), f"{name}-components")

    named = nodes.select("node", "doc_id").join(joined, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    named = stage(named, f"{name}-named")
    least = stage(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), f"{name}-least")
    label = stage(named.join(least, "component").select("node", "component", "component_id"), f"{name}-labels")
    rows = rows.drop("sketch", "check").join(label, "node", "left")
    return rows.select("doc_id", "h", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))
