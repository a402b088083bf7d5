"""The conversation trie against a brute-force version, its SQL and plain dictionaries of prefixes."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
from orderstar.llm import conversation_trie as C

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_id(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows, rebuild=True):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, turn_id(role or "", text or "")[:16], (role or "", text or "")))
    convs = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        built[c] = tuple(convs.get(base, [])[:h] + turns[h:]) if rebuild else tuple(turns)
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    n_words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
            saved[p[:d]] = saved.get(p[:d], 0) + (len(members[p]) - 1) * n_words(p)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[1], r[0]))


def random_rows(seed, convs, deep):
    rng = random.Random(seed)
    texts = ["", "a", "b c", "d  e\tf", None, "é ü\n"]
    rows = [(c, t, rng.choice(["user", "assistant", None]) if rng.random() < 0.3 else "user", rng.choice(texts[:3] if t < 3 else texts)) for c in convs for t in range(rng.randint(1, deep))]
    rows += [(c, None, "system", "x y z") for c in convs[::7]] + [(None, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


def test_rebuilt_trie_matches_brute_force(spark):
    rows = random_rows(1, [*range(-25, 60), *range(1000, 1010), 2**40 + 3], 6)
    rows += [(c, t, "user", "same turn") for c in range(2000, 2400) for t in range(3)]  # a large group of copies
    assert got(C.digest(frame(spark, rows).repartition(7))) == brute(rows)


def test_small_trees_and_long_conversations(spark):
    """Every tree of a few keys, segments of a few turns: all borders, open nodes and deep sums are used."""
    rows = random_rows(3, [*range(0, 40)], 9)
    rows += [(500 + c, t, "user", f"long {t}") for c in range(4) for t in range(60 + 11 * c)]
    rows += [(600 + c, t, "user", f"long {t}" if t < 30 else f"own {c} {t}") for c in range(3) for t in range(50)]
    df = frame(spark, rows).coalesce(1)
    segs = C.segments(C.rebuilt(C.turn_blocks(df)), 4)
    assert segs.where("size(words) > 4").count() == 0
    assert got(C.trie(segs, 4, 3)) == brute(rows)


def test_conversations_as_they_are(spark):
    rows = random_rows(4, [*range(0, 40)], 9)
    assert got(C.conversation_trie(frame(spark, rows))) == brute(rows, rebuild=False)


def test_trees_of_few_keys_merge():
    """tree_rows: slices of a sorted key list give the nodes of the whole list, open ones only on the border paths."""
    rng = random.Random(5)
    ids = [hashlib.sha256(bytes([i])).digest()[:16] for i in range(5)]
    keys = sorted({b"".join(rng.choice(ids) for _ in range(rng.randint(0, 5))) for _ in range(200)})
    rows = [(0, C.ZERO, k, i, 1 + i % 3, [1] * (len(k) // 16), False, None) for i, k in enumerate(keys)]
    whole = {r[1] or (r[3], r[4]): r for r in C.tree_rows(rows, 0, 0)}
    assert sum(r[0] == "o" for r in whole.values()) == 0
    cut = 0
    total = {}
    for a in range(0, len(rows), 17):
        b = min(len(rows), a + 17)
        left = C.shared(rows[a - 1][2], rows[a][2]) // 16 if a else 0
        right = C.shared(rows[b - 1][2], rows[b][2]) // 16 if b < len(rows) else 0
        for r in C.tree_rows(rows[a:b], left, right):
            cut += r[0] == "o"
            total[r[3]] = total.get(r[3], 0) + (r[6] if r[0] != "l" else 0)
    want = {}
    for r in whole.values():
        want[r[3]] = want.get(r[3], 0) + r[6]
    assert cut and total == want


def test_radix_tree_layouts():
    """Nodes grow through all four layouts, split compressed paths and keep keys that are prefixes of others."""
    rng = random.Random(1)
    keys = {bytes([i, *(0,) * 15]) for i in range(256)} | {bytes([7] * 15 + [i]) for i in range(0, 256, 5)} | {bytes([7] * 16) + bytes([i] * 16) for i in range(20)} | {b""}
    order = list(keys)
    rng.shuffle(order)
    root, layouts = C.Node(b""), set()
    for i, k in enumerate(order):
        C.insert(root, k, i)
        layouts.add(root.layout)
    assert layouts == {4, 16, 48, 256}

    def walk(node, above):
        here = above + node.path
        if node.end >= 0:
            yield here, node.end
        for kid in node.children():
            yield from walk(kid, here)

    found = list(walk(root, b""))
    assert [k for k, _ in found] == sorted(keys) and all(order[i] == k for k, i in found)
    parent, depth, key = C.trie_nodes(root)
    prefixes = {k[:d] for k in keys for d in range(0, len(k) + 1, 16)}
    assert len(parent) == len(prefixes) and sum(k >= 0 for k in key) == len(keys)
    assert all(depth[i] == depth[p] + 1 for i, p in enumerate(parent) if i)


def test_empty_extra_columns_and_sql(spark):
    assert got(C.digest(frame(spark, []))) == []
    rows = random_rows(9, [*range(30)], 5)
    clash = ["id", "row", "part", "at", "n", "ids", "words", "key", "s", "p", "size", "lead", "total", "depth"]
    df = frame(spark, rows).selectExpr("*", *(f"'z' AS `{c}`" for c in clash))
    assert got(C.digest(df)) == brute(rows)
    import duckdb

    con = duckdb.connect()
    con.register("given", pa.table(dict(zip(("conv_id", "turn", "role", "text"), map(list, zip(*rows))))))
    con.execute("CREATE VIEW conversations AS SELECT * FROM given")
    names = [x[0] for x in con.execute(C.SQL).description]
    sql = [dict(zip(names, r)) for r in con.execute(C.SQL).fetchall()]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in sql), key=lambda r: (r[1], r[0])) == brute(rows)


def test_one_conversation_over_several_partitions(spark):
    """A conversation with nearly all rows is ranked over all ranges and cut into segments."""
    rows = [(20, t, "user", f"t {t % 50}") for t in range(300)] + [(c, t, "user", f"t {t}") for c in range(19, 25) if c != 20 for t in range(4)]
    blocks = C.turn_blocks(frame(spark, rows).repartition(8))
    assert blocks.where("conv_id = 20").agg({"n": "max"}).first()[0] <= C.SEGMENT
    assert [r.at for r in blocks.where("conv_id = 20").orderBy("at").collect()][0] == 0 and blocks.where("conv_id = 20").agg({"n": "sum"}).first()[0] == 300
    assert got(C.trie(C.segments(C.rebuilt(blocks), 32), 32)) == brute(rows)
