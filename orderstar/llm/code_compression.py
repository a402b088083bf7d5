"""Vector code compression: product codes of integer vectors, with adaptive distance bounds.

A vector is cut into 8 parts, and each part is replaced by the number of the nearest of its part's 16 codebook
entries; entries move to the floored mean of their parts, round by round (:func:`fit`). All distances are integers.

Rounds after the first use bounds instead of distances. For every part the state keeps, in a written table: the
assigned entry with an upper bound of its distance, the ``b`` next closest entries with ordered lower bounds (each also
bounds all entries after it) and one outer bound for all others. When the entries have moved, the upper bound grows by
the move of the assigned entry, the lower ones shrink by those of theirs, the outer one by the largest move. A part
whose upper bound stays below its first lower bound keeps its entry. The others are verified with integers: first the
assigned distance, then only the entries whose bounds it reaches, or all 16 where it reaches the outer bound; ties go
to the lower number. Bounds are rounded outwards, so rounding never decides. ``b`` starts at a quarter of the entries
and shrinks to the largest rank that searches still reach (1 at least, one in 100 of them counts as none); dropped
bounds become part of the outer one.

How it is spread. A round is one pass of Arrow batches over the state; besides the rows every task writes one row with
its sums and counts (8 x 16 x part length), which Spark adds up. A codebook is a few KB. The state of a round is
written in the shared folder, and the one before it is removed when the next is whole.

Cases: rows whose vector is null, empty or holds a null or non-finite component are left out, as are those whose length
is not that of the vector with the smallest vec_id; a null vec_id sorts last; rows of equal vec_id are vectors of their
own, ordered by their components; with fewer than 16 vectors there are as many entries; an empty table gives no
rows; further columns are ignored. A length that is no multiple of 8, and components beyond 2**26 after scaling (their
squared distances might not fit 64 bits), raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstar.operators.sizing import broadcast_if_within
from orderstar.session import scratch_path

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Largest scaled component, vectors handled at once, share of the searches that may go beyond ``b``.
LARGEST = 1 << 26
ROWS = 8192
RARE = 0.01

STATE = "vec_id long, label {label}, v binary, near binary, bounds binary, sums binary"


def scaled(values: np.ndarray) -> np.ndarray:
    """Integers ``floor(4096 x)`` (the product is exact in doubles)."""
    whole = np.floor(values.astype(np.float64) * SCALE)
    if len(whole) and np.abs(whole).max(initial=0) > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST / SCALE:.0f}: its distances may not fit 64 bits")
    return whole.astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows x entries) of integer parts."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for d in range(x.shape[1]):
        gap = x[:, d, None] - entries[None, :, d]
        out += gap * gap
    return out


def upwards(squared: np.ndarray) -> np.ndarray:
    return (np.sqrt(squared.astype(np.float64)) * (1 + 3e-7)).astype(np.float32)


def downwards(squared: np.ndarray) -> np.ndarray:
    return (np.sqrt(squared.astype(np.float64)) * (1 - 3e-7)).astype(np.float32)


def search_all(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State of parts from all distances: entries in order ``(n, b + 1)``, bounds ``(n, b + 2)`` (upper, ``b`` lower ones,
    outer) and the squared distance to the nearest."""
    d2 = distances(x, entries)
    order = np.argsort(d2, axis=1, kind="stable")  # equal distances: the lower number first
    ranked = np.take_along_axis(d2, order, axis=1)
    near = np.zeros((len(x), b + 1), np.uint8)
    bounds = np.full((len(x), b + 2), np.inf, np.float32)
    have = min(b + 1, len(entries))
    near[:, :have] = order[:, :have]
    near[:, have:] = 255  # no such entry
    bounds[:, 0] = upwards(ranked[:, 0])
    bounds[:, 1:have] = downwards(ranked[:, 1:have])
    if len(entries) > b + 1:
        bounds[:, b + 1] = downwards(ranked[:, b + 1])
    return near, bounds, ranked[:, 0]


def moved(bounds: np.ndarray, near: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Bounds after the entries have moved by ``moves``, made ordered: a bound holds for all entries from its rank on."""
    by = np.append(moves, np.zeros(256 - len(moves)))[near]
    out = bounds.astype(np.float64)
    out[:, 0] = out[:, 0] * (1 + 2e-7) + by[:, 0]
    out[:, 1:-1] -= by[:, 1:]
    out[:, -1] -= moves.max()
    out[:, 1:] -= np.abs(out[:, 1:], where=np.isfinite(out[:, 1:]), out=np.zeros_like(out[:, 1:])) * 2e-7
    out[:, 1:] = np.minimum.accumulate(out[:, :0:-1], axis=1)[:, ::-1]
    return out


def assign(x: np.ndarray, near: np.ndarray, bounds: np.ndarray, entries: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One part of all rows after a move: new ``near`` and ``bounds``, and how many searches reached each rank (0: the assigned
    distance was enough; the last: all entries)."""
    b = near.shape[1] - 1
    bounds = moved(bounds, near, moves)
    reached = np.zeros(b + 2, np.int64)
    unsure = np.flatnonzero(bounds[:, 0] >= bounds[:, 1])
    near = near.copy()
    if len(unsure):
        gap = x[unsure] - entries[near[unsure, 0]]
        tight = upwards((gap * gap).sum(axis=1)).astype(np.float64)
        bounds[unsure, 0] = tight
        rank = (bounds[unsure, 1:] <= tight[:, None]).sum(axis=1)  # the bounds are in order
        reached += np.bincount(rank, minlength=b + 2)
        for z in range(1, b + 1):
            rows = unsure[rank == z]
            if not len(rows):
                continue
            some = near[rows, : z + 1].astype(np.int64)
            gap = x[rows, None, :] - entries[np.minimum(some, len(entries) - 1)]
            d2 = np.where(some < len(entries), (gap * gap).sum(axis=2), np.iinfo(np.int64).max)
            order = np.lexsort((some, d2), axis=1)
            ranked = np.take_along_axis(d2, order, axis=1)
            near[rows, : z + 1] = np.take_along_axis(some, order, axis=1)
            bounds[rows, 0] = upwards(ranked[:, 0])
            bounds[rows, 1 : z + 1] = downwards(ranked[:, 1:])
            bounds[rows, 1:] = np.minimum.accumulate(bounds[rows, :0:-1], axis=1)[:, ::-1]
        rows = unsure[rank == b + 1]
        if len(rows):
            near[rows], bounds[rows], _ = search_all(x[rows], entries, b)
    low = bounds.astype(np.float32)
    low[:, 0] = (bounds[:, 0] * (1 + 2e-7)).astype(np.float32)
    finite = np.where(np.isfinite(bounds[:, 1:]), bounds[:, 1:], 0)
    low[:, 1:] = np.where(np.isfinite(bounds[:, 1:]), finite - np.abs(finite) * 2e-7, np.inf)
    return near, low, reached


def fewer(near: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The state with ``b`` lower bounds; those dropped bound all entries after them already, so the first of them (the least)
    becomes the outer bound."""
    if near.shape[-1] - 1 <= b:
        return near, bounds
    return near[..., : b + 1], np.concatenate((bounds[..., : b + 1], bounds[..., b + 1 :].min(axis=-1, keepdims=True)), axis=-1)


def next_b(b: int, reached: np.ndarray) -> int:
    """The largest rank that more than ``RARE`` of the searches reach (those of all entries aside), 1 at least."""
    within = reached[: b + 1]
    beyond = np.cumsum(within[::-1])[::-1]
    used = np.flatnonzero(beyond > RARE * max(1, within.sum()))
    return max(1, min(b, int(used[-1]) if len(used) else 1))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _column(values: np.ndarray) -> pa.Array:
    """Rows of an array as binary values of equal length."""
    data = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    offsets = (np.arange(len(values) + 1) * data.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _values(column: pa.Array, kind: str, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(n, -1) if data.ctypes.data % width == 0 else np.frombuffer(data.tobytes(), kind).reshape(n, -1)


def _round(codebooks: np.ndarray, moves: np.ndarray | None, b: int, label: pa.DataType):
    """A pass: the first one (``moves`` is None) reads vectors, later ones the state with any ``b``; both give the state with ``b``
    lower bounds and, last, a row of the task's sums, counts and reached ranks."""
    size = codebooks.shape[2]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, codebooks.shape[1], size + 1), np.int64)
        reached = np.zeros(ENTRIES + 2, np.int64)
        seen = False
        for batch in _chunks(batches):
            n, seen = batch.num_rows, True
            if moves is None:
                values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
                x = scaled(values).reshape(n, PARTS, size)
                near, bounds = np.zeros((n, PARTS, b + 1), np.uint8), np.zeros((n, PARTS, b + 2), np.float32)
                for p in range(PARTS):
                    near[:, p], bounds[:, p], _ = search_all(x[:, p], codebooks[p], b)
            else:
                x = _values(batch.column("v"), "<i4", n).astype(np.int64).reshape(n, PARTS, size)
                near = _values(batch.column("near"), "u1", n).reshape(n, PARTS, -1)
                bounds = _values(batch.column("bounds"), "<f4", n).reshape(n, PARTS, -1)
                near, bounds = (y.copy() for y in fewer(near, bounds, b))
                for p in range(PARTS):
                    near[:, p], bounds[:, p], found = assign(x[:, p], near[:, p], bounds[:, p], codebooks[p], moves[p])
                    reached[: len(found) - 1] += found[:-1]
                    reached[-1] += found[-1]
            for p in range(PARTS):
                mine = near[:, p, 0]
                sums[p, :, size] += np.bincount(mine, minlength=codebooks.shape[1])
                for d in range(size):  # at most 8,192 integers of 27 bits: exact in doubles
                    sums[p, :, d] += np.bincount(mine, x[:, p, d], codebooks.shape[1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _column(x.reshape(n, -1).astype("<i4")), _column(near.reshape(n, -1)), _column(bounds.reshape(n, -1).astype("<f4")), pa.nulls(n, pa.binary())],
                names=["vec_id", "label", "v", "near", "bounds", "sums"],
            )
        if seen:
            held = pa.array([np.append(sums.ravel(), reached).astype("<i8").tobytes()], pa.binary())
            none = pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, label), none, none, none, held], names=["vec_id", "label", "v", "near", "bounds", "sums"])

    return rows


def _last(codebooks: np.ndarray, moves: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = codebooks.shape[2]
        digits = np.array([f"{i:02x}" for i in range(ENTRIES)])
        for batch in _chunks(batches):
            n = batch.num_rows
            x = _values(batch.column("v"), "<i4", n).astype(np.int64).reshape(n, PARTS, size)
            near = _values(batch.column("near"), "u1", n).reshape(n, PARTS, -1)
            bounds = _values(batch.column("bounds"), "<f4", n).reshape(n, PARTS, -1)
            code, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
            for p in range(PARTS):
                found, _, _ = assign(x[:, p], near[:, p], bounds[:, p], codebooks[p], moves[p])
                code[:, p] = found[:, 0]
                gap = x[:, p] - codebooks[p][code[:, p]]
                error += (gap * gap).sum(axis=1)
            text = ["".join(row) for row in digits[code].tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return rows


def _discard(spark: SparkSession, path: str) -> None:
    """Removes a state that a later, wholly written one has replaced."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows whose vector is whole and finite."""
    vector = F.col("embedding").cast("array<double>")
    good = F.col("embedding").isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return embeddings.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("embedding"))


def fit(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray] | None:
    """Codes ``vec_id, label, code, error`` (a written table) and the final codebooks (parts x entries x part length); None
    without usable vectors."""
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last()).select(F.size("embedding")).first()
    if first is None:
        return None
    length = int(first[0])
    if length % PARTS:
        raise ValueError(f"vectors of {length} components cannot be cut into {PARTS} equal parts")
    vectors = vectors.where(F.size("embedding") == length)
    ordered = F.transform("embedding", lambda x: F.floor(x * SCALE))
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), ordered).select("embedding").limit(ENTRIES).collect()
    books = np.stack([scaled(np.array(r[0])) for r in seeds]).reshape(len(seeds), PARTS, -1).transpose(1, 0, 2).copy()

    label = vectors.schema["label"].dataType.simpleString()
    kind = pa.null() if label == "void" else vectors.select("label").limit(0).toArrow().schema.field("label").type
    schema = STATE.format(label=label)
    b, moves, path = max(1, ENTRIES // 4), None, None
    for _ in range(rounds):
        source = vectors if moves is None else spark.read.schema(schema).parquet(path).where("sums is null")
        after = scratch_path(spark, "op12-state")
        source.mapInArrow(_round(books, moves, b, kind), schema).write.parquet(after)
        if path:
            _discard(spark, path)
        path = after
        total = None
        # one row of some KB for each task, summed in Spark by position before it reaches the driver
        held = spark.read.schema(schema).parquet(path).where("sums is not null").select("sums")
        shape = (PARTS, books.shape[1], books.shape[2] + 1)
        cells = held.mapInArrow(_cells, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
        total = np.zeros(int(np.prod(shape)) + ENTRIES + 2, np.int64)
        for r in cells:
            total[r["at"]] = r["n"]
        sums, reached = total[: -(ENTRIES + 2)].reshape(shape), total[-(ENTRIES + 2) :]
        counts = sums[:, :, -1:]
        new = np.where(counts > 0, np.floor_divide(sums[:, :, :-1], np.maximum(counts, 1)), books)
        moves = np.sqrt(((new - books) ** 2).sum(axis=2).astype(np.float64)) * (1 + 1e-12)
        books = new
        if reached[: b + 1].sum():
            b = next_b(b, reached)
    final = spark.read.schema(schema).parquet(path).where("sums is null").drop("sums")
    out = scratch_path(spark, "op12-codes")
    codes = f"vec_id long, label {label}, code string, error long"
    final.mapInArrow(_last(books, moves), codes).write.parquet(out)
    _discard(spark, path)
    return spark.read.schema(codes).parquet(out), books


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task by their position, added up within the batch."""
    for batch in batches:
        if batch.num_rows:
            total = sum(np.frombuffer(x, "<i8") for x in batch.column("sums").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "n"])


def digest(embeddings: DataFrame) -> DataFrame:
    """The registered query: ``vec_id, code, error, label_error, codebooks_sha256``."""
    fitted = fit(embeddings)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    codes, books = fitted
    text = ",".join(map(str, books.reshape(-1).tolist()))
    sums = codes.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(broadcast_if_within(sums), F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))


def sql(rounds: int = ROUNDS) -> str:
    """DuckDB SQL of :func:`digest`: every round searches all entries (distance and number in one integer)."""
    ctes = [
        ("kept", f"""SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""),
        ("numbered", "SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rn FROM kept"),
        ("parts", f"""SELECT rn, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS x
            FROM numbered, (SELECT unnest(range({PARTS})) AS p)"""),
        ("c0", f"SELECT p, rn - 1 AS e, x AS c FROM parts WHERE rn <= {ENTRIES}"),
    ]
    for r in range(rounds + 1):
        ctes.append((f"a{r}", f"""SELECT rn, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {ENTRIES} + e) AS best
            FROM parts JOIN c{r} USING (p) GROUP BY rn, p"""))
        if r == rounds:
            break
        ctes.append((f"s{r}", f"""SELECT p, e, i, sum(y) AS s, count(*) AS n FROM (
            SELECT p, best % {ENTRIES} AS e, unnest(range(len(x))) AS i, unnest(x) AS y FROM parts JOIN a{r} USING (rn, p)) GROUP BY p, e, i"""))
        ctes.append((f"m{r}", f"SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY p, e"))
        ctes.append((f"c{r + 1}", f"SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m ON m.p = o.p AND m.e = o.e"))
    ctes.append(("coded", f"""SELECT rn, string_agg(lpad(lower(to_hex(best % {ENTRIES})), 2, '0'), '' ORDER BY p) AS code, sum(best // {ENTRIES}) AS error
        FROM a{rounds} GROUP BY rn"""))
    ctes.append(("book", f"SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM c{rounds}"))
    body = ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in ctes)
    return f"""WITH {body}
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM numbered JOIN coded USING (rn), book"""


SQL = sql()
