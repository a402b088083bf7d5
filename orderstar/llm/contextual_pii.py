"""Personal data: fixed patterns, and identifiers found by bootstrapped contextual extraction.

*Base spans* are the leftmost non-overlapping matches of fixed patterns (``email``, ``ip``, ``card``, ``phone``), less those
that fail a check (parts up to 255; 12 to 19 digits with a valid check digit; 9 to 15 digits).

*Contextual spans.* The base spans are the seed entities. A lexical pattern is the neighbourhood of an entity: its
shape (runs of digits, letters and signs) with the words before it, after it, or both; for a number (no letter and no
``@``) also the same words with any number. The candidates are
all words with at least ``MIN_DIGITS`` digits or an ``@`` that overlap no base span. Candidates and seeds with their
patterns form a graph, whose two sides are scored in turn for ``ROUNDS`` rounds, per kind:

* the patterns of a round are those of two distinct words that are seeds or reached ``ACCEPT`` in the round before, so found
  words bring contexts of their own;
* a pattern's score is the mean score of its instances, damped by ``DAMPING`` unscored ones;
* an instance's score is ``1 - prod(1 - pattern score)``, where of a context's two patterns (with and without the shape) the
  higher score counts; seeds keep 1.

Instances count once per distinct word, so copies of a passage do not make a pattern strong. Candidates that reach
``ACCEPT`` are found spans of their best kind. The edges are aggregated per pattern and per instance (combined on
the map side); both sides of each join are written, so Spark can split a very common pattern.

Cases: a null text counts as empty; very long texts are read whole, as a slice of their own; 
a null id passes through; repeated rows get equal spans; ties between kinds go to the
first listed; an empty table gives an empty result; further columns are ignored by :func:`find` and kept by :func:`mask`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import slices

KINDS = ("email", "ip", "card", "phone")
MIN_DIGITS = 4
ROUNDS = 3
DAMPING = 2.0
ACCEPT = 0.8

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match never starts inside a run of digits (it would have started with the run), which keeps the scan linear.
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]")
LETTER = re.compile(r"[^\W\d_]|@")
SIGN = re.compile(r"[0-9@]")
EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from the ``@`` signs on (a scan of every word would be slow)."""
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in EMAIL_CHARS:
            begin -= 1
        m = EMAIL.match(text, begin) if begin < at else None
        if m:
            yield m.start(), m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` in code points, by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(g.lstrip("0")) <= 3 and int(g[-4:] if g.lstrip("0") else 0) <= 255 for g in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGITS.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    """Runs of digits as ``9``, of letters as ``a``; other characters stay."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", word))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def candidates(text: str) -> Iterator[tuple[int, str]]:
    """Words with enough digits or an ``@``, and where they start."""
    done = 0
    for m in SIGN.finditer(text):
        if m.start() < done:
            continue
        begin = m.start()
        while begin > done and not SPACE.match(text[begin - 1]):
            begin -= 1
        stop = SPACE.search(text, m.start())
        done = stop.start() if stop else len(text)
        word = text[begin:done]
        if "@" in word or len(DIGITS.findall(word)) >= MIN_DIGITS:
            yield begin, word


def instances(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, list[dict]]]:
    """``(start, end, kind index or -1, word hash, hashes of patterns and their contexts)`` of the seeds and candidates of a text."""
    todo = [(a, b, k) for a, k, b in spans]
    taken = sorted((a, b) for a, b, _ in todo)
    i = 0
    for begin, whole in candidates(text):
        while i < len(taken) and taken[i][1] <= begin:
            i += 1
        if i < len(taken) and taken[i][0] < begin + len(whole):
            continue
        word = whole.strip(".,;:!?\"'()[]<>{}|")
        if word:
            a = begin + whole.index(word)
            todo.append((a, a + len(word), -1))
    for a, b, kind in todo:
        word = text[a:b]
        before = [x.lower().strip(".,;") for x in WORD.findall(text[max(0, a - 60) : a])[-2:]]
        after = [x.lower().strip(".,;") for x in WORD.findall(text[b : b + 40])[:1]]
        keys = []
        if before:
            keys.append(f"l\x1f{before[-1]}")
        if len(before) == 2:
            keys.append(f"ll\x1f{before[0]}\x1f{before[1]}")
        if after:
            keys.append(f"r\x1f{after[0]}")
        if before and after:
            keys.append(f"lr\x1f{before[-1]}\x1f{after[0]}")
        forms = [shape(word)] if LETTER.search(word) else [shape(word), "number"]
        yield a, b, kind, _hash(word), [{"pattern": _hash(f"{k}\x1f{form}"), "context": _hash(k)} for k in keys for form in forms]


ROW = (
    "doc_id long, row long, base array<struct<start:int,kind:int,end:int>>, "
    "found array<struct<start:int,end:int,kind:int,word:long,patterns:array<struct<pattern:long,context:long>>>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    pattern_type = pa.list_(pa.struct([("pattern", pa.int64()), ("context", pa.int64())]))
    found_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("word", pa.int64()), ("patterns", pattern_type)]))
    for batch in slices(batches):
        base, found = [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text or "")
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            more = instances(text, spans) if text and (spans or DIGITS.search(text) or "@" in text) else ()
            found.append([{"start": a, "end": b, "kind": k, "word": w, "patterns": p} for a, b, k, w, p in more])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(base, base_type), pa.array(found, found_type)], names=["doc_id", "row", "base", "found"])


def _row_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def bootstrap(scan: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT) -> DataFrame:
    """Found spans ``doc_id, row, start, end, kind`` (kind index) from the scanned instances."""
    each = scan.select("doc_id", "row", F.explode("found").alias("f")).select("doc_id", "row", "f.*")
    pairs = stage(each.select("word", F.explode("patterns").alias("p")).select("p.pattern", "p.context", "word").distinct(), "op3-edges")
    # all instances of a pattern, seeds and candidates, as the denominator; a pattern of one word never counts
    degree = stage(pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "op3-degree")
    pairs = stage(pairs.join(degree.select("pattern"), "pattern"), "op3-pairs")
    known = stage(each.where("kind >= 0").select("word", "kind", F.lit(1.0).alias("score")).distinct(), "op3-scores-0")
    scores = known
    for k in range(rounds):
        active = scores.where(F.col("score") >= accept).select("word").distinct()
        shared = stage(pairs.join(active, "word").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pattern"), f"op3-patterns-{k}")
        held = stage(pairs.join(shared, "pattern"), f"op3-held-{k}")
        mass = stage(held.join(scores, "word").groupBy("pattern", "kind").agg(F.sum("score").alias("mass")), f"op3-mass-{k}")
        strength = stage(mass.join(degree, "pattern").select("pattern", "kind", (F.col("mass") / (F.col("n") + DAMPING)).alias("p")), f"op3-strength-{k}")
        rest = F.sum(F.log1p(-F.least(F.col("p"), F.lit(1 - 1e-9))))
        contexts = held.join(strength, "pattern").groupBy("word", "kind", "context").agg(F.max("p").alias("p"))
        next_scores = contexts.groupBy("word", "kind").agg((1 - F.exp(rest)).alias("score"))
        fixed = known.select("word", F.col("kind").alias("seed_kind"))
        # a word that is a seed somewhere keeps its own kind
        merged = next_scores.join(fixed, "word", "left_anti").union(known)
        scores = stage(merged, f"op3-scores-{k + 1}")
    best = scores.groupBy("word").agg(F.max("score").alias("score"), F.min_by("kind", F.struct(-F.col("score"), F.col("kind"))).alias("best"))
    good = stage(best.where(F.col("score") >= accept).select("word", "best"), "op3-good")
    return each.where("kind < 0").select("doc_id", "row", "start", "end", "word").join(good, "word").select("doc_id", "row", "start", "end", F.col("best").alias("kind"))


def find(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, row`` (text hash), ``base`` and ``more``: arrays of ``(start, kind, end)``, kind an index of ``KINDS``."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_hash().alias("row"), F.col("text").cast("string").alias("text"))
    scan = stage(plain.mapInArrow(_scan, ROW), "op3-scan")
    more = bootstrap(scan).groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))
    more = stage(more.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "more"), "op3-more")
    rows = scan.select("doc_id", "row", "base")
    joined = rows.join(more, rows["doc_id"].eqNullSafe(more["d"]) & (rows["row"] == more["r"]), "left")
    return joined.select("doc_id", "row", F.sort_array("base").alias("base"), F.sort_array(F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))).alias("more"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query."""
    found = find(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *map(count, range(4)), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.sort_array(F.concat("base", "more"))).alias("spans"), F.size("more").cast("long").alias("n_contextual"))


def _mask(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["end"] <= at:
            continue
        out.append(text[at : max(at, s["start"])])
        if s["start"] >= at:
            out.append(f"<{KINDS[s['kind']].upper()}>")
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def mask(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with every span of its texts replaced by its kind, such as ``<EMAIL>``."""
    found = stage(find(docs).where((F.size("base") > 0) | (F.size("more") > 0)).select("row", F.concat("base", "more").alias("spans")).dropDuplicates(["row"]), "op3-mask")
    columns = docs.columns
    marked = docs.select(F.struct(*(F.col(c) for c in columns)).alias("document"), _row_hash().alias("row"))
    joined = marked.join(found, "row", "left").select(*(F.col(f"document.{c}").alias(f"c{i}") for i, c in enumerate(columns)), F.to_json("spans").alias("spans"))
    at = columns.index("text")

    def rows(batches):
        import json

        for batch in slices(batches, f"c{at}"):
            texts = [t if s is None or t is None else _mask(t, json.loads(s)) for t, s in zip(batch.column(f"c{at}").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(f"c{i}") for i in range(len(columns))], names=list(columns))

    return joined.mapInArrow(rows, docs.schema)
