"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps its measurements and one bit per failed rule in
``fail_bits``. A policy is a versioned set of rules: it keeps a document when ``fail_bits & mask = 0``, so policies
are applied and changed without reading a text again. :func:`ablations` answers, from the ledger, what each
rule of a policy removes and what it alone removes, by counting bit patterns (at most ``2 ** rules`` groups,
combined before the shuffle).

Words are runs of characters other than ``\\x20 \\x09-\\x0D``; lines are split at ``\\n``.

Cases: a null text has no words, fails ``few_words`` and is not kept; very long texts are measured whole;
an empty table gives an empty ledger; repeated
rows get equal ledger rows; other columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8

#: Bit number, rule, and when it fails, in terms of the measurements (also valid SQL of other engines).
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 5 * word_chars"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_upper > 50 * word_chars"),
    ("marks", "100 * n_marks > 5 * word_chars"),
    ("word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, (name, _) in enumerate(RULES) if name in self.rules)


POLICIES = {p.version: p for p in (Policy("base-1", BASE), Policy("strict-1", tuple(name for name, _ in RULES)))}


def _repeated_words() -> Column:
    """Words inside windows found twice or more, from the positions of those windows: each adds what its
    predecessor does not already cover."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))

    def add(acc: Column, p: Column) -> Column:
        return F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n"), p.alias("last"))

    return F.coalesce(F.aggregate("repeated", zero, add)["n"], F.lit(0).cast("long"))


def measurements(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every whole text. The repeated windows are found within the row: hashes
    of all windows, sorted with their places only where some hash occurs twice."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    blank = "[\\x20\\x09-\\x0D]+"
    base = base.select(
        "doc_id",
        F.filter(F.split("t", blank), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        *(F.regexp_count("t", F.lit(p)).cast("long").alias(n) for n, p in (("n_symbols", "[#*$%&|<>]"), ("n_upper", "[A-Z]"), ("n_marks", "[!?]"))),
    )
    zero = F.lit(0).cast("long")
    places = F.sequence(F.lit(1), F.size("w") - (WINDOW - 1))
    base = base.select(
        "doc_id", "n_symbols", "n_upper", "n_marks",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", zero, lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, F.transform(places, lambda i: F.xxhash64(F.slice("w", i, WINDOW)))).alias("h"),
    )
    placed = F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), placed)).drop("h")
    # in the sorted array, a window is repeated if its neighbour on either side has its hash
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice(F.col("s.h"), F.lit(1), F.size("s") - 1))
    after = F.concat(F.slice(F.col("s.h"), F.lit(2), F.size("s") - 1), F.array(F.lit(None).cast("long")))
    near = F.when(F.col("s").isNotNull(), F.arrays_zip(F.col("s.h").alias("h"), F.col("s.i").alias("i"), before.alias("b"), after.alias("a")))
    base = base.withColumn("near", near).drop("s")
    mine = F.filter("near", lambda x: x["h"].eqNullSafe(x["b"]) | x["h"].eqNullSafe(x["a"]))
    base = base.withColumn("repeated", F.array_sort(F.transform(mine, lambda x: x["i"]))).drop("near")
    return base.withColumn("n_repeat_words", _repeated_words()).drop("repeated")


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits`` of each document."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measurements(docs).withColumn("fail_bits", total.cast("long"))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """``kept`` and ``policy`` for each row of a ledger; ``base_failed`` always keeps a document out."""
    failed = lambda mask: F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) != 0
    base = failed(POLICIES["base-1"].mask)
    return rows.select("*", base.alias("base_failed"), (~base & ~failed(policy.mask)).alias("kept"), F.lit(policy.version).alias("policy"))


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: ``n_failed`` documents, and ``n_only`` that no other of its rules removes (what
    dropping the rule would bring back)."""
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    named = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (name, _) in enumerate(RULES) if name in policy.rules))
    each = patterns.select("bits", "n", F.explode(named).alias("r")).select("bits", "n", "r.*")
    has, only = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(count(has)("n_failed"), count(only)("n_only")).withColumn("policy", F.lit(policy.version))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query: the ledger under the strict policy."""
    return apply_policy(ledger(docs), POLICIES["strict-1"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits"
    )


def _sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(RULES))
    return f"""
WITH t AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, COALESCE(text, '') AS t, row_number() OVER () AS r FROM documents),
m AS (SELECT r, doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
      CAST(length(regexp_replace(t, '[^!?]', '', 'g')) AS BIGINT) AS n_marks FROM t),
k AS (SELECT r, i, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS key
      FROM (SELECT r, w, UNNEST(range(0, greatest(len(w) - {WINDOW - 1}, 0))) AS i FROM m)),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, key) AS c FROM k) WHERE c > 1),
q AS (SELECT r, CAST(sum(least({WINDOW}, d)) AS BIGINT) AS n
      FROM (SELECT r, i - COALESCE(lag(i) OVER (PARTITION BY r ORDER BY i), -{WINDOW}) AS d FROM p) GROUP BY r),
a AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, n_symbols, n_upper, n_marks,
      CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(lines) AS BIGINT) AS n_lines,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, COALESCE(q.n, 0) AS n_repeat_words
      FROM m LEFT JOIN q USING (r)),
b AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {POLICIES['base-1'].mask}) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""


SQL = _sql()
