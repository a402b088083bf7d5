"""Rule ledger against a plain evaluation."""

import re

import numpy as np

from orderstar.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    cover = {j for places in seen.values() if len(places) > 1 for p in places for j in range(p, p + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), n < 20 or 100 * len(cover) > 30 * n)


def texts():
    r = np.random.default_rng(3)
    vocab = ["a", "bé", "the", "x|y", "#", "LOUD!", "ß ß", "new\x0bline"]
    out = [None, "", " \n\n\t", "a " * 7, "a " * 8, "a " * 9, "a b c d e f g h " * 3, "one\ntwo\none\n \none", "The " * 20000, "😀 " * 30]
    for _ in range(60):
        n = int(r.integers(1, 80))
        t = " ".join(r.choice(vocab, n))
        out.append(t + ("\n" + t if r.random() < 0.4 else "") + " end" * int(r.integers(0, 2)))
    return out


def test_ledger_matches_brute_force(spark):
    rows = [(t, i, "clash", 5) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in Q.digest(spark.createDataFrame(rows, "text string, doc_id long, w string, n_words int")).collect()}
    assert len(got) == len(rows)
    for t, i, *_ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), (i, t and t[:60])
        assert r.kept == (r.fail_bits == 0) and not (r.base_failed and r.kept)


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (4,), (4,), (5,)], "fail_bits long")
    assert [r.kept for r in Q.apply_policy(rows, Q.POLICIES["base-1"]).orderBy("fail_bits").collect()] == [True, False, False, True, True, False]
    got = {r.rule: (r.n_failed, r.n_only) for r in Q.ablations(rows, Q.POLICIES["strict-1"]).collect()}
    assert got["few_words"] == (3, 1) and got["symbols"] == (3, 2) and got["repeated_windows"] == (1, 0) and got["marks"] == (0, 0)


def test_empty_and_repeated_rows(spark):
    assert Q.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert Q.digest(spark.createDataFrame([(None, "x y"), (None, "x y")], "doc_id long, text string")).distinct().count() == 1
