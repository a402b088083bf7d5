"""Sentence-span removal against brute force."""

import re

import numpy as np

from orderstar.llm import sentence_spans as S


def split(t):
    """Sentences as (start, end, words)."""
    out, now = [], []
    ms = list(re.finditer(r"[^\x20\x09-\x0D]+", t))
    for i, m in enumerate(ms):
        now.append(m)
        if m[0][-1] in ".!?" or i + 1 == len(ms) or "\n" in t[m.end() : ms[i + 1].start()]:
            out.append(now)
            now = []
    return out


def brute(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        s = split(t or "")
        remove = set()
        for a in range(len(s)):
            b = a + S.RUN
            while b < len(s) and sum(map(len, s[a:b])) < S.MIN_WORDS:
                b += 1
            if b > len(s) or sum(map(len, s[a:b])) < S.MIN_WORDS:
                continue
            key = tuple(m[0] for x in s[a:b] for m in x)
            if key in seen:
                remove.update(range(a, b))
            seen.setdefault(key, (i, a))
        text = "".join(
            c for k, c in enumerate(t or "") if not any(s[x][0].start() <= k < (s[x + 1][0].start() if x + 1 < len(s) else len(t)) for x in remove)
        )
        out[i] = (len(s), len(remove), sum(1 for x in remove if x - 1 not in remove), text if t is not None else None)
    return out


def test_removal_matches_brute_force(spark):
    r = np.random.default_rng(8)
    vocab = ["la", "ción", "the", "onz", "tr", "x", "über"]
    sentence = lambda: " ".join(r.choice(vocab, int(r.integers(1, 9)))) + str(r.choice([".", "!", ".\n", "\n", "? "]))
    passage = " ".join(sentence() for _ in range(6))
    rows = [(0, None), (1, ""), (2, "one"), (3, "a. " * 40)]
    for i in range(4, 50):
        t = " ".join(sentence() for _ in range(int(r.integers(1, 12))))
        if r.random() < 0.5:
            t += " glued " + passage + " " + sentence()
        if i % 9 == 0:
            t = rows[-1][1]
        rows.append((i, t))
    docs = spark.createDataFrame([(t, i, 3, "q") for i, t in rows], "text string, doc_id long, h int, id string").repartition(4)
    got = {x.doc_id: (x.n_sentences, x.n_removed, x.n_spans, x.text) for x in S.digest(docs).collect()}
    assert got == brute(rows)


def test_empty_and_repeated_rows(spark):
    assert S.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = "One two three four five six. Seven eight nine ten eleven twelve. End."
    got = S.digest(spark.createDataFrame([(4, text), (4, text), (None, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (4, 2), (4, 2)]


def test_passages_within_sentences_and_other_marks(spark):
    r = np.random.default_rng(3)
    words = lambda n: " ".join(f"w{x}" for x in r.integers(0, 10**6, n))
    han = lambda n: "".join(chr(x) for x in r.integers(0x4E00, 0x9FA0, n))
    passage, quoted, wide = words(60), f'"{words(9)}." ({words(9)}!) "{words(9)}?"', f"{han(9)}。{han(9)}！「{han(9)}。」"
    texts = [f"{words(20)} {passage} {words(20)}", f"{words(9)}. {words(3)} {passage}, {words(40)}!", f"{words(6)}. {quoted} {words(6)}.", f"{words(8)}. {quoted} {words(8)}."]
    texts += [f"{han(5)}。{wide}{han(6)}。", f"{han(7)}。{wide}{han(4)}。", f"{words(70)}", f"{han(70)}。"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in S.digest(docs).collect()}
    assert all(got[i].text == texts[i] for i in (0, 2, 4, 6, 7))
    assert len(set(passage.split()) - set(got[1].text.split())) >= 30
    assert got[3].text == texts[3].replace(quoted + " ", "")
    assert got[5].text == texts[5].replace(wide, "")


def test_texts_under_one_id_are_documents(spark):
    shared = "One two three four five six. Seven eight nine ten eleven twelve."
    texts = [f"Only here at the start. {shared}", f"{shared} Another ending that is longer than the first text is."]
    for i in (None, 7):
        got = S.digest(spark.createDataFrame([(i, t) for t in texts], "doc_id long, text string")).collect()
        assert {r.doc_id for r in got} == {i} and sorted(r.n_removed for r in got) == [0, 2]
        assert sorted(r.text.replace(shared, "").strip() for r in got) == sorted(t.replace(shared, "").strip() for t in texts)


def test_no_id_is_not_the_smallest_id(spark):
    """A real id of -2**63 stays itself, beside a document without one that has the same text."""
    from orderstar.llm import sentence_spans

    text = " ".join(" ".join(f"word{10 * k + i}" for i in range(9)) + "." for k in range(6))
    rows = [(None, text), (-(1 << 63), text), (3, text)]
    got = {(r.doc_id is None, r.doc_id): r.n_removed for r in sentence_spans.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {(True, None), (False, -(1 << 63)), (False, 3)} and sorted(got.values())[0] == 0 and got[False, 3] > 0 and sorted(got.values())[1] > 0
