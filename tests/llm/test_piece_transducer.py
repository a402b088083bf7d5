"""Transducer encoding against the library, and exact round trips."""

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from orderstar.llm import piece_transducer as P
from orderstar.llm.textops import flat

MODEL = P.public_model()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OURS = P.Transducer(MODEL)
ODD = [
    "", " ", "  ", "a", " a", "a ", "  a  b\tc\nd  ", "▁", "▁▁a ▁b", "<0x41> <s> </s> <unk>", "日本語のテキスト 漢字", "😀👍🏽é ́", "\x00\x01\x7f", "x" * 300, " " * 100,
    "aaaaaaaaaa aaaa", "hahahahahaha", "Über größe — “quoted” … 12,345.67", "\n\n\n  \t\t x", " nbsp　wide", "don't can't we'll", "a\r\nb", "ÀÉÎÕÜ ñandú ciónción",
]


def ours(texts):
    ids, bounds = OURS.encode(*flat(P.normalised(pa.array(texts, pa.string()))))
    assert OURS.decode(ids.astype(np.int64), bounds) == [t.replace("▁", " ") for t in texts]
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_equals_the_library_on_odd_texts():
    assert ours(ODD) == [LIBRARY.encode(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" aeinrst.▁\n'"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=5))
def test_equals_the_library_on_any_text(texts):
    assert ours(texts) == [LIBRARY.encode(t) for t in texts]


def test_query_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (-1, "x"), (-1, "x"), *((-2 - i, t) for i, t in enumerate(ODD))], "doc_id long, text string")
    docs = docs.unionByName(odd).withColumn("ids", docs["doc_id"])
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    rows = P.encode(docs).collect()
    assert sorted(((r.doc_id, r.ids) for r in rows), key=str) == sorted(((i, LIBRARY.encode(t or "")) for i, t in texts), key=str)
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    back = P.decode(P.encode(docs))
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((i, (t or "").replace("▁", " ")) for i, t in texts), key=str)


def test_empty_table(spark):
    assert P.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
