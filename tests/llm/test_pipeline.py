"""The pipeline against its parts worked out plainly on a small table."""


import numpy as np
import sentencepiece

import corpus_pipeline as C
from orderstar.llm import piece_transducer
from orderstar.session import scratch_path
from tests.llm.test_jaccard_join import brute

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo".split()
ITEM = "what is the exact colour of the third house beyond the northern river bridge"


def table():
    r = np.random.default_rng(11)
    plain = lambda n=40: " ".join(f"{r.choice(WORDS)}{r.integers(0, 12)}" for _ in range(n))
    rows = [(i, plain()) for i in range(60)]
    rows += [(60 + i, rows[i][1].upper()) for i in range(10)]
    rows += [(94, f"{plain(9)} {ITEM} {plain(9)}"), (95, f"mail ann.b@c.org or call +1 555 123 4567 {plain(12)}"), (96, None), (97, ""), (None, "no id 10.1.2.3")]
    rows += [(100 + i, f"{plain()} vile nasty horrid vile {plain(10)}") for i in range(90)]
    rows += [(200 + i, plain()) for i in range(90)]
    return [(i, t, "en", "s", len(t or ""), 1.5) for i, t in rows]


def test_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, node double"
    folder = scratch_path(spark, "test-pipeline")
    rows = table()
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(100 <= i < 190)) for i in [*range(60), *range(100, 190), *range(200, 290)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {}
    for name, function in C.STAGES:
        out = C.stage(function(spark, docs, folder), f"test-{name}")
        if name != "pieces":
            assert out.dtypes == docs.dtypes
        steps[name] = docs = out
    ids = lambda df: sorted(-1 if r.doc_id is None else r.doc_id for r in df.select("doc_id").collect())
    clean = ids(steps["toxicity"])
    assert not set(range(100, 190)) & set(clean) and set(range(70)) | {94, 95, 96, 97, -1, *range(200, 290)} <= set(clean)
    left = [(r.doc_id, r.text) for r in steps["toxicity"].collect() if r.doc_id is not None]
    groups = brute(left)
    assert ids(steps["jaccard_join"]) == [-1, *sorted(i for i, _ in left if groups[i][1] == i)]
    assert set(ids(steps["jaccard_join"])) - set(ids(steps["decontamination"])) == {94}
    masked = {r.doc_id: (r.text, r.n_chars) for r in steps["pii"].collect()}
    assert masked[95][0].startswith("mail <EMAIL> or call <PHONE>") and masked[95][1] == len(masked[95][0])
    assert masked[None][0] == "no id <IP>" and masked[96][0] is None and masked[97][0] == ""
    library = sentencepiece.SentencePieceProcessor(model_file=piece_transducer.public_model())
    assert {r.doc_id: r.ids for r in steps["pieces"].collect()} == {i: library.encode(t or "") for i, (t, _) in masked.items()}
    result = C.run(spark, folder)
    assert sorted(map(str, result.collect())) == sorted(map(str, steps["pieces"].collect()))


def test_two_texts_under_one_id_and_clashing_columns(spark):
    """Each text is judged by itself, in every stage; columns named like those the operators use inside stay as they are."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, label_id string, toxic string, h string, gone string, node string"
    folder = scratch_path(spark, "test-pipeline-ids")
    r = np.random.default_rng(3)
    plain = lambda n=40: " ".join(f"{r.choice(WORDS)}{r.integers(0, 12)}" for _ in range(n))
    a, b = plain(), plain()
    rows = [(1, a), (2, a), (2, b), (3, f"{plain(9)} {ITEM} {plain(9)}"), (3, plain()), (None, a)]
    rows += [(100 + i, f"{plain()} vile nasty horrid vile {plain(10)}") for i in range(90)] + [(200 + i, plain()) for i in range(90)]
    spark.createDataFrame([(i, t, "en", "s", len(t), "l", "t", "h", "g", "n") for i, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(100 <= i < 190)) for i in [*range(100, 190), *range(200, 290)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in C.STAGES[:3]:
        out = C.stage(function(spark, docs, folder), f"test-{name}")
        assert out.dtypes == docs.dtypes
        docs = out
    left = {(x.doc_id, x.text) for x in docs.collect()}
    assert {(1, a), (2, b), rows[4], (None, a)} <= left and not {(2, a), rows[3]} & left


def test_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = scratch_path(spark, "test-pipeline-empty")
    spark.createDataFrame([], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert C.run(spark, folder).count() == 0
