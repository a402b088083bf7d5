"""Token files: ids equal to the library's on whole texts, and an exact round trip through the files."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from orderstar.llm import token_files as T
from orderstar.session import scratch_path

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = [
    None, "", " ", "a", "A.B'c d's 'T x", "a.'b a'.b don't. 'll", "é ́x a.́b 9.é é.9", "x<|endoftext|>y <|STARTOFTEXT|> .<|startoftext|>",
    "日本語 text—dash… nbsp em", "tab\tnew\nline\x0b\x0c\r end", "12,345.67 +49 (0)30-123", "😀👍🏽 a😀.b", "ΣΑΣ İI", "word " * 5000, "w" * 3000, "\x00\x1f.a",
]


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def sample(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(150).collect()]


def test_files_hold_the_library_ids(spark):
    texts = ODD + sample(spark)
    docs = spark.createDataFrame([(t, 3 * i, "z") for i, t in enumerate(texts)], "text string, doc_id long, start string").repartition(6)
    root = scratch_path(spark, "test-op4")
    manifest = T.write_token_files(docs, root, PATH, 1, 64)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.read_digests(manifest).collect()}
    at, want = 0, {}
    for i, ids in enumerate(whole(texts)):
        want[3 * i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
    row = manifest.orderBy("part").first()
    part = T.TokenPart(row.path)
    stream = np.concatenate(list(part.ids(0, row.n_ids)))
    rows = [part.sequence(i) for i in range(-(-row.n_ids // 64))]
    assert np.array_equal(np.concatenate([ids[mask] for ids, mask in rows]), stream) and all(len(ids) == 64 for ids, _ in rows)


@pytest.mark.parametrize("texts", [ODD, ["a.b " * 40, "<| x", "q"]])
def test_encoder_matches_library(texts):
    import pyarrow as pa

    data, offsets = T.flat(pa.array(texts, pa.string()))
    ids, bounds = T.Encoder(PATH).encode(data, offsets)
    assert [[*ids[a:b].tolist(), 1] for a, b in zip(bounds[:-1], bounds[1:])] == whole(texts)


def test_empty_and_repeated_ids(spark):
    assert T.digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c")], "doc_id long, text string")
    assert [(r.doc_id, r.start, r.n_tokens) for r in T.digest(docs, PATH).orderBy("start").collect()] == [(None, 0, 2), (1, 2, 2), (1, 4, 2)]


class Counted:
    """A tokenizer that notes the texts encoded by its whole way."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, []

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.seen += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def encoded(enc, texts):
    import pyarrow as pa

    ids, bounds = enc.encode(*T.flat(pa.array(texts, pa.string())))
    return [[*ids[a:b].tolist(), 1] for a, b in zip(bounds[:-1], bounds[1:])]


def test_letter_runs_go_to_the_model():
    """Only pieces with other characters take the library's pattern search, which made up most of the CPU time."""
    texts = ["Straße ÉTÉ déjà Ελλάς МОСКВА 東京 한국 plain words", "x1 it's é1 a.b İx Ⱥ ʰa", "<|endoftext|> ABC"]
    enc = T.Encoder(PATH)
    enc.tokenizer = Counted(enc.tokenizer)
    assert encoded(enc, texts[:2]) == whole(texts[:2])
    # the last three change to what is no plain run of letters, or are newer letters
    assert {"x1", "it's", "é1"} <= {*enc.tokenizer.seen} <= {"x1", "it's", "é1", ".", "İx", "Ⱥ"}
    enc.tokenizer.seen.clear()
    assert encoded(enc, texts[2:]) == whole(texts[2:]) and enc.tokenizer.seen == ["<|endoftext|>"]


def test_every_letter_equals_the_library():
    letters = [c for c in map(chr, [*range(0x21, 0xD800), *range(0xE000, 0x10000), *range(0x10400, 0x10450), *range(0x1E900, 0x1E944)]) if c.isalpha()]
    texts = [f"{a}{b}x {b}ſa{a}" for a, b in zip(letters, letters[1:] + letters[:1])]
    assert encoded(T.Encoder(PATH), texts) == whole(texts)


def test_another_tokenizer_takes_its_whole_way(tmp_path):
    from tokenizers import Tokenizer, normalizers

    t = Tokenizer.from_file(PATH)
    t.normalizer = normalizers.Sequence([normalizers.StripAccents(), normalizers.Lowercase()])
    t.save(str(tmp_path / "other.json"))
    enc = T.Encoder(str(tmp_path / "other.json"))
    texts = ["café plain", "naïve"]
    assert encoded(enc, texts) == [[*e.ids, 1] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_known_pieces_are_found_and_given_up(monkeypatch):
    """Equal low bits of hashes, growth over many slices, and clearing at the stated size."""
    enc = T.Encoder(PATH)
    keys = np.arange(40_000, dtype=np.uint64) << np.uint64(40)
    keys[::2] += np.arange(20_000, dtype=np.uint64)
    enc._piece_ids = lambda texts: [[len(x)] * (len(x) % 3) for x in texts]
    for i in range(0, 1000, 100):
        enc._learn(keys[i : i + 100], ["a" * j for j in range(100)])
    assert enc._find(keys[:1000]).tolist() == [*range(1000)] and (enc._find(keys[1000:3000]) == -1).all()
    assert enc.pool[enc.at[50] : enc.at[51]].tolist() == [50] * 2
    monkeypatch.setattr(T, "CACHE_PIECES", 500)
    enc = T.Encoder(PATH)
    sizes = []
    for i in range(6):
        texts = [f"w{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}{chr(97 + i)} a" for j in range(400)]
        assert encoded(enc, texts) == whole(texts)
        sizes.append(enc.n)
    assert max(sizes) < 1000 and len(enc.slot) >= 2 * enc.n
