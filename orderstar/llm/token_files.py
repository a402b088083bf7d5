"""Token ids as Arrow files of fixed-size-list batches.

Every text is encoded with a public tokenizer, the end id is appended, and the ids are written in ascending
doc_id order as a continuous stream cut into sequences of equal length. A part file (Arrow IPC *file*
format) has the columns ``ids: fixed_size_list<uint16 or uint32>[length]`` and
``mask: fixed_size_list<bool>[length]`` (false only on the padding after the last id of the part), so a memory
map gives any sequence without copying. Beside it lies ``*.docs.arrow`` with ``doc_id, start, n_tokens`` of the
documents in the part. Uncompressed ids of 16 bits are used where the vocabulary allows.

Spark range-partitions and sorts the documents; a task writes one part under a name of its own attempt and
renames it when whole, so a lost task is simply repeated. The manifest has a row per part.

Encoding works on the distinct pieces of a slice of documents, cut at ASCII spaces and between ASCII
punctuation and ASCII letters or digits. No pre-token of the tokenizer spans such a place and its
normaliser does not look across it, so the ids are those of the whole text (tests compare them). A piece of letters only is
a single pre-token, so it goes to the library's BPE model without the pattern search (its normaliser and byte alphabet are
applied to many such pieces at once); other pieces, and other tokenizers, take the library's whole way.

Cases: a null text counts as empty and has only the end id; a null doc_id sorts first; rows with equal ids
are all written, in the order of their texts; 
very long texts are read whole, as a slice of their own; an empty table writes no part; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstar.llm.sparkops import stage
from orderstar.llm.textops import SPACE, flat, prefix_hash, range_hash, slices
from orderstar.session import scratch_path

SEQUENCE = 1024
#: Sequences in a record batch, and pieces kept with their ids in each worker process.
BATCH_ROWS = 256
CACHE_PIECES = 1 << 20

#: Bytes by kind, and for the kinds of two neighbours (4 * before + after) whether a piece ends between them.
BLANK, ALNUM, PUNCT, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[0x21:0x7F] = PUNCT
KIND[0x27] = OTHER
KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = ALNUM
KIND[SPACE] = BLANK
CUT_SPACE = np.array([(a == BLANK) != (b == BLANK) for a in range(4) for b in range(4)])
CUT_PLAIN = CUT_SPACE.copy()
CUT_PLAIN[[4 * ALNUM + PUNCT, 4 * PUNCT + ALNUM]] = True

#: The normaliser and pre-tokenizer for which a run of letters is one pre-token.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def letter_runs() -> re.Pattern:
    """Runs of letters: of Unicode 3.2 and still letters, so every version of the library's tables has them as such."""
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    return re.compile(f"[{''.join(c for c in map(chr, range(0x41, 0x10000)) if old(c)[0] == 'L' == new(c)[0])}]+")


def pieces(data: np.ndarray, offsets: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and each document's first index of the pieces; ``plain`` also cuts at punctuation."""
    kind = KIND[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = (CUT_PLAIN if plain else CUT_SPACE)[kind[:-1] << 2 | kind[1:]]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    start, end = at[:-1], at[1:]
    keep = kind[start] != BLANK if len(start) else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(start, offsets)


class Encoder:
    """Ids of whole documents, by their distinct pieces; keeps a bounded number of pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = [m.encode() for m in marks]
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.letters = None
        if (spec["normalizer"], spec["pre_tokenizer"], spec["model"]["type"]) == (NORMALIZER, PRE_TOKENIZER, "BPE"):
            # a mark within letters would be found before the pre-tokenizer
            self.letters = None if any(map(str.isalpha, marks)) else letter_runs()
        self.model = self.tokenizer.model
        # characters with all bytes of UTF-8 up to U+FFFF
        text = "".join(map(chr, [*range(0x801), *range(0x1000, 0x10000, 0x1000)]))
        self.alphabet = dict(zip(text.encode(), ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text)[0][0], strict=True))
        self.reset()

    def reset(self) -> None:
        self.n = 0
        self.key = np.zeros(1 << 14, np.uint64)
        #: numbers of the pieces by their hash, open addressing; -1: free
        self.slot = np.full(1 << 15, -1, np.int32)
        self.at = np.zeros((1 << 14) + 1, np.int64)
        self.pool = np.zeros(1 << 16, self.dtype)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1: not known."""
        mask = len(self.slot) - 1
        out = np.full(len(key), -1, np.int64)
        todo, slot = np.arange(len(key)), (key & np.uint64(mask)).astype(np.int64)
        while len(todo):
            found = self.slot[slot]
            taken = np.flatnonzero(found >= 0)
            todo, slot, found = todo[taken], slot[taken], found[taken]
            same = self.key[found] == key[todo]
            out[todo[same]] = found[same]
            todo, slot = todo[~same], slot[~same] + 1 & mask
        return out

    def _enter(self, numbers: np.ndarray) -> None:
        mask = len(self.slot) - 1
        slot = (self.key[numbers] & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            free = self.slot[slot] < 0
            self.slot[slot[free]] = numbers[free]
            lost = self.slot[slot] != numbers
            numbers, slot = numbers[lost], slot[lost] + 1 & mask

    def _piece_ids(self, texts: list[str]) -> list[list[int]]:
        if self.letters is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        words: list[str | None] = [t if t.isascii() and t.isalpha() and t.islower() else None for t in texts]
        wide = [i for i, w in enumerate(words) if w is None and texts[i].isalpha()]
        if wide:
            joined = self.tokenizer.normalizer.normalize_str(" ".join([texts[i] for i in wide]))
            mapped = joined.encode().decode("latin-1").translate(self.alphabet).split(self.alphabet[0x20])
            for i, word, m in zip(wide, joined.split(" "), mapped, strict=True):
                if self.letters.fullmatch(word):
                    words[i] = m
        tokenize = self.model.tokenize
        out = [[t.id for t in tokenize(w)] if w is not None else None for w in words]
        rest = [i for i, w in enumerate(words) if w is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        found = self._piece_ids(texts)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        n, m, begin = self.n, self.n + len(keys), int(self.at[self.n])
        end = begin + int(sizes.sum())
        if end > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(max(len(self.pool), end - len(self.pool)), self.dtype)))
        if m > len(self.key):
            more = max(len(self.key), m - len(self.key))
            self.key, self.at = (np.concatenate((x, np.zeros(more, x.dtype))) for x in (self.key, self.at))
        self.pool[begin:end] = np.fromiter(chain.from_iterable(found), self.dtype, end - begin)
        self.at[n + 1 : m + 1] = begin + np.cumsum(sizes)
        self.key[n:m] = keys
        self.n = m
        if 2 * m > len(self.slot):
            self.slot, n = np.full(2 << (2 * m).bit_length(), -1, np.int32), 0
        self._enter(np.arange(n, m, dtype=np.int32))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice, and ``len + 1`` offsets."""
        text = data.tobytes()
        low = text.lower()
        plain = not any(m in low for m in (b"<|", *self.marks))
        text = low if plain else text
        folded = np.frombuffer(text, np.uint8)
        start, end, first = pieces(folded, offsets, plain)
        key = range_hash(prefix_hash(folded), start, end)
        if self.n > CACHE_PIECES:
            self.reset()
        number = self._find(key)
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            distinct, at, inverse = np.unique(key[fresh], return_index=True, return_inverse=True)
            begin, close = start[fresh[at]].tolist(), end[fresh[at]].tolist()
            number[fresh] = self.n + inverse
            for i in range(0, len(distinct), 4096):
                self._learn(distinct[i : i + 4096], [text[a:b].decode() for a, b in zip(begin[i : i + 4096], close[i : i + 4096])])
        begin = self.at[number]
        size = self.at[number + 1] - begin
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = self.pool[np.arange(total[-1]) - np.repeat(total[:-1] - begin, size)]
        return ids, total[first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _filesystem(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _write(root: str, tokenizer: str, end_id: int, length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        files, folder = _filesystem(root)
        name = f"{folder}/part-{part:06d}"
        mine = f"{folder}/_attempt-{part:06d}-{context.taskAttemptId()}"
        enc = encoder(tokenizer)
        kind = pa.from_numpy_dtype(enc.dtype)
        schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        doc_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        total, n_docs, held, out, index = 0, 0, np.zeros(0, enc.dtype), None, None

        def flush(ids: np.ndarray, fill: int) -> None:
            mask = np.ones(len(ids), bool)
            mask[len(ids) - fill :] = False
            for i in range(0, len(ids), BATCH_ROWS * length):
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[i : i + BATCH_ROWS * length]), length) for x in (ids, mask)]
                out.write_batch(pa.RecordBatch.from_arrays(lists, schema=schema))

        streams = []
        for batch in slices(batches):
            if out is None:
                streams = [files.open_output_stream(f"{mine}{x}") for x in (".arrow", ".docs.arrow")]
                out, index = pa.ipc.new_file(streams[0], schema), pa.ipc.new_file(streams[1], doc_schema)
            data, offsets = flat(batch.column("text"))
            ids, bounds = enc.encode(data, offsets)
            n = len(offsets) - 1
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(n + 1)
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total + bounds[:-1]), pa.array(np.diff(bounds))], schema=doc_schema))
            total, n_docs = total + len(ids), n_docs + n
            held = np.concatenate((held, ids))
            whole = len(held) // length * length
            if whole:
                flush(held[:whole], 0)
                held = held[whole:].copy()
        if out is None:
            return
        if len(held):
            fill = -len(held) % length
            flush(np.concatenate((held, np.zeros(fill, enc.dtype))), fill)
        out.close()
        index.close()
        for x in streams:
            x.close()
        for x in (".arrow", ".docs.arrow"):
            if files.get_file_info(f"{name}{x}").type.name != "NotFound":
                files.delete_file(f"{name}{x}")
            files.move(f"{mine}{x}", f"{name}{x}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([f"{root}/part-{part:06d}"]), pa.array([n_docs], pa.int64()), pa.array([total], pa.int64())], names=["part", "path", "n_docs", "n_ids"]
        )

    return rows


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int, length: int = SEQUENCE) -> DataFrame:
    """Write the parts below ``root`` (a folder that driver and executors share); returns the manifest
    ``part, path, n_docs, n_ids, start`` (``start``: ids of all parts before)."""
    _files, folder = _filesystem(root)
    _files.create_dir(folder)
    sorted_docs = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    manifest = stage(sorted_docs.mapInArrow(_write(root, tokenizer, end_id, length), "part long, path string, n_docs long, n_ids long"), "op4-manifest")
    # one row per part file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stage(manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "op4-starts")


class TokenPart:
    """Random access to a part: any range of ids, any sequence with its mask."""

    def __init__(self, path: str):
        files, place = _filesystem(path)
        local = type(files).__name__ == "LocalFileSystem"
        self.source = pa.memory_map(f"{place}.arrow") if local else files.open_input_file(f"{place}.arrow")
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        with files.open_input_file(f"{place}.docs.arrow") as f:
            self.docs = pa.ipc.open_file(f).read_all()
        rows = [0]
        self.batches = [self.reader.get_batch(i) for i in range(self.reader.num_record_batches)] if local else None
        for i in range(self.reader.num_record_batches):
            rows.append(rows[-1] + self._batch(i).num_rows)
        self.rows = np.array(rows)

    def _batch(self, i: int) -> pa.RecordBatch:
        return self.batches[i] if self.batches else self.reader.get_batch(i)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``; the ids are a view of the file."""
        b = int(np.searchsorted(self.rows, i, side="right")) - 1
        batch = self._batch(b)
        ids, mask = (batch.column(c)[i - int(self.rows[b])].values for c in ("ids", "mask"))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids ``start .. start + n`` as views, a batch at a time."""
        while n:
            b = int(np.searchsorted(self.rows * self.length, start, side="right")) - 1
            values = self._batch(b).column("ids").values.to_numpy()
            at = start - int(self.rows[b]) * self.length
            view = values[at : at + n]
            yield view
            start, n = start + len(view), n - len(view)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, before in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            part = TokenPart(path)
            for docs in part.docs.to_batches(max_chunksize=10_000):
                start, size = (docs.column(c).to_numpy() for c in ("start", "n_tokens"))
                crc = []
                for s, n in zip(start.tolist(), size.tolist()):
                    value = 0
                    for view in part.ids(s, n):
                        value = zlib.crc32(view.astype("<u4").tobytes(), value)
                    crc.append(value)
                yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(start + before), docs.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = manifest.sparkSession
    n = max(1, manifest.count())
    parts = manifest.select("path", "start").repartition(min(n, 4 * spark.sparkContext.defaultParallelism))
    return parts.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """The registered query: write the files in the shared scratch folder, read them back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    root = scratch_path(docs.sparkSession, "op4-tokens")
    return read_digests(write_token_files(docs, root, str(tokenizer), end_id))
