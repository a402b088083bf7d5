"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled once per worker into three transducers that are composed with each input:

* the normaliser of the model (space to the word mark, the dummy prefix; only the identity character map, which
  the public model has, is supported),
* the pieces, an arc per piece with the weight ``-score``,
* byte fallback: a character that no piece spells is rewritten to its UTF-8 byte pieces.

For a BPE model the states remember the last piece, and the arc from one piece to the next has an infinite weight
unless the pair is *stable*: merging the characters of the two together gives the pair again. A sequence is the
BPE encoding of a string exactly if all its neighbours are stable, so just one path has a finite weight, and
it is the encoding of every prefix as well. The shortest path in the tropical semiring (min, +) therefore
keeps one state per place, and each place tries the pieces that end there. Stability is worked out once for a pair.

An input is cut where no piece spans both sides (two bytes that are neighbours in no piece), which splits the
path there; a slice of documents is encoded by its distinct parts, whose ids are kept up to ``CACHE_PARTS``.

Cases: a null or empty text has no pieces and decodes to the empty text; invalid byte pieces decode to U+FFFD as the
library's do; a null id and repeated rows pass through; very long texts are read whole, as a slice of their own; 
 an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.llm.textops import flat, prefix_hash, range_hash, release, slices

MARK = "▁"
CACHE_PARTS = 1 << 19
CACHE_PAIRS = 1 << 18


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            n = number() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


class Transducer:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        flags = {2: b"", 3: 1, 4: 1, 5: 1}
        for number, value in _fields(model.serialized_model_proto()):
            if number == 3:
                flags |= {k: v for k, v in _fields(value) if k in flags}
            if number == 2 and dict(_fields(value)).get(3, 1) != 2:
                raise ValueError("a BPE model is expected")
        if flags[2] or flags[4] or not flags[5]:
            raise ValueError("only an identity normaliser that keeps and marks spaces is supported")
        self.dummy = bool(flags[3])
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.weight = {self.text[i]: -model.get_score(i) for i in plain}
        self.id = {self.text[i]: i for i in plain}
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.control = {i for i in range(n) if model.is_control(i)}
        # the last merge of each piece that comes out of its own characters, and the ends of all pieces
        self.split: dict[str, tuple[str, str]] = {}
        self.ends: set[str] = set()
        for p in self.weight:
            if len(p) > 1 and (halves := self.merged(p, whole=p)):
                self.split[p] = halves
            self.ends.update(p[i:] for i in range(len(p)))
        # bytes (a space for the mark) that are neighbours in some piece
        near = np.zeros((256, 256), bool)
        for p in self.weight:
            b = np.frombuffer(p.replace(MARK, " ").encode(), np.uint8)
            near[b[:-1], b[1:]] = True
        near[:, 0x80:0xC0] = True  # never inside a character
        self.near = near
        self.reset()

    def reset(self) -> None:
        self.known: dict[int, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 12, np.int64)
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str, whole: str = "") -> list[str] | tuple[str, str] | None:
        """Characters merged by the smallest weight, then the leftmost place (short strings only). With ``whole``:
        the two parts whose merge gives it, or None."""
        out = list(text)
        while True:
            best = min(((self.weight[a + b], i) for i, (a, b) in enumerate(zip(out, out[1:])) if a + b in self.weight), default=None)
            if best is None:
                return None if whole else out
            i = best[1]
            if whole and out[i] + out[i + 1] == whole:
                return out[i], out[i + 1]
            out[i : i + 2] = [out[i] + out[i + 1]]

    def stable(self, a: str, b: str) -> bool:
        pair = (a, b)
        out = self.pairs.get(pair)
        if out is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            out = self.pairs[pair] = self._apart(a, b)
        return out

    def _apart(self, a: str, b: str) -> bool:
        """Whether two pieces side by side stay apart: merges are undone from the latest on, and none across the border
        may come before the merge that was undone."""
        weight, split = self.weight, self.split
        if a[-1] == MARK and b[0] == MARK:  # equal weights: the places decide
            return self.merged(a + b) == [a, b]
        limit = np.inf
        while True:
            if weight.get(a + b, np.inf) < limit:
                return False
            x, y = (weight[p] if p in split else -np.inf for p in (a, b))
            if x == y == -np.inf:
                return True
            if x > y:
                limit, a = x, split[a][1]
            else:
                # on the right side a merge of equal weight further left comes first
                limit, b = np.nextafter(y, np.inf), split[b][0]

    def path(self, text: str) -> list[int]:
        """Shortest path for a part of a normalised text: the last piece of the encoding of each prefix."""
        n = len(text)
        last: list[str] = [""] * (n + 1)
        weight, stable, ends, split = self.weight, self.stable, self.ends, self.split
        for end in range(1, n + 1):
            begin, some = end - 1, [end - 1]
            while begin > 0:
                begin -= 1
                piece = text[begin:end]
                if piece not in ends:
                    break
                if piece in split:  # a piece must come out of its own characters
                    some.append(begin)
            for begin in reversed(some):
                piece = text[begin:end]
                if begin == 0 or stable(last[begin], piece):
                    last[end] = piece
                    break
            else:
                raise ValueError("no path: the model is no BPE model")
        out: list[str] = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        ids: list[int] = []
        for piece in reversed(out):
            if piece in self.id:
                ids.append(self.id[piece])
            elif self.byte:
                ids += [self.byte[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice, and ``len + 1`` offsets."""
        if self.dummy:
            some = offsets[:-1] < offsets[1:]
            data = np.insert(data, offsets[:-1][some], 0x20)
            offsets = offsets + np.concatenate(([0], np.cumsum(some)))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = ~self.near[data[:-1], data[1:]]
        cut[offsets] = True
        at = np.flatnonzero(cut)
        start, end = at[:-1], at[1:]
        first = np.searchsorted(start, offsets)
        key = range_hash(prefix_hash(data), start, end)
        distinct, where, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_PARTS:
            self.reset()
        keys, raw = distinct.tolist(), data.tobytes()
        known = self.known
        fresh = [i for i, k in enumerate(keys) if k not in known]
        if fresh:
            found = [self.path(raw[a:b].decode().replace(" ", MARK)) for a, b in zip(start[where[fresh]].tolist(), end[where[fresh]].tolist())]
            self._keep([keys[i] for i in fresh], found)
        index = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        begin, size = self.at[index][inverse], (self.at[index + 1] - self.at[index])[inverse]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.pool[np.arange(total[-1]) - np.repeat(total[:-1] - begin, size)], total[first]

    def forget(self) -> None:
        """Drops what was learnt from texts: the worker may go on to other work."""
        self.reset()
        self.pairs.clear()
        release()

    def _keep(self, keys: list[int], found: list[list[int]]) -> None:
        have, size = len(self.known), np.fromiter(map(len, found), np.int64, len(found))
        filled = int(self.at[have])
        while have + len(keys) + 1 > len(self.at):
            self.at = np.concatenate((self.at, np.zeros(len(self.at), np.int64)))
        while filled + int(size.sum()) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), np.int32)))
        self.at[have + 1 : have + 1 + len(keys)] = filled + np.cumsum(size)
        self.pool[filled : filled + int(size.sum())] = np.concatenate(found)
        self.known.update(zip(keys, range(have, have + len(keys))))

    def spelled(self) -> list[bytes]:
        """The output bytes of each id."""
        back = {i: b for b, i in self.byte.items()}
        return [bytes([back[i]]) if i in back else b"" if i in self.control else p.replace(MARK, " ").encode() for i, p in enumerate(self.text)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of lists of ids."""
        spelled = self.spelled()
        size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        pool = np.frombuffer(b"".join(spelled), np.uint8)
        begin, n = (np.cumsum(size) - size)[ids], size[ids]
        total = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        data = pool[np.arange(total[-1]) - np.repeat(total[:-1] - begin, n)].tobytes()
        bounds = total[offsets].tolist()
        out = [data[a:b].decode(errors="replace") for a, b in zip(bounds[:-1], bounds[1:])]
        return [t[1:] if self.dummy and t[:1] == " " else t for t in out]


def normalised(column: pa.Array) -> pa.Array:
    """The texts as the model sees them, with spaces for word marks (a mark in a text is a space, too)."""
    return pc.replace_substring(column, pattern=MARK, replacement=" ")


_made: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One transducer for each worker process."""
    if path not in _made:
        _made[path] = Transducer(path)
    return _made[path]


def public_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row: ``doc_id, ids, n_pieces, ids_crc32, round_trip`` (``ids_crc32`` of the ids as little-endian 32-bit
    integers; ``round_trip``: decoding the ids gives the text, with spaces for word marks)."""
    path = model or public_model()

    def rows(batches):
        for batch in slices(batches):
            t = transducer(path)
            texts = normalised(batch.column("text"))
            ids, bounds = t.encode(*flat(texts))
            cuts = bounds.tolist()
            raw = ids.astype("<i4").tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts[:-1], cuts[1:])]
            same = [a == (b or "") for a, b in zip(t.decode(ids, bounds), texts.to_pylist())]
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(np.diff(bounds)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_pieces", "ids_crc32", "round_trip"]
            )
        transducer(path).forget()

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(rows, "doc_id long, ids array<int>, n_pieces long, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; a null list is an empty text."""
    path = model or public_model()

    def rows(batches):
        for batch in batches:
            t = transducer(path)
            lists = batch.column("ids")
            ids = np.asarray(lists.flatten()).astype(np.int64)
            sizes = np.asarray([len(x) if x is not None else 0 for x in lists], np.int64) if lists.null_count else np.diff(lists.offsets.to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(t.decode(ids, np.concatenate(([0], np.cumsum(sizes)))))], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def digest(docs: DataFrame) -> DataFrame:
    """The registered query: ids and checks of every document."""
    return encode(docs)
