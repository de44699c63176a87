"""Byte-level BPE encoding and decoding in padded numpy matrices.

Pieces of a text (matches of the vocabulary's pattern) are made distinct, sorted
into buckets of similar length and laid out as rows of one padded matrix per
bucket.  In every round each row merges its leftmost pair of minimum rank; a
merged row closes its gap, a finished row leaves the matrix.  Ranks of pairs come
from an open-addressing hash table of (left id, right id).  A piece longer than
``LONGEST`` bytes would need as many rounds as it has bytes, so it is merged
with a heap, which gives the same ids.

Null and empty texts give no ids.  Repeated ids of documents and further columns
do not matter: every input row gives one output row, and only the named columns
are read.  Texts of any length are handled whole.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgermill.llm.text import column, mix, slices

NONE = np.int32(2**31 - 1)
LONGEST = 512
ROWS = 1 << 15
REMEMBERED = 1 << 18


class Vocabulary:
    """Tokens by rank, and the hash table of pairs that merge."""

    def __init__(self, ranks: bytes) -> None:
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte < 0).any():
            raise ValueError("a byte-level vocabulary has a token for each of the 256 bytes")
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        merges = [
            (self.ranks[token[:k]], self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        self._build(np.array(merges, np.int64).reshape(-1, 3))

    def _build(self, merges: np.ndarray) -> None:
        """Open addressing with linear steps, filled for all keys at once."""
        size = 1 << max(4, int(4 * len(merges)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        keys, values = merges[:, 0] << 32 | merges[:, 1], merges[:, 2].astype(np.int32)
        slot = (mix(keys.astype(np.uint64)) & self.mask).astype(np.int64)
        while len(keys):
            _, first = np.unique(slot, return_index=True)
            won = np.zeros(len(keys), bool)
            won[first] = self.keys[slot[first]] < 0
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            keys, values, slot = keys[~won], values[~won], slot[~won] + 1 & int(self.mask)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, ``NONE`` where it has none or an id is padding."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = (mix(keys.astype(np.uint64)) & self.mask).astype(np.int64)
        found = np.full(keys.shape, NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        while len(open_):
            here = self.keys[slot[open_]]
            hit = here == keys[open_]
            found[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
            slot[open_] = slot[open_] + 1 & int(self.mask)
        return found

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        left: list[int] = []
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = np.array([whole], np.int32)
            elif len(piece) > LONGEST:
                out[i] = self._long(piece)
            else:
                left.append(i)
        left.sort(key=lambda i: len(pieces[i]))
        sizes = np.array([len(pieces[i]) for i in left], np.int64)
        begin = 0
        while begin < len(left):
            width = 1 << max(2, int(sizes[begin] - 1).bit_length())
            end = min(int(np.searchsorted(sizes, width, "right")), begin + max(1, ROWS * 16 // width))
            rows = left[begin:end]
            for i, ids in zip(rows, self._matrix([pieces[i] for i in rows], width), strict=True):
                out[i] = ids
            begin = end
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        length = np.array([len(p) for p in pieces], np.int64)
        cells = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.full((len(pieces), width + 1), -1, np.int32)
        ids[:, :width][np.arange(width) < length[:, None]] = self.byte[cells]
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width)
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        row = np.arange(len(pieces))
        columns = np.arange(width + 1)
        while len(row):
            at = ranks.argmin(axis=1)  # the first of several minima: the leftmost pair
            lines = np.arange(len(row))
            best = ranks[lines, at]
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[row[k]] = ids[k, : length[k]].copy()
                go = ~done
                row, ids, ranks, length, at, best = row[go], ids[go], ranks[go], length[go], at[go], best[go]
                if not len(row):
                    break
                used = int(length.max())
                ids, ranks, columns = ids[:, : used + 1], ranks[:, :used], np.arange(used + 1)
                lines = np.arange(len(row))
            ids[lines, at] = best
            take = np.minimum(columns + (columns > at[:, None]), columns[-1])
            ids = np.take_along_axis(ids, take, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(take[:, :-1], ranks.shape[1] - 1), axis=1)
            length = length - 1
            ids[lines, length] = -1
            ranks[lines, length - 1] = NONE
            ranks[lines, at] = self.rank(ids[lines, at], ids[lines, at + 1])
            before = np.maximum(at - 1, 0)
            own = self.rank(ids[lines, before], ids[lines, before + 1])
            ranks[lines, before] = own
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        """The same merges, in order of (rank, position), from a heap over linked parts."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        tokens = [piece[k : k + 1] for k in range(n)]
        heap = [(r, k) for k in range(n - 1) if (r := self.ranks.get(tokens[k] + tokens[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            if not alive[k] or (j := after[k]) < 0 or self.ranks.get(tokens[k] + tokens[j]) != rank:
                continue
            tokens[k] += tokens[j]
            ids[k], alive[j], after[k] = rank, False, after[j]
            if after[k] >= 0:
                before[after[k]] = k
            for p in (before[k], k):
                if p >= 0 and after[p] >= 0 and (r := self.ranks.get(tokens[p] + tokens[after[p]])) is not None:
                    heapq.heappush(heap, (r, p))
        return np.array([i for i, live in zip(ids, alive, strict=True) if live], np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        length = self.length[ids]
        total = np.cumsum(length)
        shift = self.start[ids] - np.concatenate([[0], total[:-1]]) if len(ids) else length
        return self.bytes[np.arange(total[-1] if len(ids) else 0) + np.repeat(shift, length)]


@lru_cache(maxsize=2)
def vocabulary(ranks: bytes) -> Vocabulary:
    return Vocabulary(ranks)


class _Numbers(dict):
    """Numbers pieces in the order in which they first come."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class _Encoder:
    """Encodes texts; distinct pieces are merged once while they are remembered."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.words, self.pattern = vocabulary(ranks), regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.length = np.empty(0, np.int32), np.empty(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        known = len(self.numbers)
        numbers = [np.fromiter(map(self.numbers.__getitem__, self.pattern.findall(t)), np.int64) for t in texts]
        new = self.words.encode([p.encode() for p in list(self.numbers)[known:]])
        self.ids = np.concatenate([self.ids, *new])
        self.length = np.concatenate([self.length, np.array([len(x) for x in new], np.int64)])
        start = np.cumsum(self.length) - self.length
        pieces = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        length = self.length[pieces]
        total = np.cumsum(length)
        ids = self.ids[np.arange(total[-1] if len(total) else 0) + np.repeat(start[pieces] - total + length, length)]
        ends = np.concatenate([[0], total])[np.cumsum([len(x) for x in numbers], dtype=np.int64)]
        return ids, np.diff(ends, prepend=0)


def _binary(data: np.ndarray, length: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())


def encode(frame: DataFrame, ranks: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every text: the key and ``ids``, little-endian unsigned 32-bit integers one after the other.

    ``ranks`` is the content of a rank file (base64 token, rank per line) and is
    sent to the executors; ``pattern`` cuts texts into pieces.
    """
    shared = frame.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared.value, pattern)
        for batch in batches:
            for part in slices(batch, "text", 1 << 22):
                ids, count = encoder([t or "" for t in part.column(1).to_pylist()])
                yield pa.record_batch([part.column(0), _binary(ids.astype("<u4").view(np.uint8), 4 * count)], ["key", "ids"])

    picked = frame.selectExpr(f"`{key}` AS key", f"CAST(`{text}` AS STRING) AS text")
    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: bytes, key: str = "doc_id") -> DataFrame:
    """The bytes that the ids of :func:`encode` stand for: its columns and ``decoded`` (binary)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        for batch in batches:
            for part in slices(batch, "ids", 1 << 22):
                texts = column(part.column(1))
                ids = np.frombuffer(texts.data.tobytes(), "<u4")
                ends = np.concatenate([[0], np.cumsum(words.length[ids])])[texts.offsets // 4]
                yield pa.record_batch([*part.columns, _binary(words.decode(ids), np.diff(ends))], ["key", "ids", "decoded"])

    picked = encoded.selectExpr(f"`{key}` AS key", "ids")
    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(run, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def read_ranks(path: str) -> bytes:
    return Path(path).read_bytes()
