"""Numpy views of Arrow text columns: bytes, words, shingles and their 64-bit hashes.

All helpers work on one slice of a record batch at a time, so their memory is
bounded by ``SLICE`` bytes of text or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
MASK = (1 << 64) - 1

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHIFT = [np.uint64(x) for x in (33, 29, 32)]
_MULT = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _SHIFT[0])
    x = x * _MULT[0]
    x = x ^ (x >> _SHIFT[1])
    x = x * _MULT[1]
    return x ^ (x >> _SHIFT[2])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE + 4096)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Texts:
    """Concatenated UTF-8 bytes of some texts; text ``i`` is ``data[offsets[i]:offsets[i+1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def column(array: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of a string or binary column; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
        if isinstance(array, pa.ChunkedArray):
            array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.large_string())
    binary = pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type)
    array = array.cast(pa.large_binary() if binary else pa.large_string())
    if array.null_count:
        array = pc.fill_null(array, b"" if binary else "")
    if not len(array):
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batch: pa.RecordBatch, name: str = "text", size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of text each."""
    at = column(batch.column(batch.schema.get_field_index(name))).offsets
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


@dataclass
class Words:
    """Words of some texts: byte ranges, the text each belongs to, and a hash of its bytes."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, the index of its first word; one more entry at the end


#: By number of bytes (0 to 8), the mask of the bytes that belong to a word.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(_BASE)
#: Words of more bytes are hashed by running sums, so that no word costs a round for every eight of its bytes.
LONG = 32


def _inside(data: np.ndarray, separator: np.ndarray) -> np.ndarray:
    if separator is _SPACE:
        return (data != 32) & (data - np.uint8(9) > 4)
    return ~separator[data]


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every byte range: eight bytes at a time, or by running sums where it is long."""
    size = end - start
    value = size.astype(np.uint64) * _STEP
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    long = np.flatnonzero(size > LONG)
    here = np.flatnonzero(size <= LONG) if len(long) else np.arange(len(size))
    for k in range(0, LONG, 8):
        if k:
            here = here[size[here] > k]
            if not len(here):
                break
        value[here] = mix(value[here] ^ (eight[start[here] + k] & _MASKS[np.minimum(size[here] - k, 8)]))
    if len(long):
        first = np.cumsum(size[long]) - size[long]
        own = data[np.repeat(start[long] - first, size[long]) + np.arange(size[long].sum())]
        power, inverse = powers(len(own) + 1)
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(_BYTE[own] * power[: len(own)], out=total[1:])
        value[long] = mix((total[first + size[long]] - total[first]) * inverse[first] + value[long])
    return value


def words(texts: Texts, separator: np.ndarray = _SPACE, lower: bool = True) -> Words:
    """Maximal runs of bytes that are no separator, A-Z lower-cased before hashing."""
    n = len(texts.data)
    if not n:
        none = np.empty(0, np.int64)
        return Words(none, none, none, np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    inside = _inside(texts.data, separator)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    ends = inside
    last = ends[edges[1:] - 1], ends[-1]
    ends[:-1] &= ~ends[1:]
    ends[edges[1:] - 1], ends[-1] = last
    end = np.flatnonzero(ends) + 1
    data = texts.data
    if lower:
        data = data + ((data - np.uint8(65) < 26) * np.uint8(32))
    first = np.searchsorted(start, texts.offsets)
    return Words(start, end, np.repeat(np.arange(len(texts)), np.diff(first)), _word_hashes(data, start, end), first)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of ``size`` words; a shorter text gives its whole run of words."""
    count = np.diff(found.first)
    value, text = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(found.hash) >= size:
        window = np.lib.stride_tricks.sliding_window_view(found.hash, size)
        multipliers = powers(size + 1)[0][1:]
        whole = found.text[size - 1 :] == found.text[: len(found.text) - size + 1]
        value = mix((window[whole] * multipliers).sum(axis=1, dtype=np.uint64))
        text = found.text[: len(whole)][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        multipliers = powers(size + 1)[0][1:]
        own = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            own[has] += found.hash[found.first[short[has]] + k] * multipliers[k]
        value = np.concatenate([value, mix(own + count[short].astype(np.uint64))])
        text = np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        value, text = value[order], text[order]
    return value, text


def sorted_by(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by text, then value, for texts numbered from 0.

    Sorts one packed key, which is faster than two; values that the key cannot tell
    apart, which hardly ever meet in one text, are sorted in full.
    """
    if not len(text):
        return np.empty(0, np.int64)
    bits = np.uint64(int(text.max() if len(text) else 0).bit_length())
    key = text.astype(np.uint64) << (np.uint64(64) - bits) | value >> bits if bits else value
    order = np.argsort(key)
    key, value = key[order], value[order]
    if ((key[1:] == key[:-1]) & (value[1:] < value[:-1])).any():
        order = order[np.lexsort((value, key))]
    return order


def distinct(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs, sorted."""
    order = sorted_by(text, value)
    text, value = text[order], value[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[keep], value[keep]


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark's long."""
    return pa.array(values.view(np.int64))


def extend(frame, text: str, fields: str, run):
    """Add columns computed from a text column; all other columns pass through as they are.

    ``run`` turns a record batch whose last column ``text`` holds the text into
    the arrays of the new columns ``fields`` (a schema string).  A column of the
    input that has the name of a new one is replaced.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    new = _parse_datatype_string(fields)
    names = [name for name in frame.columns if name not in new.names]
    wide = frame.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text}`").cast("string")).toDF(
        *[f"c{i}" for i in range(len(names))], "text"
    )
    schema = StructType([*wide.schema.fields[:-1], *[StructField(f"n{i}", f.dataType) for i, f in enumerate(new.fields)]])

    def each(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.record_batch([*part.columns[:-1], *run(part)], schema.names)

    return wide.mapInArrow(each, schema).toDF(*names, *new.names)
