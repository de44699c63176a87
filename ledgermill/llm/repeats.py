"""Removal of repeated byte strings, through Burrows-Wheeler transforms of text collections.

Each byte goes that is covered by a string of ``LENGTH`` bytes that also starts anywhere
else, in the same text or another; strings are judged on the input.

Texts are cut so that equal strings of ``LENGTH`` bytes meet: every such string has an
anchor, its leftmost gram of ``GRAM`` bytes with the least hash, and a run of
neighbouring strings with one anchor is a segment of at most
``2 * LENGTH - GRAM`` bytes.  Segments of anchors whose hash comes up once in all texts hold no
repeat and are left out before any text is moved.  The others are made distinct and weighted.
Where all occurrences of an anchor have the same segment, all of it repeats; the rest
form collections of about ``COLLECTION`` bytes, all segments of an anchor in one.

In each collection the transform and the common prefixes are built column by column: all
segments are read from the right, in every round each adds one symbol, whose place follows
from the ranks of the round before, and whose common prefixes with both neighbours are one
longer than the least between equal symbols.  Each round reads the two sequences of the
round before from front to back and writes new ones.  The number of
rounds is bounded by the length of a segment, and the sequences by the collection,
so they are held in memory rather than in files, which another executor could not see.
A symbol is ``SYMBOL`` bytes, counted from the anchor, so that equal strings are cut alike: neighbours
with a common prefix of as many symbols as every string holds are candidates, whose strings
are then compared byte for byte by hashes.  All of a segment of weight two repeats.

An anchor with more than ``CROWD`` distinct segments would make one collection too large.
Its strings are counted one by one by their hashes instead, with the same result.

Null and empty texts, and texts shorter than ``LENGTH``, lose nothing.  Texts are
compared by content, so repeated rows (also of one ``doc_id``) are repeats of each other.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import set_tools
from ledgermill.llm.storage import stored
from ledgermill.llm.text import _BYTE, Texts, column, mix, powers, signed, slices
from ledgermill.session import limit_batches

LENGTH = 400
GRAM = 64
COLLECTION = 1 << 20
CROWD = 2000
STRETCH = 1 << 20  # bytes of a long text that are cut at once
PLACE = 20  # bits of a position in a stretch
FLUSH = 1 << 20
SYMBOL = 8


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every string of ``size`` bytes."""
    n = len(data) - size + 1
    power, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return mix((total[size:] - total[:n]) * inverse[:n])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring values: of a block's end and the next block's begin."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    begin = np.minimum.accumulate(blocks, axis=1).ravel()
    end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(end[:n], begin[width - 1 : width - 1 + n])


@dataclass(frozen=True)
class Settings:
    """The module's parameters as one value, sent to the tasks."""

    length: int = LENGTH
    gram: int = GRAM
    collection: int = COLLECTION
    crowd: int = CROWD
    stretch: int = STRETCH


def cut(texts: Texts, use: Settings) -> tuple[np.ndarray, ...]:
    """Segments of all texts: anchor hash, text, first byte and end (in its text), place of the anchor in it."""
    out = []
    for k in np.flatnonzero(np.diff(texts.offsets) >= use.length):
        begin, end = int(texts.offsets[k]), int(texts.offsets[k + 1])
        for at in range(begin, end - use.length + 1, use.stretch - use.length):
            data = texts.data[at : min(end, at + use.stretch - 1)]
            grams = _hashes(data, use.gram)
            keys = grams >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(grams), dtype=np.uint64)
            least = _sliding_least(keys, use.length - use.gram + 1)
            first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
            last = np.append(first[1:], len(least)) - 1
            place = (least[first] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
            out.append((grams[place], np.full(len(first), k), at - begin + first, at - begin + last + use.length, place - first))
    if not out:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def transform(data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes of a collection, its texts one after the other, longest first.

    Symbols are numbers from 0; one more than the largest stands for a text's end.
    """
    m, last = len(length), int(data.max()) + 1
    kind = np.uint16 if last < 1 << 16 else np.int64
    data, end = data.astype(kind), np.cumsum(length)
    symbols, common = data[end - 1], np.zeros(m, np.uint16)
    place = np.arange(m)

    def least(begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least common prefix over [begin, stop) for ranges that are not empty."""
        size = stop - begin
        first = np.cumsum(size) - size
        return np.minimum.reduceat(common[np.arange(size.sum()) + np.repeat(begin - first, size)], first)

    for step in range(1, int(length[0]) + 1):
        k = int(np.searchsorted(-length, -step, "right"))  # texts with a suffix of this length
        here, n = place[:k], len(symbols)
        order = np.argsort(symbols, kind="stable")
        own = symbols[here].astype(np.int64)
        rank = np.searchsorted(symbols[order].astype(np.int64) * n + order, own * n + here)
        below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=last + 1))])
        new_place = m + rank
        before = np.zeros(k, np.uint16)
        has = rank > below[own]
        if has.any():
            before[has] = 1 + least(order[rank[has] - 1] + 1, here[has] + 1)
        after = rank + 1 < below[own + 1]
        grown = np.ones(n + k, bool)
        grown[new_place] = False
        new_symbols, new_common = np.empty(n + k, kind), np.empty(n + k, np.uint16)
        new_symbols[grown], new_common[grown] = symbols, common
        new_symbols[new_place] = np.where(length[:k] > step, data[np.maximum(end[:k] - step - 1, 0)], last)
        if after.any():
            new_common[new_place[after] + 1] = 1 + least(here[after] + 1, order[rank[after] + 1] + 1)
        new_common[new_place] = before
        symbols, common = new_symbols, new_common
        place[:k] = new_place
    return symbols, common


def repeated(data: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """For every symbol of a collection (longest text first) whether a string of ``size`` that starts there repeats."""
    symbols, common = transform(data, length)
    twice = common >= size
    twice[:-1] |= twice[1:]
    follow = np.empty(len(symbols), np.int64)
    follow[np.argsort(symbols, kind="stable")] = len(length) + np.arange(len(symbols))
    end, found, place = np.cumsum(length), np.zeros(len(data), bool), np.arange(len(length))
    for step in range(1, int(length[0]) + 1):
        k = int(np.searchsorted(-length, -step, "right"))
        place = follow[place[:k]]
        if step >= size:
            found[end[:k] - step] = twice[place]
    return found


def repeated_bytes(bodies: list[bytes], anchors: list[int], size: int) -> list[np.ndarray]:
    """For each segment which of its strings of ``size`` bytes repeat in the collection.

    A symbol is ``SYMBOL`` bytes, counted from the anchor, so equal strings are cut alike.
    A string that repeats holds a repeated run of whole symbols; the strings
    around such runs are compared by hashes of all their bytes.
    """
    shift = [a % SYMBOL for a in anchors]
    raw = [np.frombuffer(b, np.uint8) for b in bodies]
    whole = [r[s : s + (len(r) - s) // SYMBOL * SYMBOL].reshape(-1, SYMBOL) for r, s in zip(raw, shift, strict=True)]
    order = sorted(range(len(raw)), key=lambda i: -len(whole[i]))
    length = np.array([len(whole[i]) for i in order], np.int64)
    packed = np.ascontiguousarray(np.concatenate([whole[i] for i in order])).view(np.uint64).ravel()
    run = (size - SYMBOL + 1) // SYMBOL
    found = repeated(np.unique(packed, return_inverse=True)[1], length, run)
    first = np.cumsum(length) - length
    out = [np.zeros(max(0, len(r) - size + 1), bool) for r in raw]
    owner, start, hashes = [], [], []
    for i, a, n in zip(order, first, length, strict=True):
        strings = np.arange(len(out[i]))
        symbol = -(-(strings - shift[i]) // SYMBOL)  # the first whole symbol of each string
        inside = symbol < n
        may = np.zeros(len(strings), bool)
        may[inside] = found[a + symbol[inside]]
        strings = strings[may]
        if len(strings):
            owner.append(np.full(len(strings), i))
            start.append(strings)
            hashes.append(np.stack([_hashes(raw[i], size)[strings], _hashes(raw[i] ^ np.uint8(0xA5), size)[strings]]))
    if owner:
        owner, start, hashes = np.concatenate(owner), np.concatenate(start), np.concatenate(hashes, axis=1)
        by = np.lexsort(hashes)
        same = (hashes[:, by][:, 1:] == hashes[:, by][:, :-1]).all(axis=0)
        twice = np.zeros(len(by), bool)
        twice[by[1:]] |= same
        twice[by[:-1]] |= same
        for i, a in zip(owner[twice], start[twice], strict=True):
            out[i][a] = True
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _anchor_counts(use: Settings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        anchor, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.record_batch([signed(anchor), pa.array(n)], ["anchor", "n"])

    for batch in batches:
        for part in slices(batch):
            held.append(cut(column(part.column(0)), use)[0])
            if sum(map(len, held)) > FLUSH:
                yield flush()
    if held:
        yield flush()


def _keys(texts: Texts, rows: np.ndarray) -> dict[int, bytes]:
    return {int(k): hashlib.md5(texts.data[texts.offsets[k] : texts.offsets[k + 1]]).digest() for k in rows}


def _segments(use: Settings, filter_: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of anchors that may repeat, with two hashes of their bytes."""
    for batch in batches:
        for part in slices(batch):
            texts = column(part.column(0))
            found = cut(texts, use)
            may = set_tools.maybe(filter_, found[0])
            anchor, text, begin, end, place = (x[may] for x in found)
            keys = _keys(texts, np.unique(text))
            bodies = [hashlib.md5(texts.data[texts.offsets[k] + a : texts.offsets[k] + b]).digest() for k, a, b in zip(text, begin, end, strict=True)]
            yield pa.record_batch(
                [signed(anchor), pa.array(bodies, pa.binary()), pa.array([keys[int(k)] for k in text], pa.binary()), pa.array(begin), pa.array(end), pa.array(place)],
                ["anchor", "body", "text_key", "begin", "end", "place"],
            )


_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _collection(use: Settings, table: pa.Table) -> pa.Table:
    """Of each segment of a collection the runs of strings that repeat: first string's begin, last one's end."""
    found = repeated_bytes(table.column("bytes").to_pylist(), table.column("place").to_pylist(), use.length)
    weight = table.column("weight").to_numpy()
    runs = [[{"begin": x, "end": y + use.length} for x, y in _runs(own | (w > 1))] for own, w in zip(found, weight, strict=True)]
    return pa.table([table.column("anchor"), table.column("body"), pa.array(runs, _SPAN)], ["anchor", "body", "runs"])


def _strings(use: Settings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of crowded segments with two hashes of its bytes."""
    for batch in batches:
        for anchor, body, weight, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            raw = np.frombuffer(data, np.uint8)
            low = _hashes(raw, use.length)
            high = _hashes(raw ^ np.uint8(0xA5), use.length)
            n = len(low)
            columns = [pa.array(np.full(n, anchor)), pa.array([body] * n, pa.binary()), pa.array(np.full(n, weight)), signed(low), signed(high), pa.array(np.arange(n))]
            yield pa.record_batch(columns, ["anchor", "body", "weight", "low", "high", "begin"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    for batch in batches:
        kept, removed, number = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = text.encode() if isinstance(text, str) else text
            parts, at, gone, n, stop = [], 0, 0, 0, -1
            for begin, end in sorted((s["begin"], s["end"]) for s in spans):
                if begin > stop:
                    n += 1
                    parts.append(raw[at:begin])
                    at = begin
                if end > at:
                    gone += end - at
                    at = end
                stop = max(stop, end)
            parts.append(raw[at:])
            kept.append(b"".join(parts))
            removed.append(gone)
            number.append(n)
        yield pa.record_batch([batch.column(0), pa.array(kept, pa.binary()), pa.array(removed), pa.array(number)], ["text_key", "kept", "n_removed", "n_spans"])


def cleaned_texts(frame: DataFrame, text: str = "text", use: Settings = Settings()) -> DataFrame:
    """Of every distinct text that loses bytes: ``text_key`` (its MD5), ``kept`` (binary), ``n_removed`` and ``n_spans``."""
    spark = frame.sparkSession
    limit_batches(spark)
    texts = frame.select(F.col(text).cast("string").alias("text")).where(F.octet_length("text") >= use.length)
    counts = texts.mapInArrow(partial(_anchor_counts, use), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    counts = stored(counts, "anchors")
    may = spark.sparkContext.broadcast(set_tools.bloom(counts, "anchor"))
    columns = "anchor long, body binary, text_key binary, begin long, end long, place long"
    segments = texts.mapInArrow(lambda batches: _segments(use, may.value, batches), columns).join(counts.select("anchor"), "anchor", "left_semi")
    segments = segments.groupBy("anchor", "body", "text_key", "begin", "end", "place").agg(F.count("*").alias("n"))
    segments = stored(segments, "segments")
    place = F.min(F.struct("text_key", "begin", "end", "place")).alias("at")
    bodies = segments.groupBy("anchor", "body").agg(F.sum("n").alias("weight"), place)
    kinds = stored(bodies.groupBy("anchor").agg(F.count("*").alias("bodies")), "kinds")
    bodies = stored(bodies.select("anchor", "body", "weight", "at.*").join(kinds, "anchor"), "bodies")

    # bytes of one occurrence of each distinct segment
    known = spark.sparkContext.broadcast(set_tools.bloom(segments.select(F.xxhash64("text_key").alias("id")), "id"))

    def may_repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = set_tools.maybe(known.value, batch.column(2).to_numpy().view(np.uint64))
            yield batch.select(["text_key", "text"]).filter(pa.array(hit))

    keyed = texts.select(text_key("text").alias("text_key"), "text").withColumn("id", F.xxhash64("text_key"))
    sources = keyed.mapInArrow(may_repeat, "text_key binary, text string").join(segments.select("text_key").distinct(), "text_key", "left_semi")
    sources = stored(sources.groupBy("text_key").agg(F.first("text").alias("text")), "texts")
    bytes_of = F.substring(F.encode("text", "utf-8"), F.col("begin").cast("int") + 1, (F.col("end") - F.col("begin")).cast("int"))
    # one segment for all occurrences of its anchor: nothing to compare, all of it repeats
    lone = bodies.where("bodies = 1").select("anchor", "body", F.lit(0).cast("long").alias("begin"), (F.col("end") - F.col("begin")).alias("end"))
    several = bodies.where("bodies > 1").join(sources, "text_key").select("anchor", "body", "weight", "place", "bodies", bytes_of.alias("bytes"))
    several = stored(several, "several")
    crowded = several.where(f"bodies > {use.crowd}")
    rest = several.where(f"bodies <= {use.crowd}")
    total = rest.agg(F.sum(F.octet_length("bytes"))).head()[0] or 0
    cell = F.expr(f"pmod(xxhash64(anchor), {max(1, total // use.collection)})").alias("cell")
    runs = rest.select(cell, "anchor", "body", "weight", "place", "bytes").groupBy("cell").applyInArrow(
        lambda table: _collection(use, table), "anchor long, body binary, runs array<struct<begin:long, end:long>>"
    )
    runs = runs.select("anchor", "body", F.explode("runs").alias("run")).select("anchor", "body", "run.begin", "run.end")
    strings = crowded.select("anchor", "body", "weight", "bytes").mapInArrow(partial(_strings, use), "anchor long, body binary, weight long, low long, high long, begin long")
    twice = strings.groupBy("low", "high").agg(F.sum("weight").alias("n")).where("n > 1")
    single = strings.join(twice, ["low", "high"], "left_semi").select("anchor", "body", "begin", (F.col("begin") + use.length).alias("end"))
    runs = stored(runs.union(single).union(lone).withColumnsRenamed({"begin": "run_begin", "end": "run_end"}), "runs")

    spans = segments.select("anchor", "body", "text_key", "begin").join(runs, ["anchor", "body"])
    span = F.struct((F.col("begin") + F.col("run_begin")).alias("begin"), (F.col("begin") + F.col("run_end")).alias("end"))
    spans = spans.groupBy("text_key").agg(F.collect_list(span).alias("spans"))
    cleaned = sources.join(spans, "text_key").select("text_key", "text", "spans")
    return stored(cleaned.mapInArrow(_without, "text_key binary, kept binary, n_removed long, n_spans long"), "cleaned")


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def remove(frame: DataFrame, key: str = "doc_id", text: str = "text", use: Settings = Settings()) -> DataFrame:
    """For every row the key, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary)."""
    rows = frame.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), text_key(text).alias("text_key"))
    rows = rows.join(cleaned_texts(frame, text, use), "text_key", "left")
    none = F.lit(0).cast("long")
    return rows.select(
        F.col("key").alias(key), F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept", F.encode("text", "utf-8")).alias("kept"),
    )
