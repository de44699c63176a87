"""Parts that the set-similarity operators share: rarity order, Bloom filters, group streams, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.storage import stored
from ledgermill.llm.text import sorted_by

#: Slots of a rarity table and bits of a Bloom filter: the sizes of what is sent to
#: executors (4 MB each), whatever the corpus.  Results do not depend on them.
RARITY_SLOTS = 1 << 22
BLOOM_BITS = 1 << 25
#: Edges of a graph that one task settles; a larger one is never brought together.
EDGES = 1 << 19


def rarity_table(counts: DataFrame) -> np.ndarray:
    """By slot of an element's hash, 1 + log2 of the largest count of an element there; 0 if none has 2.

    ``counts`` has ``element`` (hash, long) and ``n``.  Any fixed order of elements
    makes prefix filtering exact; this one puts frequent elements last.
    """
    slot = F.expr(f"CAST(element & {RARITY_SLOTS - 1}L AS INT)").alias("slot")
    return slot_levels(counts.where("n >= 2").select(slot, "n").groupBy("slot").agg(F.max("n").alias("n")))


def slot_levels(counts: DataFrame) -> np.ndarray:
    """1 + log2 of ``n`` by ``slot``; 0 where it is below 2."""
    level = F.expr("CAST(1 + floor(log2(n)) AS TINYINT)").alias("level")
    rows = counts.where("n >= 2").select("slot", level).toArrow()
    table = np.zeros(RARITY_SLOTS, np.uint8)
    table[rows["slot"].to_numpy()] = rows["level"].to_numpy()
    return table


def by_rarity(table: np.ndarray, owner: np.ndarray, element: np.ndarray) -> np.ndarray:
    """Order that sorts elements by owner, then rarest first, then hash."""
    level = table[element & np.uint64(RARITY_SLOTS - 1)].astype(np.uint64)
    return sorted_by(owner, level << np.uint64(58) | element >> np.uint64(6)) if (level < 64).all() else np.lexsort((element, level, owner))


def bloom(ids: DataFrame, column: str) -> np.ndarray:
    """Bit array with the bits of all ids of a long column set."""
    slot = f"{column} & {BLOOM_BITS - 1}L"
    words = ids.select(F.expr(f"CAST(shiftright({slot}, 6) AS INT)").alias("word"), F.expr(f"shiftleft(1L, CAST({slot} & 63 AS INT))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS >> 6, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def maybe(filter_: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which unsigned ids the filter may hold."""
    slot = ids & np.uint64(BLOOM_BITS - 1)
    return (filter_[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def group_stream(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first column, re-cut so that no group of equal values is split."""
    held: list[pa.RecordBatch] = []
    rows, wanted = 0, least
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        whole = pa.concat_batches(held)
        key = whole.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        held, rows, wanted = [whole.slice(cut)], len(key) - cut, max(least, 2 * (len(key) - cut))
        if cut:
            yield whole.slice(0, cut)
    if rows:
        yield pa.concat_batches(held)


def grouped(frame: DataFrame, key: str, run: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``run`` to batches of whole groups of a long key."""
    rest = [c for c in frame.columns if c != key]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in group_stream(batches):
            if (out := run(batch)) is not None:
                yield out

    return frame.select(key, *rest).repartition(key).sortWithinPartitions(key).mapInArrow(each, schema)


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted distinct arrays, pair by pair."""
    return np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)


def unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ends of edges and the least end that each reaches over these edges."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, root = index[: len(a)], index[len(a) :], np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        live = low != high
        if not live.any():
            return nodes, nodes[root]
        a, b = a[live], b[live]
        np.minimum.at(root, high[live], low[live])
        while ((up := root[root]) != root).any():
            root = up


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of a partition as stars: every node, the least one included, with the least it reaches."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        whole = pa.concat_batches(held)
        held.clear()
        node, root = roots(whole.column(0).to_numpy(), whole.column(1).to_numpy())
        return pa.record_batch([pa.array(node), pa.array(root)], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) > EDGES:
            yield flush()
    if held:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): each node with the smallest node it reaches.

    Each partition's edges are first replaced by its stars, which connect the same nodes.  Up to
    ``EDGES`` edges are then settled by one task, which holds no more than that at any size of the input.  More of them
    alternate two star operations, which hang every node's larger, then smaller
    neighbours on the smallest one; the number of rounds grows with the logarithm of
    the longest path.  Each round is a join on stored edges.
    """

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).head())

    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.mapInArrow(_forests, "a long, b long").where("a <> b"), "edges")
    if edges.count() <= EDGES:
        return edges.repartition(1).mapInArrow(_forests, "a long, b long").toDF("node", "component")
    edges = stored(edges.distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "low").where("x <> low").toDF("a", "b").union(low.toDF("a", "b"))
        edges = stored(small.distinct(), "edges")
    roots = edges.select(F.col("b").alias("a")).distinct().select("a", F.col("a").alias("b"))
    return edges.union(roots).groupBy("a").agg(F.min("b").alias("b")).toDF("node", "component")
