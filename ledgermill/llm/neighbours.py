"""Approximate nearest neighbours by cosine: a forest of sorted hash strings.

Each of ``TREES`` trees keeps the vectors sorted by a hash string of ``DEPTH``
symbols.  A symbol is the nearest of ``2 * WIDTH`` signed axes after a random
projection to ``WIDTH`` dimensions (cross-polytope hashing).  A query descends with
its own string and with the ``PROBES`` strings next to it.  Prefixes of equal length
are compared over all trees at once: from the longest, the query ascends until the
trees together hold the wanted number of vectors, and takes all vectors of that level.
The wanted number is ``SHARE`` of all vectors, ``WANTED`` at least, so that recall does not
fall as the table grows.  With fewer under all one-symbol prefixes, as in tables of up to
about ``WANTED`` vectors, it takes every vector.

Spark holds a tree as groups of its first symbol, and cuts a group of more than
``GROUP`` vectors into parts, to each of which the group's queries are sent; within
a part the strings are a sorted array and a prefix is a range found by binary
search.  Equal vectors are one entry with the ids that can be among the ``k``
nearest, so a common vector costs no more than any other.

Vectors that are null, empty, zero, or hold null or non-finite components take no part.
Those of different numbers of components are forests of their own and never neighbours.  A row with a query's own id is
never its neighbour, and rows that repeat an id count once, by their best score.
Every valid query row gives its ``k`` nearest, or all candidates if fewer; repeated
query ids with equal vectors are one query, with different vectors one whose
scores are the best over its vectors.

Tables that grow with the vectors or the queries are joined by sorting (hint ``merge``). Prefix
counts take under a byte a row in their file and over a hundred in a broadcast, so by the file's
size they would be sent through the driver long after they are too large for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.storage import stored

TREES = 16
WIDTH = 32
DEPTH = 3
PROBES = 128
WANTED = 4000
SHARE = 0.15
SLICE = 256  # queries hashed at once: their probes take 8,192 numbers each
GROUP = 50_000
BITS = 6  # of a symbol: 2 * WIDTH values


@lru_cache(maxsize=8)
def _projections(dimension: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((TREES, DEPTH, dimension, WIDTH))


def strings(vectors: np.ndarray, probes: int = 1) -> np.ndarray:
    """Hash strings [trees, vectors, probes] as numbers; the first is the vector's own.

    Further ones replace symbols by those of the next nearest axes, in order of the
    distance lost.
    """
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = np.empty((TREES, len(unit), probes), np.int64)
    for t, tree in enumerate(_projections(unit.shape[1])):
        best = np.zeros((len(unit), 1))
        code = np.zeros((len(unit), 1), np.int64)
        for axes in tree:
            score = unit @ axes
            score = np.concatenate([score, -score], axis=1)
            lost = (score.max(axis=1, keepdims=True) - score) ** 2
            few = np.argsort(lost, axis=1, kind="stable")[:, :probes]
            cost = best[:, :, None] + np.take_along_axis(lost, few, 1)[:, None, :]
            codes = code[:, :, None] << BITS | few[:, None, :]
            cost, codes = cost.reshape(len(unit), -1), codes.reshape(len(unit), -1)
            order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            best, code = np.take_along_axis(cost, order, 1), np.take_along_axis(codes, order, 1)
        out[t] = code[:, :probes]
    return out


def _prefix(code: np.ndarray, length: int) -> np.ndarray:
    return code >> BITS * (DEPTH - length)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Vectors of each number of components, with their rows: those of different numbers never meet."""
    sizes = pc.list_value_length(batch.column(1)).to_numpy()
    for size in np.unique(sizes):
        rows = batch.filter(pa.array(sizes == size))
        yield int(size), rows, np.stack(rows.column(1).to_numpy(zero_copy_only=False)).astype(np.float64)


def _packed(vectors: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in vectors], pa.binary())


def valid(vector: str) -> Column:
    return F.expr(
        f"`{vector}` IS NOT NULL AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        f" AND exists(`{vector}`, x -> x <> 0)"
    )


def _cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """Row by row in a fixed order of additions, so that equal pairs score equal everywhere."""
    return (vectors * query).sum(axis=1) / (norms * norm)


def nearest(frame: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row of ``queries`` its ``k`` nearest rows of ``frame``: query_id, rank, the key and score."""
    keep = k + 1
    picked = frame.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    picked = picked.where(valid("vector") & F.col("id").isNotNull())
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    asked = asked.where(valid("vector") & F.col("id").isNotNull()).distinct()
    order = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first_ids = picked.distinct().withColumn("place", order).where(F.col("place") <= keep)
    entries = first_ids.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = stored(entries.select(F.col("ids")[0].alias("entry"), F.xxhash64("vector").alias("hash"), "vector", "ids"), "vectors")
    # a vector that is asked for need not be among the rows searched
    asked = stored(
        asked.select(F.col("id").alias("query_id"), "vector", F.xxhash64("vector").alias("hash")), "queries"
    )
    targets = asked.groupBy("vector").agg(F.min("query_id").alias("query"))
    targets = stored(targets, "targets")

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part, vectors in _by_size(batch):
                codes, packed = strings(vectors)[:, :, 0], _packed(vectors)
                for t in range(TREES):
                    tree = pa.array(np.full(len(vectors), size * TREES + t))
                    first = pa.array(_prefix(codes[t], 1).astype(np.int32))
                    yield pa.record_batch([tree, first, pa.array(codes[t]), part.column(0), packed], ["tree", "first", "code", "entry", "vector"])

    hashed = entries.select("entry", "vector").mapInArrow(hash_rows, "tree long, first int, code long, entry long, vector binary")

    def hash_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, part, vectors in (x for b in batches for k in range(0, b.num_rows, SLICE) for x in _by_size(b.slice(k, SLICE))):
            ids = part.column(0).to_numpy()
            only = part.column(2).to_numpy() if part.num_columns > 2 else None  # the level of each query, else all levels
            codes = strings(vectors, PROBES)
            for t in range(TREES):
                for level in range(1, DEPTH + 1):
                    at = np.arange(len(ids)) if only is None else np.flatnonzero(only == level)
                    prefix = _prefix(codes[t][at], level)
                    row = np.repeat(at, prefix.shape[1])
                    pairs = np.unique(np.stack([row, prefix.ravel()], axis=1), axis=0)
                    n = len(pairs)
                    yield pa.record_batch(
                        [pa.array(np.full(n, size * TREES + t)), pa.array(np.full(n, level, np.int32)), pa.array(pairs[:, 1]), pa.array(ids[pairs[:, 0]])],
                        ["tree", "level", "prefix", "query"],
                    )

    probed = "tree long, level int, prefix long, query long"
    probes = targets.select("query", "vector").mapInArrow(hash_queries, probed)
    levels = F.explode(F.sequence(F.lit(1), F.lit(DEPTH))).alias("level")
    prefix = F.expr(f"shiftright(code, {BITS} * ({DEPTH} - level))").alias("prefix")
    sizes = hashed.groupBy("tree", "code").agg(F.count("*").alias("n")).select("tree", "code", "n", levels)
    sizes = stored(sizes.select("tree", "level", prefix, "n").groupBy("tree", "level", "prefix").agg(F.sum("n").alias("n")), "sizes")
    reached = probes.join(sizes.hint("merge"), ["tree", "level", "prefix"]).groupBy("query", "level").agg(F.sum("n").alias("n"))
    sized = entries.groupBy(F.size("vector").alias("size")).agg(F.ceil(F.count("*") * SHARE).alias("share"))
    reached = reached.join(targets.select("query", F.size("vector").alias("size")).hint("merge"), "query").join(sized, "size")
    level = reached.where(F.col("n") >= F.greatest("share", F.lit(WANTED))).groupBy("query").agg(F.max("level").alias("level"))
    chosen = targets.select("query").join(level.hint("merge"), "query", "left").select("query", F.coalesce("level", F.lit(0)).alias("level"))
    chosen = stored(chosen, "levels")
    # at most TREES * 2 * WIDTH rows for each number of components
    parts = sizes.where("level = 1").select("tree", F.col("prefix").cast("int").alias("first"), F.ceil(F.col("n") / GROUP).cast("int").alias("parts"))
    own = targets.join(chosen.where("level > 0").hint("merge"), "query").select("query", "vector", "level").mapInArrow(hash_queries, probed)
    all_of = parts.where(f"tree % {TREES} = 0").select("tree", F.lit(1).alias("level"), F.col("first").cast("long").alias("prefix"))
    # every vector: all groups of one tree, for the queries that fall short (all of them in small tables)
    whole = chosen.where("level = 0").join(targets.select("query", (F.size("vector") * TREES).cast("long").alias("tree")).hint("merge"), "query")
    whole = whole.select("query", "tree", F.explode(F.sequence(F.lit(0), F.lit(2 * WIDTH - 1))).alias("prefix"))
    whole = whole.select("tree", F.lit(1).alias("level"), F.col("prefix").cast("long").alias("prefix"), "query")
    whole = whole.join(all_of, ["tree", "level", "prefix"], "left_semi")
    sent = own.union(whole.select("tree", "level", "prefix", "query"))
    first = F.expr(f"CAST(shiftright(prefix, {BITS} * (level - 1)) AS INT)").alias("first")
    low = F.expr(f"shiftleft(prefix, {BITS} * ({DEPTH} - level))").alias("low")
    high = F.expr(f"shiftleft(prefix + 1, {BITS} * ({DEPTH} - level))").alias("high")
    sent = sent.select("tree", first, low, high, "query").groupBy("tree", "first", "query").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges")
    )
    sent = sent.join(parts, ["tree", "first"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.join(targets.hint("merge"), "query").select("tree", "first", "part", "query", "ranges", "vector")
    rows = hashed.join(parts, ["tree", "first"]).withColumn("part", F.expr("pmod(hash(entry), parts)"))

    def search(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(vectors) and len(wanted):
            vectors = vectors.sort_values("code", kind="stable")
            codes, ids = vectors["code"].to_numpy(), vectors["entry"].to_numpy()
            matrix = np.frombuffer(b"".join(vectors["vector"]), np.float64).reshape(len(ids), -1)
            norms = np.sqrt((matrix * matrix).sum(axis=1))
            for query, ranges, vector in zip(wanted["query"], wanted["ranges"], wanted["vector"], strict=True):
                edges = sorted((r["low"], r["high"]) for r in ranges)
                at = np.searchsorted(codes, np.array(edges))
                rows = np.concatenate([np.arange(a, b) for a, b in at])
                if not len(rows):
                    continue
                own = np.asarray(vector, np.float64)
                score = _cosines(matrix[rows], norms[rows], own, float(np.sqrt((own * own).sum())))
                top = np.lexsort((ids[rows], -score))[:keep]
                out.append(pd.DataFrame({"query": query, "entry": ids[rows[top]], "score": score[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "entry": [], "score": []})

    by = ["tree", "first", "part"]
    found = rows.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(search, "query long, entry long, score double")
    # one row per pair, whatever the number of trees that found it
    pairs = found.groupBy("query", "entry").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    pairs = pairs.withColumn("place", best).where(F.col("place") <= keep)
    pairs = stored(pairs.join(entries.select("entry", "ids").hint("merge"), "entry").select("query", "score", F.explode("ids").alias("id")), "pairs")
    listed = pairs.groupBy("query").agg(F.collect_list(F.struct("score", "id")).alias("found"))
    ids = asked.join(targets.hint("merge"), "vector").select("query_id", "query").join(listed.hint("merge"), "query")
    flat = ids.select("query_id", F.explode("found").alias("f")).select("query_id", "f.score", "f.id").where("query_id <> id")
    flat = flat.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return flat.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
