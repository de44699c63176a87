"""N-gram Jaccard self-join of documents, through count-vector R-trees.

A document is the set of its runs of ``SIZE`` words (words are runs of other than white
space, A-Z lower-cased; fewer words are one run).  Two documents link when
``100 * shared >= SIMILAR * joint`` runs.  The result names for every document the
smallest ``doc_id`` that links reach.

Documents with equal sets are one class.  Runs are hashed into ``DIMENSIONS`` groups, and
the numbers of runs per group are a class's point.  The sum of the coordinates'
minima bounds the runs two points can share, also for the corner of an R-tree node,
whose branch is left when the bound is short of what a link needs.

Every pair that links shares a run among the first ``size - needed + 1`` of either set in
a common order, rarest first, so R-trees are built per such run, and a run that is
common in the corpus leads to no group.  Members stand by size, and a group is cut where neighbours' sizes
are too far apart to link; a group of two goes too where their places of the run leave too few runs to share.  So
classes that meet by chance in a large corpus are left out before any text is moved.
Runs with equal members make one group.  Groups are first reduced: all members of fitting size are
compared with one pivot, twice, by bound and then by their texts, and joined into
components.  A group of two is settled by that.  Only groups that still hold several components are searched by R-tree, for
pairs across components; surviving pairs are verified by exact counts.  Groups of
more than ``PART`` members are cut into parts that all their searches visit.  So a
family of copies costs a multiple of its size, and no link between components is lost.

Documents without words are empty and link with nothing.  Rows with a null ``doc_id`` get
a null component and link with nothing; rows that repeat a ``doc_id`` are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import set_tools
from ledgermill.llm.storage import stored
from ledgermill.llm.text import column, distinct, extend, mix, shingles, signed, slices, words
from ledgermill.session import limit_batches

SIZE = 5
SIMILAR = 80  # per cent
DIMENSIONS = 256
LEAF = 16
FANOUT = 16
SMALL = 32  # members up to which a group is compared pair by pair
PART = 20_000
PIVOTS = 2  # rounds of
PER_ROUND = 8  # pivots among groups with common members
RANKS = 16  # candidates of a search that are verified first
FLUSH = 1 << 22
SIZE_BIT, PLACE_BIT = 54, 51  # of the first signature: above them the size, and in entries the place of the run
PLACES = 8


def _coded(size: np.ndarray) -> np.ndarray:
    """Sizes from 1 to 2**32, rounded down to one of 32 steps between powers of two, as the upper bits of a signature."""
    half, power = np.frexp(size)
    return (power.astype(np.uint64) - np.uint64(1) << np.uint64(5) | (half * 64 - 32).astype(np.uint64)) << np.uint64(SIZE_BIT)


def _size_range(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the sizes of sets with these signatures are at least, and below."""
    code = (low >> np.uint64(SIZE_BIT)).astype(np.int64)
    step = np.ldexp(1 / 32, code >> 5)
    return step * (32 + (code & 31)), step * (33 + (code & 31))


class _Sets:
    """The sets of a batch of texts: sorted runs, sizes, signatures and points."""

    def __init__(self, texts: pa.Array) -> None:
        value, text = shingles(words(column(texts)), SIZE)
        self.text, self.run = distinct(text, value)
        n = len(texts)
        self.size = np.bincount(self.text, minlength=n)
        self.first = np.cumsum(self.size) - self.size
        some = np.flatnonzero(self.size)
        self.low, self.high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        if len(some):
            sums = mix(np.add.reduceat(self.run, self.first[some]) + self.size[some].astype(np.uint64))
            self.low[some] = sums >> np.uint64(64 - PLACE_BIT) | _coded(self.size[some])
            self.high[some] = np.add.reduceat(mix(self.run), self.first[some])

    def points(self) -> np.ndarray:
        group = (mix(self.run) & np.uint64(DIMENSIONS - 1)).astype(np.int64)
        return np.bincount(self.text * DIMENSIONS + group, minlength=len(self.size) * DIMENSIONS).reshape(-1, DIMENSIONS).astype(np.int32)

    def runs(self, k: int) -> np.ndarray:
        return self.run[self.first[k] : self.first[k] + self.size[k]]


DIGEST = "doc long, text_id long, size long, low long, high long, element long, n long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: of every text the size and signatures of its set, and runs that several sets
    of the same stretch of a partition hold (``element``, else null) with their numbers."""
    names = [c.split()[0] for c in DIGEST.split(", ")]
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        run, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        none = pa.nulls(int((n > 1).sum()), pa.int64())
        return pa.record_batch([none, none, none, none, none, signed(run[n > 1]), pa.array(n[n > 1])], names)

    for batch in batches:
        for part in slices(batch):
            sets = _Sets(part.column(1))
            none = pa.nulls(part.num_rows, pa.int64())
            yield pa.record_batch([part.column(0), part.column(2), pa.array(sets.size), signed(sets.low), signed(sets.high), none, none], names)
            doc = part.column(0).is_valid().to_numpy(zero_copy_only=False)
            one = np.zeros(part.num_rows, bool)
            one[np.flatnonzero(doc)[np.unique(sets.low[doc], return_index=True)[1]]] = True
            held.append(sets.run[one[sets.text]])
            if sum(map(len, held)) > FLUSH:
                yield flush()
    if held:
        yield flush()


def _entries(table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = _Sets(part.column(1))
            _, one = np.unique(sets.low, return_index=True)
            order = set_tools.by_rarity(table, sets.text, sets.run)
            text = sets.text
            place = np.arange(len(text)) - sets.first[text]
            size = sets.size[text]
            last = size + (-size * SIMILAR // 100)
            keep = (place <= last) & np.isin(text, one)
            eighth = (PLACES * place[keep] // (last[keep] + 1)).astype(np.uint64) << np.uint64(PLACE_BIT)
            yield pa.record_batch([signed(sets.run[order][keep]), signed(sets.low[text[keep]] | eighth)], ["run", "low"])


def _shared_runs(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Of groups of several classes, the distinct members, under a hash of these members.

    Members are sorted by size, and a group ends where two neighbours' sizes cannot link.
    Two classes are left out if what follows their run in either set is too little for a link: they do not link,
    or a run before this one is their first in common.
    Groups of equal members, as all runs of a passage make them, are one group.
    """
    run, low = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
    eighth, low = low >> np.uint64(PLACE_BIT) & np.uint64(PLACES - 1), low & ~np.uint64(PLACES - 1 << PLACE_BIT)
    order = np.lexsort((low, run))
    run, low, eighth = run[order], low[order], eighth[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (low[1:] != low[:-1])
    run, low, eighth = run[new], low[new], eighth[new]
    least, below = _size_range(low)
    begin = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (100 * below[:-1] < SIMILAR * least[1:])))
    size = np.diff(np.append(begin, len(run)))
    follow = below * (1 - eighth * (100 - SIMILAR) / (100 * PLACES))  # the run included
    fits = size > 1
    a = begin[size == 2]
    fits[size == 2] = (100 + SIMILAR) * np.minimum(follow[a], follow[a + 1]) >= SIMILAR * (least[a] + least[a + 1])
    members = mix(np.add.reduceat(mix(low), begin) + size.astype(np.uint64))
    _, first = np.unique(members, return_index=True)
    keep = np.zeros(len(begin), bool)
    keep[first] = True
    # of groups with equal members one that fits says enough
    fits = np.isin(members, members[fits])
    keep = np.repeat(keep & fits, size)
    return pa.record_batch([signed(np.repeat(members, size)[keep]), signed(low[keep])], ["run", "low"])


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Runs that two sets of these sizes must share to link."""
    return -(-SIMILAR * (a + b) // (100 + SIMILAR))


class RTree:
    """Points packed into nodes with the largest coordinates and the range of sizes below them."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.arange(len(points))
        leaves: list[np.ndarray] = []

        def split(rows: np.ndarray) -> None:
            if len(rows) <= LEAF:
                leaves.append(rows)
                return
            # sizes tell most; then the coordinate that spreads most
            own = sizes[rows]
            key = own if own.max() * SIMILAR > own.min() * 100 else points[rows, np.argmax(np.ptp(points[rows], axis=0))]
            half = LEAF * max(1, len(rows) // (2 * LEAF))
            rows = rows[np.argsort(key, kind="stable")]
            split(rows[:half])
            split(rows[half:])

        split(self.order)
        self.order = np.concatenate(leaves)
        self.points, self.sizes = points[self.order], sizes[self.order]
        edges = np.cumsum([0, *map(len, leaves)])
        self.levels = []  # from the leaves upwards: first child, end, corner, least and largest size
        corner, low, high = self.points, self.sizes, self.sizes
        while True:
            corner = np.maximum.reduceat(corner, edges[:-1])
            low, high = np.minimum.reduceat(low, edges[:-1]), np.maximum.reduceat(high, edges[:-1])
            self.levels.append((edges[:-1], edges[1:], corner, low, high))
            if len(corner) == 1:
                break
            edges = np.append(np.arange(0, len(corner), FANOUT), len(corner))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows of the points whose bound suffices for a link with a set of this point and size."""
        nodes = np.zeros(1, np.int64)
        for begin, end, corner, low, high in reversed(self.levels):
            fits = (100 * high[nodes] >= SIMILAR * size) & (SIMILAR * low[nodes] <= 100 * size)
            nodes = nodes[fits]
            bound = np.minimum(corner[nodes], point).sum(axis=1)
            nodes = nodes[bound >= needed(np.maximum(low[nodes], -(-size * SIMILAR // 100)), size)]
            count = end[nodes] - begin[nodes]
            nodes = np.repeat(begin[nodes] - np.cumsum(count) + count, count) + np.arange(count.sum())
        bound = np.minimum(self.points[nodes], point).sum(axis=1)
        return self.order[nodes[bound >= needed(self.sizes[nodes], size)]]


def _across(most: int, low: int, high: int, batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Pairs of different components in each group whose bound suffices.

    Groups of up to ``most`` members give all of them.  In larger ones a search
    gives its candidates from rank ``low`` to ``high`` in order of the bound, which does not
    change while components grow, and says whether there are more.
    """
    group, entry, component, size, indexed, asks, point = batch.columns
    group, entry, component, size = (x.to_numpy() for x in (group, entry, component, size))
    indexed, asks = indexed.to_numpy(zero_copy_only=False), asks.to_numpy(zero_copy_only=False)
    point = _unpacked(point)
    order = np.lexsort((size, group))
    group, entry, component, size, indexed, asks, point = (x[order] for x in (group, entry, component, size, indexed, asks, point))
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    end = np.append(begin[1:], len(group))
    found = []
    small = np.repeat(end - begin <= most, end - begin)
    for step in range(1, most if low == 0 else 0):
        a = np.flatnonzero(small[step:]) + step
        b = a - step
        a, b = a[group[a] == group[b]], b[group[a] == group[b]]
        if not len(a):
            break
        use = (component[a] != component[b]) & ((asks[a] & indexed[b]) | (asks[b] & indexed[a])) & (100 * size[b] >= SIMILAR * size[a])
        a, b = a[use], b[use]
        for at in range(0, len(a), 4096):
            x, y = a[at : at + 4096], b[at : at + 4096]
            enough = np.minimum(point[x], point[y]).sum(axis=1) >= needed(size[x], size[y])
            found.append((x[enough], y[enough], np.zeros(int(enough.sum()), bool)))
    for first, last in zip(begin, end, strict=True):
        if last - first > most:
            rows = np.arange(first, last)
            held = rows[indexed[rows]]
            if not len(held):
                continue
            tree = RTree(point[held], size[held])
            for k in rows[asks[rows]]:
                other = held[tree.search(point[k], int(size[k]))]
                other = other[entry[other] != entry[k]]
                bound = np.minimum(point[other], point[k]).sum(axis=1)
                other = other[np.lexsort((entry[other], -bound / size[other]))]
                more = (component[other[high:]] != component[k]).any()
                other = other[low:high]
                other = other[component[other] != component[k]]
                if more and not len(other):
                    other = np.array([k])  # a pair of one class only carries the note
                found.append((np.full(len(other), k), other, np.full(len(other), more)))
    if not found:
        return None
    a, b, more = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.record_batch([pa.array(np.minimum(entry[a], entry[b])), pa.array(np.maximum(entry[a], entry[b])), pa.array(more)], ["a", "b", "more"])


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the sizes and points of their sets."""
    for batch in batches:
        for part in slices(batch):
            sets = _Sets(part.column(1))
            points = [p.astype("u1" if p.max() < 256 else "<i4").tobytes() for p in sets.points()]
            yield pa.record_batch([*part.columns, pa.array(sets.size), pa.array(points, pa.binary())], ["entry", "text", "size", "point"])


def _unpacked(points: pa.Array) -> np.ndarray:
    """Points from their bytes, one a number or, where a number is larger, four."""
    rows = [np.frombuffer(p, "u1" if len(p) == DIMENSIONS else "<i4") for p in points.to_pylist()]
    return np.array(rows, np.int32).reshape(-1, DIMENSIONS)


def _of_pairs(frame: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of a table, by its first column, that pairs (a, b) may ask for: the others are left out before any is moved."""
    ids = pairs.select("a").union(pairs.select("b")).toDF("id").select(F.xxhash64("id").alias("id"))
    wanted, names = frame.sparkSession.sparkContext.broadcast(set_tools.bloom(ids, "id")), frame.columns

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = set_tools.maybe(wanted.value, batch.column(0).to_numpy().view(np.uint64))
            yield batch.select(names).filter(pa.array(hit))

    return frame.select(F.xxhash64(names[0]).alias("__id"), "*").mapInArrow(asked, frame.schema)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: first by the bound of their points, then by their texts."""
    points = _of_pairs(texts.select("entry", "size", "point"), pairs)

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, other = (batch.column(k).to_numpy() for k in (2, 4))
            shared = np.minimum(_unpacked(batch.column(3)), _unpacked(batch.column(5))).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(shared >= needed(size, other)))

    bounded = pairs.join(points.toDF("a", "size", "point"), "a").join(points.toDF("b", "other_size", "other_point"), "b")
    bounded = bounded.select("a", "b", "size", "point", "other_size", "other_point").mapInArrow(enough, "a long, b long").distinct()
    bounded = stored(bounded, "bounded")
    texts = _of_pairs(texts.select("entry", "text"), bounded)
    both = bounded.join(texts.toDF("a", "text"), "a").join(texts.toDF("b", "other"), "b").select("a", "b", "text", "other")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x, y = _Sets(part.column(2)), _Sets(part.column(3))
                n = np.arange(part.num_rows)
                both = set_tools.shared_counts([x.runs(k) for k in n], [y.runs(k) for k in n])
                hit = 100 * both >= SIMILAR * (x.size + y.size - both)
                yield pa.record_batch(part.columns[:2], ["a", "b"]).filter(pa.array(hit))

    return both.mapInArrow(verify, "a long, b long")


def _named(frame: DataFrame, key: str, text: str, join_ids: bool) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows, and for each class (low, high) the smallest ``doc_id`` that its links reach.

    ``join_ids``: the classes of one ``doc_id`` link too.
    """
    spark = frame.sparkSession
    limit_batches(spark)
    picked = frame.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("text_id"))
    read = stored(picked.mapInArrow(_digests, DIGEST), "digests")
    digests = read.where("element IS NULL").drop("element", "n")
    named = digests.where("size > 0 AND doc IS NOT NULL")
    classes = named.groupBy("low", "high").agg(F.min("doc").alias("doc"), F.min_by("text_id", "doc").alias("text_id"), F.first("size").alias("size"))
    # numbered, since several classes may have the same smallest document
    classes = stored(classes.withColumn("entry", F.monotonically_increasing_id()), "classes")
    known = picked.where("doc IS NOT NULL AND text IS NOT NULL")
    counts = read.where("element IS NOT NULL").groupBy("element").agg(F.sum("n").alias("n"))
    table = spark.sparkContext.broadcast(set_tools.rarity_table(counts))
    entries = known.select("doc", "text").mapInArrow(lambda batches: _entries(table.value, batches), "run long, low long")
    shared = stored(set_tools.grouped(entries, "run", _shared_runs, "run long, low long").distinct(), "shared")
    members = stored(shared.join(classes, "low").select("run", "entry", "size", "doc", "text_id"), "members")

    # texts and points of the members, one per class
    wanted = members.select("entry", "doc", "text_id").distinct().withColumn("id", F.expr("doc ^ text_id"))
    filter_ = spark.sparkContext.broadcast(set_tools.bloom(wanted, "id"))

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy() ^ batch.column(2).to_numpy()
            yield batch.filter(pa.array(set_tools.maybe(filter_.value, ids.view(np.uint64))))

    # equal rows become one before the join, by its keys, so texts are moved once
    texts = known.mapInArrow(texts_of, "doc long, text string, text_id long").groupBy("doc", "text_id").agg(F.first("text").alias("text"))
    texts = texts.join(wanted.drop("id"), ["doc", "text_id"]).select("entry", "text")
    texts = stored(texts.mapInArrow(_points, "entry long, text string, size long, point binary"), "texts")

    links = spark.createDataFrame([], "a long, b long")
    if join_ids:
        owned = named.select("doc", "low", "high").distinct()
        several = owned.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc")
        owned = owned.join(several, "doc", "left_semi").join(classes.select("low", "high", "entry"), ["low", "high"])
        ends = owned.groupBy("doc").agg(F.min("entry").alias("a"))
        links = stored(owned.join(ends, "doc").select("a", F.col("entry").alias("b")).where("a <> b").distinct(), "links")
    labelled = members.select("run", "entry", "size", F.col("entry").alias("component"))

    def joined() -> tuple[DataFrame, DataFrame]:
        """Components of the links so far, and the groups that still hold several."""
        component = stored(set_tools.components(links), "components")
        own = members.select("run", "entry", "size").join(component, F.col("entry") == F.col("node"), "left")
        own = own.select("run", "entry", "size", F.coalesce("component", "entry").alias("component"))
        ends = own.groupBy("run").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
        # two members are settled by a pivot, or by the search
        mixed = ends.where("x <> y AND n > 2").select("run")
        return component, stored(own.join(mixed, "run", "left_semi"), "mixed")

    for turn in range(PIVOTS):
        kind = F.pmod(F.col("run"), F.lit(PER_ROUND))
        pivot = F.min_by(F.struct("entry", "component", "size"), F.xxhash64("entry", kind, F.lit(turn))).alias("pivot")
        pairs = labelled.join(labelled.groupBy("run").agg(pivot), "run").where("component <> pivot.component")
        pairs = pairs.where(100 * F.least("size", "pivot.size") >= SIMILAR * F.greatest("size", "pivot.size"))
        pairs = pairs.select(F.least("entry", "pivot.entry").alias("a"), F.greatest("entry", "pivot.entry").alias("b")).distinct()
        links = stored(links.union(_verified(stored(pairs, "pairs"), texts)), "links")
        component, labelled = joined()

    # what is left: search across components; who asks is settled once, all but the largest of each group
    sizes = labelled.groupBy("run", "component").agg(F.count("*").alias("n"))
    main = F.max_by("component", F.struct("n", "component")).alias("main")
    facts = sizes.groupBy("run").agg(main, F.ceil(F.sum("n") / PART).cast("int").alias("parts"), F.sum("n").alias("n"))
    cells = labelled.join(facts, "run").select("run", "entry", "parts", "n", (F.col("component") != F.col("main")).alias("asks"))
    cells = stored(cells, "cells")
    low, high, more = 0, RANKS, True
    while more:
        # smaller groups have given all their pairs in the first round
        rows = labelled.drop("size").join(cells.where(f"n > {0 if low == 0 else SMALL}"), ["run", "entry"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        rows = rows.select(
            F.xxhash64("run", "part").alias("cell"), "entry", "component",
            (F.expr("pmod(hash(entry), parts)") == F.col("part")).alias("indexed"), "asks",
        ).where("indexed OR asks")
        rows = rows.join(texts.select("entry", "size", "point"), "entry").select("cell", "entry", "component", "size", "indexed", "asks", "point")
        found = set_tools.grouped(rows, "cell", partial(_across, SMALL, low, high), "a long, b long, more boolean")
        found = stored(found.groupBy("a", "b").agg(F.max("more").alias("more")), "pairs")
        links = stored(links.union(_verified(found.where("a <> b").select("a", "b"), texts)), "links")
        component, labelled = joined()
        more = not found.where("more").isEmpty()
        low, high = high, high * 16

    reached = classes.select("low", "high", "doc", "entry").join(component, F.col("entry") == F.col("node"), "left")
    reached = reached.select("low", "high", "doc", F.coalesce("component", "entry").alias("component"))
    least = reached.groupBy("component").agg(F.min("doc").alias("name"))
    return digests, stored(reached.join(least, "component").select("low", "high", "name"), "names")


def linked(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row the key, ``n_shingles`` and ``component_id``."""
    digests, names = _named(frame, key, text, join_ids=True)
    rows = digests.select("doc", "size", "low", "high").join(names, ["low", "high"], "left")
    # an empty text is its document's own, unless other rows of that id link
    empty = digests.where("size = 0 AND doc IS NOT NULL").select("doc").distinct()
    other = digests.where("size > 0").join(empty, "doc", "left_semi").join(names, ["low", "high"])
    other = other.groupBy("doc").agg(F.min("name").alias("other"))
    rows = rows.join(other, "doc", "left")
    found = F.when(F.col("doc").isNotNull(), F.when(F.col("size") > 0, F.col("name")).otherwise(F.coalesce("other", "doc")))
    return rows.select(F.col("doc").alias(key), F.col("size").alias("n_shingles"), found.alias("component_id"))


def representatives(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stand for their group of linked texts: those of its smallest ``doc_id``, all columns as they are.

    Groups are of texts: rows with one ``doc_id`` and texts that do not link stand for themselves.
    Rows without words or with a null ``doc_id`` stay.
    """
    _, names = _named(frame, key, text, join_ids=False)

    def signed_row(part: pa.RecordBatch) -> list[pa.Array]:
        sets = _Sets(part.column(part.num_columns - 1))
        return [pa.array(sets.size), signed(sets.low), signed(sets.high)]

    rest = F.struct(*[F.col(f"`{c}`") for c in frame.columns if c != text]).alias("row")  # kept from names that are added
    rows = extend(frame.select(rest, text), text, "size long, low long, high long", signed_row)
    rows = rows.join(names, ["low", "high"], "left")
    own = F.col("row")[key]
    stay = rows.where(own.isNull() | (F.col("size") == 0) | (own.cast("long") == F.col("name")))
    return stay.select(*[F.col(f"`{text}`") if c == text else F.col("row")[c].alias(c) for c in frame.columns])
