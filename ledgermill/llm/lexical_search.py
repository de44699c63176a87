"""Ranked lexical search: every document scored against every item by one scan for all their terms.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII, with only
A-Z lower-cased.  In UTF-8 that is a rule on bytes: texts are translated byte by byte, every
other byte to one guard, and the item terms are sought with a guard on either side by an
Aho-Corasick automaton.  It reads each text once, whatever the number of items; no index
of the documents is built.  What the automaton gives out are numbers of terms, which
postings map to the items that hold them.

Two scans: the first counts, per task, the documents that hold each term, the documents with
terms and all their terms; the second scores.  Each task keeps the best of every item,
and only these are shuffled, so what is sent grows with items and tasks, not with documents.
Item terms are sent to the executors in blocks of whole items with up to ``BLOCK``
postings on average; each block is a pair of scans of its own.

Null and empty texts have no terms and no score.  Rows that repeat a document id are
documents of their own; rows that repeat an item id are one item.  Equal scores go by
ascending document id, nulls last.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.storage import stored
from ledgermill.llm.text import column, slices

#: Pairs (item, term) that are held by executors at once: about 40 MB.
BLOCK = 1 << 20
#: Pairs (document, item) that are scored at once.
CELLS = 1 << 21
SPREAD = 64  # groups in which the best of an item are picked before they meet

_KEPT = np.zeros(256, bool)
_KEPT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_GUARDED = np.where(_KEPT, np.arange(256), 0).astype(np.uint8)
_GUARDED[0x41:0x5B] += 32


@dataclass
class Block:
    """Terms of some items, and by term the items that hold it (``first`` delimits them)."""

    terms: list[str]  # bytes of UTF-8 as characters
    first: np.ndarray
    item: np.ndarray
    repeats: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(self.terms):
            found.add_word(f"\0{term}\0", k)
        found.make_automaton()
        return found


@dataclass
class Counted:
    """Of some texts: the number of terms, and sorted (text, term, times) of the sought ones."""

    n: np.ndarray
    text: np.ndarray
    term: np.ndarray
    times: np.ndarray


def _scan(texts: pa.Array, automaton: ahocorasick.Automaton, width: int) -> Counted:
    whole = column(texts)
    guarded = np.insert(_GUARDED[whole.data], whole.offsets, 0)  # a guard before each text and after the last
    edges = whole.offsets + np.arange(len(whole.offsets))
    begins = np.zeros(len(guarded) + 1, np.int64)
    np.cumsum((guarded[1:] != 0) & (guarded[:-1] == 0), out=begins[2:])
    n = begins[edges[1:] + 1] - begins[edges[:-1] + 1]
    if not width:
        none = np.empty(0, np.int64)
        return Counted(n, none, none, none)
    hits = np.fromiter(chain.from_iterable(automaton.iter(guarded.tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
    text = np.searchsorted(edges, hits[:, 0], "left") - 1
    pair, times = np.unique(text * width + hits[:, 1], return_counts=True)
    return Counted(n, pair // width, pair % width, times)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of items, with repeats."""
    for batch in batches:
        for k in range(batch.num_rows):
            text = _GUARDED[np.frombuffer((batch.column(1)[k].as_py() or "").encode(), np.uint8)].tobytes()
            found = [x for x in text.split(b"\0") if x]
            yield pa.record_batch([pa.repeat(batch.column(0)[k], len(found)), pa.array(found, pa.binary())], ["item", "term"])


def _counts(block: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents that hold each term; under term -1 documents with terms, under -2 all their terms."""
    automaton, width = block.value.automaton(), len(block.value.terms)
    holders, documents, total = np.zeros(width, np.int64), 0, 0
    for batch in batches:
        for part in slices(batch):
            found = _scan(part.column(0), automaton, width)
            holders += np.bincount(found.term, minlength=width)
            documents += int((found.n > 0).sum())
            total += int(found.n.sum())
    some = np.flatnonzero(holders)
    yield pa.record_batch([pa.array(np.append(some, [-1, -2])), pa.array(np.append(holders[some], [documents, total]))], ["term", "n"])


def _best(item: np.ndarray, score: np.ndarray, doc: pa.Array, k: int) -> np.ndarray:
    """Rows of the ``k`` best of each item."""
    known = doc.is_valid().to_numpy(zero_copy_only=False)
    order = np.lexsort((doc.fill_null(0).to_numpy(), ~known, -score, item))
    own = item[order]
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.empty(0, np.int64)
    place = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
    return order[place < k]


def _scores(block: Broadcast, weight: np.ndarray, documents: int, total: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's best documents of each item."""
    own = block.value
    automaton, width = own.automaton(), len(own.terms)
    items = int(own.item.max()) + 1
    fan = np.diff(own.first)
    least = np.zeros(items, np.int64)  # a score below it is not among the best
    kept: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, pa.Array]:
        item, score = (np.concatenate([x[c] for x in kept]) for c in (0, 1))
        doc = pa.concat_arrays([x[2] for x in kept])
        best = _best(item, score, doc, k)
        kept[:] = [(item[best], score[best], doc.take(pa.array(best)))]
        return kept[0]

    for batch in batches:
        for part in slices(batch):
            found = _scan(part.column(0), automaton, width)
            m = 75 + 25 * found.n * documents // max(total, 1)
            value = weight[found.term] * (1_000_000_000 * found.times // (1000 * found.times + 12 * m[found.text]))
            cost = np.concatenate([[0], np.cumsum(fan[found.term])])
            step = max(1, CELLS // items)
            for low in range(0, part.num_rows, step):
                at, end = np.searchsorted(found.text, [low, low + step])
                scores = np.zeros(step * items, np.int64)
                while at < end:  # postings of the terms found, in pieces
                    to = max(at + 1, int(np.searchsorted(cost, cost[at] + CELLS, "right")) - 1)
                    to = min(to, int(end))
                    n = fan[found.term[at:to]]
                    posting = np.repeat(own.first[found.term[at:to]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    cell = np.repeat(found.text[at:to] - low, n) * items + own.item[posting]
                    np.add.at(scores, cell, np.repeat(value[at:to], n) * own.repeats[posting])
                    at = to
                cell = np.flatnonzero(scores)
                item, score = cell % items, scores[cell]
                good = score >= least[item]
                text = cell[good] // items + low
                kept.append((item[good], score[good], part.column(1).take(pa.array(text))))
                if sum(len(x[0]) for x in kept) > 4 * k * items + CELLS:
                    item, score, _ = merged()
                    full = np.bincount(item, minlength=items) >= k
                    worst = np.full(items, np.iinfo(np.int64).max)
                    np.minimum.at(worst, item, score)
                    least = np.where(full, worst, 0)
    if kept:
        item, score, doc = merged()
        yield pa.record_batch([pa.array(item), doc, pa.array(score)], ["item", "doc", "score"])


def _block(rows: pa.Table, number: dict) -> Block:
    """``rows``: (item, term, repeats) sorted by term."""
    terms = rows["term"].combine_chunks()
    coded = terms.dictionary_encode()
    index = coded.indices.to_numpy()
    names = coded.dictionary.to_pylist()
    first = np.searchsorted(index, np.arange(len(names) + 1))
    item = np.array([number[x] for x in rows["item"].to_pylist()], np.int64)
    return Block([x.decode("latin-1") for x in names], first, item, rows["repeats"].to_numpy())


def rank(documents: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: item, rank, document, score."""
    spark = documents.sparkSession
    docs = documents.select(F.col(text).cast("string").alias("text"), F.col(key).cast("long").alias("doc"))
    terms = items.select(F.col(item_key).alias("item"), F.col(text).cast("string").alias("text"))
    kind = terms.schema["item"].dataType.simpleString()
    terms = terms.mapInArrow(_terms, f"item {kind}, term binary")
    terms = stored(terms.groupBy("item", "term").agg(F.count("*").alias("repeats")), "terms")
    blocks = -(-terms.count() // BLOCK)
    best = spark.createDataFrame([], f"item {kind}, doc long, score long")
    for number in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number) if blocks > 1 else terms
        rows = part.toArrow().sort_by("term")  # about BLOCK postings, whatever the tables
        if not rows.num_rows:
            continue
        names = pa.compute.unique(rows["item"]).to_pylist()
        block = _block(rows, {x: k for k, x in enumerate(names)})
        sent = spark.sparkContext.broadcast(block)
        counts = docs.select("text").mapInArrow(lambda b, sent=sent: _counts(sent, b), "term long, n long")
        counted = counts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        n = np.zeros(len(block.terms) + 2, np.int64)
        n[counted["term"].to_numpy()] = counted["n"].to_numpy()  # -1 and -2 are the last two
        many, total = int(n[-1]), int(n[-2])
        weight = np.floor(1000 * np.log((2 * many + 2) / (2 * n[:-2] + 1))).astype(np.int64)
        run = lambda b, sent=sent, weight=weight, many=many, total=total: _scores(sent, weight, many, total, k, b)
        found = docs.mapInArrow(run, "item long, doc long, score long")
        named = spark.createDataFrame(list(enumerate(names)), f"number long, name {kind}")
        found = found.join(F.broadcast(named), F.col("item") == F.col("number")).select(F.col("name").alias("item"), "doc", "score")
        best = best.unionByName(found)

    order = [F.desc("score"), F.asc_nulls_last("doc")]
    some = Window.partitionBy("item", F.pmod(F.xxhash64("doc"), F.lit(SPREAD))).orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    return best.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
