"""Line deduplication: an exact set-similarity self-join over lines.

A line is the set of its words (runs of other than white space, A-Z lower-cased);
lines match when ``100 * shared >= SIMILAR * joint`` words.  A line goes when it matches
a line that comes earlier in order of (doc_id, line number); lines are judged on
the input, so a line that goes still takes later ones with it.

Lines with equal sets are one class, found by grouping; only its first line
stays.  Between classes, words are ordered by rarity and each line is indexed under
the words of its prefix, long enough that two matching lines share one.
Lines met under a word pass the length filter, the positional filter and a
filter on 128-bit parities (each word flips one bit, so sets differ in at least as many
words as their parities in bits), and are verified by their words.  A line is first
compared with ``LIMITS[0]`` earlier lines that pass; only where none of them matches and
more would pass, with more of them, in the end with all, so that a family of near copies
costs no more than its size and still no match is lost.

Lines without a word match nothing and stay.  Null texts have no lines.  Rows with a
null ``doc_id`` are left alone; rows that repeat a ``doc_id`` are one document, whose
lines of equal number are no matches of each other.
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
from ledgermill.llm.text import Texts, column, distinct, mix, signed, slices, words
from ledgermill.session import limit_batches

SIMILAR = 80  # per cent
#: Candidates of a line that are verified before the next round, which is for lines without a match
#: among them only; the last round takes all.
LIMITS = (16, 128, None)
STEPS = 64
BLOCK = 1 << 12  # slots of a row of counts
MOST = (1 << 16) - 1  # that a task counts in a slot; beyond, the order of words is a little different


def _ids(doc: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hashes of lines by document and number."""
    return mix(mix(doc.view(np.uint64)) + number.astype(np.int64).view(np.uint64))


class _Lines:
    """Lines with a word as sorted sets of word hashes: document, number in it, and words."""

    def __init__(self, doc: np.ndarray, number: np.ndarray, size: np.ndarray, word: np.ndarray) -> None:
        self.doc, self.number, self.size, self.word = doc, number, size, word
        self.first = np.cumsum(size) - size
        self.line = np.repeat(np.arange(len(size)), size)
        self.low = mix(self._sums(word) + size.astype(np.uint64))

    @classmethod
    def read(cls, batch: pa.RecordBatch, only: np.ndarray | None = None, ids: np.ndarray | None = None) -> _Lines:
        """The lines of a batch of texts, or those with a word or those with an id that a filter may hold.

        Lines left out by their ids are not looked at.
        """
        texts = column(batch.column(1))
        breaks = np.flatnonzero(texts.data == 10)
        # a line begins at each text and after each line feed
        begins = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]))
        owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(breaks, texts.offsets)) + 1)
        number = np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(texts)))[owner]
        edges = np.concatenate([begins, texts.offsets[-1:]])
        if ids is not None:
            some = set_tools.maybe(ids, _ids(batch.column(0).to_numpy()[owner], number))
            size = np.diff(edges)
            texts = Texts(texts.data[np.repeat(some, size)], texts.offsets)
            owner, number, edges = owner[some], number[some], np.concatenate([[0], np.cumsum(size[some])])
        found = words(Texts(texts.data, edges))
        text, word = found.text, found.hash
        if only is not None:
            some = np.zeros(len(owner), bool)
            some[text[set_tools.maybe(only, word)]] = True
            text, word = text[some[text]], word[some[text]]
        line, word = distinct(text, word)
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(new)
        rows = line[first]
        doc = batch.column(0).to_numpy()[owner[rows]] if len(rows) else np.empty(0, np.int64)
        return cls(doc, number[rows].astype(np.int64), np.diff(np.append(first, len(line))), word)

    @classmethod
    def unpack(cls, batch: pa.RecordBatch) -> _Lines:
        """The lines of rows (doc, line, words)."""
        sets = set_tools.unpacked(batch.column(2))
        word = np.concatenate([*sets, np.empty(0, np.uint64)])
        return cls(batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.array([len(x) for x in sets], np.int64), word)

    def packed(self, keep: np.ndarray) -> pa.Array:
        """The words of the kept lines, null for the others."""
        ends = self.first + self.size
        return pa.array([self.word[a:b].tobytes() if k else None for a, b, k in zip(self.first, ends, keep, strict=True)], pa.binary())

    def _sums(self, value: np.ndarray) -> np.ndarray:
        return np.add.reduceat(value, self.first) if len(value) else value

    def high(self) -> np.ndarray:
        """A second signature of each set."""
        return self._sums(mix(self.word))

    def prefixes(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of all lines, each line's rarest first, and where a prefix word is that another line may have.

        A set of up to three words matches equal sets only; a word seen once meets nothing.
        """
        word = self.word[set_tools.by_rarity(table, self.line, self.word)]
        place = np.arange(len(word)) - self.first[self.line]
        size = self.size[self.line]
        known = table[word & np.uint64(set_tools.RARITY_SLOTS - 1)] > 0
        return word, (place <= size - needed(size)) & (size > 3) & known


def _picked(frame: DataFrame, key: str, text: str) -> DataFrame:
    picked = frame.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return picked.where("doc IS NOT NULL AND text IS NOT NULL")


DIGEST = "block int, counts binary, doc long, line long, low long, high long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: signatures of every line, and by block of slots the occurrences of their words.

    Lines that repeat within a slice count once.
    """
    names = [c.split()[0] for c in DIGEST.split(", ")]
    total = np.zeros(set_tools.RARITY_SLOTS, np.int64)
    for batch in batches:
        for part in slices(batch):
            lines = _Lines.read(part)
            one = np.zeros(len(lines.size), bool)
            one[np.unique(lines.low, return_index=True)[1]] = True
            slot = lines.word[one[lines.line]] & np.uint64(set_tools.RARITY_SLOTS - 1)
            np.add.at(total, slot.astype(np.int64), 1)
            none = pa.nulls(len(lines.size), pa.int32()), pa.nulls(len(lines.size), pa.binary())
            yield pa.record_batch([*none, pa.array(lines.doc, pa.int64()), pa.array(lines.number, pa.int64()), signed(lines.low), signed(lines.high())], names)
    blocks = np.minimum(total, MOST).astype("<u2").reshape(-1, BLOCK)
    some = np.flatnonzero(blocks.any(axis=1))
    none = pa.nulls(len(some), pa.int64())
    yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array([x.tobytes() for x in blocks[some]], pa.binary()), none, none, none, none], names)


def _slot_counts(table: pa.Table) -> pa.Table:
    """The counts of the slots of a block that have 2, from those of all tasks."""
    total = np.zeros(BLOCK, np.int64)
    for counts in table.column("counts").to_pylist():
        total += np.frombuffer(counts, "<u2")
    slot = np.flatnonzero(total > 1)
    return pa.table([pa.array((table.column("block")[0].as_py() * BLOCK + slot).astype(np.int32)), pa.array(total[slot])], ["slot", "n"])


def _lines_of(in_pairs: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of the texts that a filter may hold."""
    for batch in batches:
        for part in slices(batch):
            lines = _Lines.read(part, ids=in_pairs)
            rows = [pa.array(lines.doc, pa.int64()), pa.array(lines.number, pa.int64()), lines.packed(np.ones(len(lines.size), bool))]
            yield pa.record_batch(rows, ["doc", "line", "words"])


def needed(size: np.ndarray) -> np.ndarray:
    """Words that a match must share with a line of ``size`` words."""
    return -(-size * SIMILAR // 100)


def _overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that matching lines of these sizes must share."""
    return -(-SIMILAR * (a + b) // (100 + SIMILAR))


def _entries_of(lines: _Lines, table: np.ndarray, only: np.ndarray | None) -> list[pa.Array]:
    """Columns of ``ENTRY``: a row for each word of a line's prefix, or for those that a filter may hold."""
    word, keep = lines.prefixes(table)
    if only is not None:
        keep &= set_tools.maybe(only, word)
    keep = np.flatnonzero(keep)
    at = mix(lines.word) & np.uint64(127)
    one, upper = np.uint64(1) << (at & np.uint64(63)), at >> np.uint64(6) == 1
    bits = [np.bitwise_xor.reduceat(np.where(own, one, np.uint64(0)), lines.first) if len(one) else one for own in (~upper, upper)]
    line = lines.line[keep]
    place = keep - lines.first[line]
    meta = lines.number[line] << 32 | lines.size[line] << 6 | np.minimum(place, 63)  # a smaller place is safe
    return [signed(word[keep]), pa.array(lines.doc[line], pa.int64()), pa.array(meta, pa.int64()), signed(lines.low[line]), signed(bits[0][line]), signed(bits[1][line])]


def _entries(table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of all lines of the texts."""
    for batch in batches:
        for part in slices(batch):
            yield pa.record_batch(_entries_of(_Lines.read(part), table, None), NAMES)


def _asked_entries(table: np.ndarray, asked: np.ndarray, open_lines: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of stored lines under the words asked for, with a mark on those of open lines.

    A line marked by chance only looks at more candidates.
    """
    for batch in batches:
        lines = _Lines.unpack(batch)
        columns = _entries_of(lines, table, asked)
        doc, line = columns[1].to_numpy(), columns[2].to_numpy() >> 32
        ids = _ids(doc, line)
        yield pa.record_batch([*columns, pa.array(set_tools.maybe(open_lines, ids))], [*NAMES, "asked"])


def _prefix_words(table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefix words of stored lines."""
    for batch in batches:
        word, keep = _Lines.unpack(batch).prefixes(table)
        yield pa.record_batch([signed(np.unique(word[keep]))], ["word"])


def _near_lines(table: np.ndarray, asked: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of the texts that have a word asked for in their prefix."""
    for batch in batches:
        for part in slices(batch):
            lines = _Lines.read(part, asked)
            word, keep = lines.prefixes(table)
            near = np.zeros(len(lines.size), bool)
            near[lines.line[keep & set_tools.maybe(asked, word)]] = True
            rows = [pa.array(lines.doc, pa.int64()), pa.array(lines.number, pa.int64()), lines.packed(near)]
            yield pa.record_batch(rows, ["doc", "line", "words"]).filter(pa.array(near))


ENTRY = "word long, doc long, meta long, low long, bits0 long, bits1 long"
NAMES = [c.split()[0] for c in ENTRY.split(", ")]
SET = "doc long, line long, words binary"
PAIR = "doc long, line long, other_doc long, other_line long, id long, other_id long, more boolean"


def _meet(limit: int | None, steps: int, batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Of all groups in a batch, pairs of a line and an earlier one that pass the filters."""
    word, doc, meta, low, bits0, bits1, *asked = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    line, size, place = meta >> 32, (meta & 0xFFFFFFFF) >> 6, meta & 63
    # equal sets are one entry, at their first line
    order = np.lexsort((line, doc, low, word))
    same = np.zeros(len(order), bool)
    same[1:] = (word[order][1:] == word[order][:-1]) & (low[order][1:] == low[order][:-1])
    keep = order[~same]
    keep = keep[np.lexsort((size[keep], word[keep]))]
    word, doc, line, size, place, bits0, bits1 = (x[keep] for x in (word, doc, line, size, place, bits0.view(np.uint64), bits1.view(np.uint64)))
    wanted = asked[0][keep] if asked else np.ones(len(keep), bool)
    hits, out = np.zeros(len(keep), np.int64), []

    def compare(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that pass the filters, the later line first."""
        need = _overlap(size[a], size[b])
        spare = np.minimum(size[a] - place[a], size[b] - place[b])
        apart = np.bitwise_count(bits0[a] ^ bits0[b]).astype(np.int64) + np.bitwise_count(bits1[a] ^ bits1[b])
        passed = (spare >= need) & (apart <= size[a] + size[b] - 2 * need)
        a, b = a[passed], b[passed]
        later = (doc[a] > doc[b]) | ((doc[a] == doc[b]) & (line[a] > line[b]))
        a, b = np.where(later, a, b), np.where(later, b, a)
        own = (doc[a] != doc[b]) | (line[a] != line[b])
        return a[own], b[own]

    live = np.arange(1, len(keep))
    for step in range(1, steps + 1):
        live = live[live >= step]
        other = live - step
        near = (word[live] == word[other]) & (100 * size[other] >= SIMILAR * size[live])
        live, other = live[near], other[near]
        if not len(live):
            break
        a, b = compare(live, other)
        good = wanted[a] if limit is None else wanted[a] & (hits[a] < limit)
        np.add.at(hits, a[good], 1)
        out.append((a[good], b[good]))
    # larger groups: what is left to do for the lines that still want partners
    for group in np.unique(word[live]):
        begin, end = np.searchsorted(word, [group, group + 1]) if group < np.iinfo(np.int64).max else (np.searchsorted(word, group), len(word))
        here = np.arange(begin, end)
        for k in here[wanted[here] & (True if limit is None else hits[here] < limit)]:
            far = here[(np.abs(here - k) > steps) & (100 * size[here] >= SIMILAR * size[k]) & (100 * size[k] >= SIMILAR * size[here])]
            a, b = compare(np.full(len(far), k), far)
            b = b[a == k]
            b = b if limit is None else b[: limit - hits[k]]
            hits[k] += len(b)
            out.append((np.full(len(b), k), b))
    if not out:
        return None
    a, b = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
    more = hits[a] >= limit if limit is not None else np.zeros(len(a), bool)

    columns = [pa.array(x) for x in (doc[a], line[a], doc[b], line[b])]
    return pa.record_batch([*columns, signed(_ids(doc[a], line[a])), signed(_ids(doc[b], line[b])), pa.array(more)], [c.split()[0] for c in PAIR.split(", ")])


def _verified(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc, line) of the pairs whose lines match, by the words of both, which ``lines`` holds."""
    both = pairs.join(lines, ["doc", "line"]).join(lines.toDF("other_doc", "other_line", "other"), ["other_doc", "other_line"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = set_tools.unpacked(batch.column(2)), set_tools.unpacked(batch.column(3))
            shared_words = set_tools.shared_counts(a, b)
            joint = np.array([len(x) for x in a]) + np.array([len(x) for x in b]) - shared_words
            hit = pa.array(100 * shared_words >= SIMILAR * joint)
            yield pa.record_batch(batch.columns[:2], ["doc", "line"]).filter(hit)

    return both.select("doc", "line", "words", "other").mapInArrow(verify, "doc long, line long").distinct()


def kept_lines(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, line) of every line with a word that no earlier line matches."""
    spark = frame.sparkSession
    picked = _picked(frame, key, text)
    limit_batches(spark)
    read = stored(picked.mapInArrow(_digests, DIGEST), "lines")
    signatures = read.where("block IS NULL").select("doc", "line", "low", "high")
    counts = read.where("block IS NOT NULL").select("block", "counts").groupBy("block").applyInArrow(_slot_counts, "slot int, n long")
    send = spark.sparkContext.broadcast
    table = send(set_tools.slot_levels(counts))
    entries = picked.mapInArrow(lambda batches: _entries(table.value, batches), ENTRY)
    by = ["doc", "line", "other_doc", "other_line", "id", "other_id"]
    gone = lines = asked = None
    for turn, limit in enumerate(LIMITS):
        met = set_tools.grouped(entries, "word", partial(_meet, limit, STEPS), PAIR)
        met = stored(met.groupBy(*by).agg(F.max("more").alias("more")), "pairs")
        if turn == 0:
            ids = met.select("id").union(met.select("other_id")).toDF("id")
            in_pairs = send(set_tools.bloom(ids, "id"))
            lines = stored(picked.mapInArrow(lambda batches: _lines_of(in_pairs.value, batches), SET), "words")
        matched = _verified(lines, met)
        gone = stored(matched if gone is None else gone.union(matched).distinct(), "matched")
        if limit is None:
            break
        rest = met.where("more").select("doc", "line", "id").distinct().join(gone, ["doc", "line"], "left_anti")
        rest = stored(rest, "open")
        if rest.isEmpty():
            break
        if turn == 0:
            # from now on only lines that share a prefix word with a line whose first candidates did not match
            found = lines.join(rest.select("doc", "line"), ["doc", "line"], "left_semi")
            found = stored(found.mapInArrow(lambda batches: _prefix_words(table.value, batches), "word long").distinct(), "asked")
            asked = send(set_tools.bloom(found, "word"))
            lines = stored(picked.mapInArrow(lambda batches: _near_lines(table.value, asked.value, batches), SET), "near")
        still = send(set_tools.bloom(rest, "id"))
        entries = lines.mapInArrow(
            lambda batches, still=still: _asked_entries(table.value, asked.value, still.value, batches), f"{ENTRY}, asked boolean"
        )
    # the least line of the least document, by groupings that need no sorting
    firsts = signatures.groupBy("low", "high", "doc").agg(F.min("line").alias("line"))
    firsts = firsts.groupBy("low", "high").agg(F.min("doc").alias("doc"), F.min_by("line", "doc").alias("line")).select("doc", "line")
    return firsts.join(gone, ["doc", "line"], "left_anti")


def dedup(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, with the text of the lines that stay, and ``n_lines`` and ``n_removed``.

    A null text stays null.  Columns of these names in the input are replaced.
    """
    kept = kept_lines(frame, key, text).groupBy(F.col("doc").alias("__doc")).agg(F.collect_list(F.col("line").cast("int")).alias("__kept"))
    names = [c for c in frame.columns if c not in ("n_lines", "n_removed")]
    wide = frame.select(*[F.col(f"`{c}`") for c in names]).join(kept, F.col(f"`{key}`").cast("long") == F.col("__doc"), "left")
    wide = wide.withColumn("__lines", F.coalesce(F.split(F.col(f"`{text}`").cast("string"), "\n", -1), F.array().cast("array<string>")))
    numbers = F.transform("__lines", lambda x, i: F.when(F.col(f"`{key}`").isNull() | ~x.rlike(r"[^ \t\x0B\f\r]"), i))
    stay = F.sort_array(F.array_union(F.coalesce("__kept", F.array().cast("array<int>")), F.array_compact(numbers)))
    wide = wide.withColumn("__stay", stay)
    left = F.array_join(F.transform("__stay", lambda i: F.col("__lines")[i]), "\n")
    return wide.select(
        *[F.when(F.col(f"`{c}`").isNotNull(), left).alias(c) if c == text else F.col(f"`{c}`") for c in names],
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__stay")).cast("long").alias("n_removed"),
    )
