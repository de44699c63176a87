"""SimHash near-duplicates by bit-sliced comparison.

Words are runs of other than ASCII white space, A-Z lower-cased; a shingle is
``SIZE`` of them joined by one space, repeats included, and a text with fewer words is one
shingle.  A bit of the 64-bit fingerprint is 1 if it is set in over half the shingles' XXH64
(seed 42).  Fingerprints link at ``RADIUS`` or fewer differing bits, and the result
names for every document the smallest ``doc_id`` that links reach.

Equal fingerprints are one class, made before anything meets.  Of ``RADIUS + 2`` pieces
of a fingerprint two at least are equal in any pair that links, so every class goes to one cell
per pair of pieces.  A cell of more than ``CROWD`` classes is dealt out once more by
the same rule over its remaining bits, which bounds any cell by 2**16 classes.
Within a stretch of cells the fingerprints are stored as 64 vertical bit planes.  All pairs
at one distance in sort order are compared at once: the planes are shifted
against themselves, 64 pairs to a machine word, and the differing bits are added by
carry-save counters that overflow beyond the radius.  A word is abandoned as soon as all its pairs
have overflowed, belong to different cells or are joined already.  A cell gives a
spanning forest of its links, never all pairs; the forests meet in one search for components.

Null and empty texts and those without words have fingerprint zero and link like any other.
Rows with a null ``doc_id`` get a null component and link with nothing; rows that repeat a
``doc_id`` are joined.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import set_tools
from ledgermill.llm.storage import stored
from ledgermill.llm.text import signed, slices

SIZE = 3
SEED = 42
RADIUS = 2
PIECES = RADIUS + 2
CROWD = 4096

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ONE = np.uint64(1)
_ALL = np.uint64(2**64 - 1)
#: Bits of all pieces in turn: some of the first planes always differ where any do.
_ORDER = [piece * (64 // PIECES) + k for k in range(64 // PIECES) for piece in range(PIECES)]


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of every text, as unsigned 64-bit numbers."""
    out = np.zeros(len(texts), np.uint64)
    hashed = xxhash.xxh64_intdigest
    for k, text in enumerate(texts.to_pylist()):
        words = text.encode().translate(_LOWER).split() if text else []
        if not words:
            continue
        joined = b" ".join(words)
        end = np.cumsum([len(w) + 1 for w in words]) - 1
        last = end[SIZE - 1 :].tolist() or [len(joined)]
        first = [0, *(end[: len(last) - 1] + 1).tolist()]
        hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(last))
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            yield pa.record_batch([part.column(1), signed(fingerprints(part.column(0)))], ["doc", "mark"])


def planes(marks: np.ndarray) -> np.ndarray:
    """Bit ``p`` of mark ``i`` as bit ``i % 64`` of word ``i // 64`` of plane ``p``."""
    lanes = np.zeros((-(-len(marks) // 64) * 64, 8), np.uint8)
    lanes[: len(marks)] = marks.view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(lanes, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _packed(flags: np.ndarray, n_words: int) -> np.ndarray:
    lanes = np.zeros(n_words * 64, bool)
    lanes[: len(flags)] = flags
    return np.packbits(lanes, bitorder="little").view(np.uint64)


def near(sliced: np.ndarray, shift: int, wanted: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Which of the wanted positions ``i`` differ from ``i + shift`` in at most ``radius`` bits, packed by word.

    ``wanted`` is packed like a plane; words without a wanted position are not read.
    """
    skip, low = divmod(shift, 64)
    word = np.flatnonzero(wanted)
    over = ~wanted[word]
    depth = max(1, radius.bit_length())
    start = (1 << depth) - 1 - radius  # counters overflow when more than radius is added
    counters = [np.full(len(word), _ALL if start >> k & 1 else 0, np.uint64) for k in range(depth)]
    n = sliced.shape[1]
    for p in _ORDER:
        plane = sliced[p]
        other = plane[np.minimum(word + skip, n - 1)] >> np.uint64(low)
        if low:
            other |= plane[np.minimum(word + skip + 1, n - 1)] << np.uint64(64 - low)
        carry = plane[word] ^ other
        for k in range(depth):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        alive = over != _ALL
        if not alive.all():
            word, over = word[alive], over[alive]
            counters = [c[alive] for c in counters]
            if not len(word):
                break
    out = np.zeros_like(wanted)
    out[word] = ~over
    return out


def forest(cell: np.ndarray, marks: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of links within equal ``cell`` values, sorted, that join what any links there join."""
    n = len(cell)
    label = np.arange(n)
    begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if n else np.empty(0, np.int64)
    end = np.repeat(np.append(begin[1:], n), np.diff(np.append(begin, n)))
    sliced = planes(marks)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at = np.arange(n)
    shift = 0
    while True:
        shift += 1
        at = at[at + shift < end[at]]  # both in one cell
        if not len(at):
            break
        open_ = at[label[at] != label[at + shift]]
        flags = np.zeros(n, bool)
        flags[open_] = True
        hits = near(sliced, shift, _packed(flags, sliced.shape[1]), radius)
        a = np.flatnonzero(np.unpackbits(hits.view(np.uint8), bitorder="little")[:n])
        if not len(a):
            continue
        # of links between the same two trees one is enough; then join tree by tree
        pair = np.stack([label[a], label[a + shift]])
        _, one = np.unique(np.sort(pair, axis=0), axis=1, return_index=True)
        a = a[one]
        root: dict[int, int] = {}

        def top(x: int, root: dict[int, int] = root) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        keep = []
        for k, (x, y) in enumerate(zip(label[a].tolist(), label[a + shift].tolist(), strict=True)):
            x, y = top(x), top(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                keep.append(k)
        found.append((a[keep], a[keep] + shift))
        renamed = np.arange(n)
        names = np.array(list(root), np.int64)
        renamed[names] = [top(x) for x in root]
        label = renamed[label]
    if not found:
        none = np.empty(0, np.int64)
        return none, none
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _links(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    cell, entry = batch.column(0).to_numpy(), batch.column(1)
    a, b = forest(cell, batch.column(2).to_numpy().view(np.uint64))
    return pa.record_batch([entry.take(pa.array(a)), entry.take(pa.array(b))], ["a", "b"]) if len(a) else None


def _pieces(columns: list[str], width: int, kinds: int) -> F.Column:
    """Cells of every pair of pieces: the pair's number beside both pieces."""
    pairs = combinations(range(PIECES), 2)
    return F.explode(F.array(*[F.expr(f"shiftleft(shiftleft({columns[x]}, {width}) | {columns[y]}, {kinds}) | {k}") for k, (x, y) in enumerate(pairs)]))


def _cells(classes: DataFrame) -> DataFrame:
    """Every class in one cell per pair of pieces (35 bits), crowded ones dealt out by the rest of their bits."""
    width = 64 // PIECES
    mask = (1 << width) - 1
    piece = [f"(shiftrightunsigned(mark, {k * width}) & {mask}L)" for k in range(PIECES)]
    rows = classes.select("entry", "mark", _pieces(piece, width, 3).alias("cell"))
    crowded = rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("cell")
    crowded = stored(crowded, "crowded")
    if crowded.isEmpty():
        return rows.select("cell", "entry", "mark")
    fine = width // 2  # the two other pieces, 32 bits, in four
    rest = F.expr("CASE cell & 7 " + " ".join(
        f"WHEN {k} THEN shiftleft({piece[x]}, {width}) | {piece[y]}"
        for k, (x, y) in enumerate(tuple(z for z in range(PIECES) if z not in pair) for pair in combinations(range(PIECES), 2))
    ) + " END")
    hot = rows.join(crowded, "cell", "left_semi").withColumn("rest", rest)
    part = [f"(shiftright(rest, {k * fine}) & {(1 << fine) - 1}L)" for k in range(PIECES)]
    hot = hot.select("cell", "entry", "mark", _pieces(part, fine, 3).alias("inner"))
    hot = hot.select(F.expr(f"shiftleft(cell, {2 * fine + 3}) | inner | shiftleft(1L, 62)").alias("cell"), "entry", "mark")
    return rows.join(crowded, "cell", "left_anti").select("cell", "entry", "mark").unionByName(hot)


def linked(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row the key, ``fingerprint`` (hexadecimal) and ``component_id``."""
    picked = frame.select(F.col(text).cast("string").alias("text"), F.col(key).cast("long").alias("doc"))
    marked = stored(picked.mapInArrow(_marked, "doc long, mark long"), "marks")
    named = marked.where("doc IS NOT NULL")
    classes = stored(named.groupBy("mark").agg(F.min("doc").alias("entry")), "classes")
    links = set_tools.grouped(_cells(classes), "cell", _links, "a long, b long")
    several = named.distinct().join(classes, "mark").where("doc <> entry").select(F.col("doc").alias("a"), F.col("entry").alias("b"))
    repeated = named.distinct().groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc").alias("a"))
    links = links.unionByName(several.join(repeated, "a", "left_semi"))  # texts of one doc_id
    component = set_tools.components(links)
    names = classes.join(component, F.col("entry") == F.col("node"), "left").select("mark", F.coalesce("component", "entry").alias("name"))
    hexadecimal = F.lower(F.lpad(F.hex("mark"), 16, "0"))
    rows = marked.join(names, "mark", "left")
    return rows.select(F.col("doc").alias(key), hexadecimal.alias("fingerprint"), F.when(F.col("doc").isNotNull(), F.col("name")).alias("component_id"))
