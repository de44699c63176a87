"""Language identification with a bit-sliced Bloom filter of n-grams.

The filter is arrays of 64-bit words, one for every 64 languages.  Bit ``l % 64`` of a
slot's word ``l // 64`` belongs to language ``l``, so ``HASHES`` look-ups joined by AND return all languages that contain an
n-gram at once.  A text's hits are counted per language, corrected for the false
positives that the filter's fill makes likely, and the largest count decides.

A language contains an n-gram that makes up at least ``MIN_SHARE`` of its n-grams
(so at most ``1 / MIN_SHARE`` n-grams per language) and is at most ``LIFT`` times
as frequent in any other one.  The filter has ``2 ** BITS`` slots whatever the
corpus: 16 MB for every 64 languages, which is what the executors get.

Null texts and texts without a letter give ``und`` and score 0, and a text none of
whose n-grams is known gives the first language with score 0; equal counts go to
the language first in order of name.  Rows with a null label are not learned from;
learning from no rows gives a model that always says ``und``.  Repeated rows count
as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.storage import stored
from ledgermill.llm.text import column, extend, mix, signed, slices
from ledgermill.session import limit_batches

ORDER = 3
HASHES = 3
BITS = 21
MIN_SHARE = 1e-6
LIFT = 8.0
BINS = 1000  # of scores, for the threshold
SLICE = 1 << 18  # bytes of text that are judged at once; each takes about a hundred in arrays
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of every code point its lower-case letter, 32 for anything that is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def grams(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of the texts' letters, the text of each, and which texts have a letter."""
    texts = column(array)
    codes = np.frombuffer(texts.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])[texts.offsets]
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    size = len(owner) + 2 * len(texts)
    letters, text = np.full(size, 32, np.uint32), np.repeat(np.arange(len(texts)), np.diff(at) + 2)
    letters[np.arange(len(owner)) + 2 * owner + 1] = _letters()[codes[: len(owner)]]
    blank = letters == 32
    keep = np.ones(size, bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (text[1:] == text[:-1]))
    lettered = np.zeros(len(texts), bool)
    lettered[text[~blank]] = True
    letters, text = letters[keep], text[keep]
    n = max(0, len(letters) - ORDER + 1)
    value = np.zeros(n, np.uint64)
    for k in range(ORDER):
        value = value * np.uint64(0x200003) + letters[k : k + n]
    whole = text[:n] == text[ORDER - 1 : ORDER - 1 + n]
    return mix(value[whole]), text[:n][whole], lettered


@dataclass
class Model:
    languages: list[str]
    slots: np.ndarray  # [words, slots]
    chance: np.ndarray  # of a false positive, by language


def _slots(value: np.ndarray, k: int) -> np.ndarray:
    return (value >> np.uint64(21 * k)) & np.uint64((1 << BITS) - 1)


def learn(frame: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Fit the filter to all rows with a label."""
    limit_batches(frame.sparkSession)
    labelled = frame.select(F.col(label).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part in slices(batch):
                value, owner, _ = grams(part.column(1))
                codes = part.column(0).dictionary_encode()
                own = codes.indices.to_numpy()[owner]
                for i, lang in enumerate(codes.dictionary.to_pylist()):
                    found, n = np.unique(value[own == i], return_counts=True)
                    if lang in sums:
                        found, where = np.unique(np.concatenate([sums[lang][0], found]), return_inverse=True)
                        n = np.bincount(where, np.concatenate([sums[lang][1], n]), len(found)).astype(np.int64)
                    sums[lang] = found, n
        for lang, (found, n) in sums.items():
            yield pa.record_batch([signed(found), pa.array([lang] * len(found), pa.string()), pa.array(n)], ["gram", "lang", "n"])

    counts = labelled.mapInArrow(count, "gram long, lang string, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    slots = np.zeros((max(1, -(-len(languages) // 64)), 1 << BITS), np.uint64)
    if languages:
        facts = F.create_map(*[F.lit(x) for k, l in enumerate(languages) for x in (l, k)])
        size = F.create_map(*[F.lit(x) for l in languages for x in (l, float(totals[l]))])
        shares = counts.select("gram", facts[F.col("lang")].alias("bit"), (F.col("n") / size[F.col("lang")]).alias("share"))
        top = F.max("share").over(Window.partitionBy("gram"))
        kept = shares.withColumn("top", top).where(f"share >= {MIN_SHARE} AND share * {LIFT} >= top")
        masks = kept.groupBy("gram", F.expr("bit DIV 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("mask"))
        places = F.array(*[F.expr(f"shiftrightunsigned(gram, {21 * k}) & {(1 << BITS) - 1}L") for k in range(HASHES)])
        filled = masks.select(F.explode(places).alias("slot"), "word", "mask").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
        rows = filled.toArrow()  # one row per slot and word at most
        slots[rows["word"].to_numpy(), rows["slot"].to_numpy()] = rows["mask"].to_numpy().astype(np.int64).view(np.uint64)
    fill = [((slots[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))]
    return Model(languages, slots, np.array(fill) ** HASHES)


def _found(model: Model, array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its corrected hits by language, number of n-grams and whether it has a letter."""
    value, text, lettered = grams(array)
    count = np.bincount(text, minlength=len(array)).astype(float)
    hit = model.slots[:, _slots(value, 0)]
    for k in range(1, HASHES):
        hit &= model.slots[:, _slots(value, k)]
    true = np.zeros((len(array), len(model.languages)))
    for k, chance in enumerate(model.chance):
        found = np.bincount(text[(hit[k // 64] >> np.uint64(k % 64)) & np.uint64(1) == 1], minlength=len(array))
        true[:, k] = np.clip((found - count * chance) / max(1e-9, 1 - chance), 0, None)
    return true, count, lettered


def judge(model: Model, array: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    true, count, lettered = _found(model, array)
    if not model.languages:
        return [UNKNOWN] * len(array), np.zeros(len(array))
    best = true.argmax(axis=1)
    score = np.where(lettered, true[np.arange(len(array)), best] / np.maximum(count, 1), 0.0)
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)], np.minimum(score, 1.0)


def threshold(frame: DataFrame, model: Model, text: str = "text", label: str = "lang") -> float:
    """Score from which a text counts as written in a learned language, fitted on all rows with a label and a letter.

    A row's score in its own language is one that should reach the threshold, its best
    score in any other one that should not, as of a text in a language not learned.
    The middle of the first range with the fewest errors is taken, never 0.
    """
    limit_batches(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)
    labelled = frame.select(F.col(label).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: k for k, lang in enumerate(shared.value.languages)}
        own, other = np.zeros(BINS + 1, np.int64), np.zeros(BINS + 1, np.int64)
        for batch in batches:
            for part in slices(batch, size=SLICE):
                true, size, lettered = _found(shared.value, part.column(1))
                lang = np.array([number.get(x, -1) for x in part.column(0).to_pylist()], np.int64)
                used = lettered & (lang >= 0)
                share = np.minimum(true[used] / np.maximum(size[used, None], 1), 1.0)
                at = np.arange(len(share)), lang[used]
                own += np.bincount((share[at] * BINS).astype(np.int64), minlength=BINS + 1)
                share[at] = 0
                other += np.bincount((share.max(axis=1, initial=0) * BINS).astype(np.int64), minlength=BINS + 1)
        yield pa.record_batch([pa.array(np.arange(BINS + 1)), pa.array(own), pa.array(other)], ["bin", "own", "other"])

    bins = labelled.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, "bin long, own long, other long")
    rows = bins.groupBy("bin").agg(F.sum("own").alias("own"), F.sum("other").alias("other")).orderBy("bin").collect()
    own, other = (np.array([r[c] for r in rows] or [0] * (BINS + 1)) for c in ("own", "other"))
    wrong = np.cumsum(own)[:-1] + other.sum() - np.cumsum(other)[:-1]  # below bin k + 1, by k
    low = int(wrong.argmin())
    more = wrong[low:] != wrong[low]
    high = low + int(more.argmax()) - 1 if more.any() else len(wrong) - 1
    return (low + high + 2) / 2 / BINS


def predict(frame: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; nothing but the text is looked at."""
    limit_batches(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        judged = [judge(shared.value, part.column(part.num_columns - 1)) for part in slices(batch, size=SLICE)]
        lang, score = [x for own, _ in judged for x in own], [own for _, own in judged]
        return [pa.array(lang, pa.string()), pa.array(np.concatenate(score))]

    return extend(frame, text, "lang_pred string, score double", run)
