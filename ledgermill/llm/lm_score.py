"""Cross-entropy difference of texts under a target and a background n-gram model.

Tokens are characters.  Both models are of order ``ORDER`` over one vocabulary, all
characters of the corpus: the target model counts the target texts, the
background model all texts.  Smoothing adds ``ALPHA`` to background counts and the same
share of the target's size to target counts, so an n-gram that says nothing counts
equal in both.  A text's score is the mean over its tokens of the loss under the target
model less that under the background model; lower is closer to the target.

The models grow with the corpus and are nowhere held whole.  Texts are dealt into
blocks of about ``BLOCK`` bytes by a hash of their key.  A block's distinct n-grams are its
share of the counts and, joined with the finished models, the only losses it
needs; the block's texts meet them again and are scored.

Null and empty texts have no tokens and score 0.  A null key is in no model's target;
rows that repeat a key are scored each, and all are target if the key is.  Without
target texts the target model is uniform.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.storage import stored
from ledgermill.llm.text import column, mix, signed, slices

ORDER = 5
ALPHA = 0.1
BLOCK = 16 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_START = 0x110000


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token the hash of its n-gram, its context (not yet mixed), the character, and the text it is in."""
    raw = column(texts)
    codes = np.frombuffer(raw.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((raw.data & 0xC0) != 0x80)])[raw.offsets]
    pad = ORDER - 1
    text = np.repeat(np.arange(len(raw)), np.diff(at))
    codes = codes[: len(text)]
    token = np.ones(len(text) + pad * len(raw), bool)
    for k in range(pad):
        token[at[:-1] + pad * np.arange(len(raw)) + k] = False
    padded = np.full(len(token), _START, np.uint64)
    padded[token] = codes
    n = max(0, len(padded) - pad)
    context = np.zeros(n, np.uint64)
    for k in range(pad):
        context *= _STEP
        context += padded[k : k + n]
        context += np.uint64(1)
    context = context[token[pad:]]
    return mix(context * _STEP + codes), context, codes, text


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts values, and where in it each distinct value begins."""
    order = np.argsort(values)
    own = values[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    return order, np.flatnonzero(new)


def _count(table: pa.Table, target: pa.Table) -> pa.Table:
    """Distinct n-grams of a block with contexts and both models' counts; context 0 stands for characters."""
    wanted = np.unique(target.column("key").drop_null().to_numpy())
    block = table.column("block")[0].as_py() if table.num_rows else 0
    found: list[tuple[np.ndarray, ...]] = []
    for part in (p for batch in table.combine_chunks().to_batches() for p in slices(batch)):
        gram, context, code, text = grams(part.column(part.schema.get_field_index("text")))
        key = part.column(part.schema.get_field_index("key"))
        own = (np.isin(key.fill_null(0).to_numpy(), wanted) & key.is_valid().to_numpy(zero_copy_only=False))[text]
        order, begin = _runs(gram)
        first = order[begin]
        m = np.add.reduceat(own[order].astype(np.int64), begin) if len(begin) else begin
        found.append((gram[first], mix(context[first]), np.diff(np.append(begin, len(gram))), m))
        letter, n = np.unique(code, return_counts=True)
        found.append((mix(letter.astype(np.uint64)), np.zeros(len(letter), np.uint64), n, np.zeros(len(letter), np.int64)))
    if not found:
        return pa.table({"gram": pa.array([], pa.int64()), "context": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "m": pa.array([], pa.int64())})
    value, context, n, m = (np.concatenate(x) for x in zip(*found, strict=True))
    order, begin = _runs(value ^ context * _STEP)
    first = order[begin]
    n, m = (np.add.reduceat(x[order], begin) if len(begin) else x for x in (n, m))
    return pa.table(
        {"gram": signed(value[first]), "context": signed(context[first]), "block": pa.array(np.full(len(first), block)), "n": pa.array(n), "m": pa.array(m)}
    )


def _score(table: pa.Table, losses: pa.Table) -> pa.Table:
    """Losses of a block's texts from those of its n-grams."""
    gram = losses.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(gram)
    gram = gram[order]
    each = [losses.column(c).to_numpy()[order] for c in ("target", "background")]
    keys, out = [], []
    for part in (p for batch in table.combine_chunks().to_batches() for p in slices(batch)):
        value, _, _, text = grams(part.column(part.schema.get_field_index("text")))
        # looked up in order, so that neighbours are found close to each other
        by, begin = _runs(value)
        at = np.empty(len(value), np.int64)
        at[by] = np.repeat(np.searchsorted(gram, value[by[begin]]), np.diff(np.append(begin, len(value))))
        keys.append(part.column(part.schema.get_field_index("key")))
        n = np.bincount(text, minlength=part.num_rows)
        out.append([n, *[np.bincount(text, x[at], part.num_rows) / np.maximum(n, 1) for x in each]])
    kind = table.schema.field("key").type
    n, target, background = (np.concatenate([x[k] for x in out]) if out else np.empty(0) for k in range(3))
    return pa.table(
        {"key": pa.chunked_array(keys, kind), "n_tokens": pa.array(n.astype(np.int64)), "target_loss": pa.array(target), "background_loss": pa.array(background)}
    )


def score(frame: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row the key, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``.

    ``target`` names the target texts by the same key.
    """
    rows = frame.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, size // BLOCK)
    dealt = F.when(F.col("key").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("key"))
    rows = rows.select(F.pmod(dealt, F.lit(blocks)).alias("block"), "key", "text")
    wanted = target.select(F.col(key).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    wanted = wanted.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "key")
    counts = rows.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(_count, "gram long, context long, block long, n long, m long")
    counts = stored(counts, "counts")
    sums = counts.groupBy("gram", "context").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    sums = stored(sums, "sums")
    whole = sums.groupBy(F.col("context") == 0).agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    letters = next((r["kinds"] for r in whole if r[0]), 1)
    n, m = next(((r["n"], r["m"]) for r in whole if not r[0]), (1, 1))
    share = max(m, 1) / n
    by_context = sums.where("context <> 0").groupBy("context").agg(F.sum("n").alias("all_n"), F.sum("m").alias("all_m"))
    model = sums.where("context <> 0").join(by_context, "context").select(
        "gram",
        (F.log(F.col("all_m") + ALPHA * share * letters) - F.log(F.col("m") + ALPHA * share)).cast("float").alias("target"),
        (F.log(F.col("all_n") + ALPHA * letters) - F.log(F.col("n") + ALPHA)).cast("float").alias("background"),
    )
    losses = counts.where("context <> 0").select("gram", "block").join(model, "gram").select("block", "gram", "target", "background")
    scored = rows.groupBy("block").cogroup(losses.groupBy("block")).applyInArrow(
        _score, "key long, n_tokens long, target_loss double, background_loss double"
    )
    return scored.select(F.col("key").alias(key), "n_tokens", "target_loss", "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("score"))
