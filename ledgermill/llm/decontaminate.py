"""Benchmark decontamination: containment search of short items in long documents.

Items and documents are sets of shingles of ``SIZE`` words (letters and digits,
lower-cased).  An item is found in a document that holds at least ``CONTAINED`` of the
item's shingles.  An item of fewer words is one shingle, the run of all its words;
documents show runs of ``n`` words too where items of ``n`` words exist, so short
items are found inside long documents as well.

Items are partitioned by set size (powers of two).  Each partition keeps as MinHash
sketch of an item the ``k`` smallest hashes of its shingles, where ``k`` follows
from the largest set of the partition so that a document with the wanted
containment must hold some of them.  Sketches are probed with every shingle of
every document, so the length of a document costs no recall, as it would with
equal signatures on both sides.  A document that misses ``m`` of an item's shingles
misses at most ``m`` of its sketch: pairs with fewer hits than that leaves go.  Only the
documents of the pairs that stay meet whole items, for the exact count of shared
shingles.  All of it is DataFrame expressions.

Null, empty and wordless texts match nothing; neither do items without a word.
Rows with the same ``doc_id`` or ``item_id`` count as one document or item, whose
set is the union; all null ids are one id.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.storage import stored

SIZE = 5
CONTAINED = 80  # per cent
#: Rows of item shingles (24 bytes each) up to which they are sent to all executors.
SENT_ROWS = 1_000_000


def word_list(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text).cast("string")), r"[^\p{L}\p{N}]+"), "")


def runs(words: str, n: int) -> str:
    """Hashes of all runs of ``n`` words of an array column; runs shorter than ``SIZE`` never equal longer ones."""
    hashed = ", ".join(["w", *[f"{words}[i + {k}]" for k in range(1, n)], *([] if n == SIZE else [str(n)])])
    return f"IF(size({words}) >= {n}, transform(slice({words}, 1, size({words}) - {n - 1}), (w, i) -> xxhash64({hashed})), array())"


def item_shingles(items: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct shingles of the items, with the number of words of each."""
    split = items.select(F.col(key).alias("item_id"), word_list(text).alias("words"))
    whole = " ".join(f"WHEN {n} THEN {runs('words', n)}" for n in range(1, SIZE))
    hashes = F.expr(f"CASE size(words) WHEN 0 THEN array() {whole} ELSE {runs('words', SIZE)} END")
    n_words = F.least(F.size("words"), F.lit(SIZE)).alias("n_words")
    return split.select("item_id", n_words, F.explode(hashes).alias("shingle")).distinct()


def document_shingles(documents: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per document and run of words, repeats included, from ``doc_id`` and ``text``."""
    split = documents.select("doc_id", word_list("text").alias("words"))
    hashes = [F.expr(runs("words", n)) for n in sizes]
    return split.select("doc_id", F.explode(hashes[0] if len(hashes) == 1 else F.concat(*hashes)).alias("shingle"))


def sketches(shingles: DataFrame) -> DataFrame:
    """Item shingles with set size, whether the shingle belongs to the item's sketch, and the hits a document must have."""
    by_item = Window.partitionBy("item_id")
    sized = shingles.withColumn("n_item", F.count("*").over(by_item))
    upper = F.expr("shiftleft(2L, CAST(floor(log2(n_item)) AS INT)) - 1")  # largest set of the partition
    kept = upper - F.ceil(upper * CONTAINED / 100) + 1
    missing = F.expr(f"n_item * {100 - CONTAINED} DIV 100")
    order = F.row_number().over(by_item.orderBy(F.xxhash64("shingle"), "shingle"))
    return sized.select(
        "item_id", "shingle", "n_item", (order <= kept).alias("in_sketch"), (F.least(kept, "n_item") - missing).alias("least"),
    )


def _sent(table: DataFrame) -> DataFrame:
    """Marked for sending to all executors if its counted rows allow it."""
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Pairs of document and item: the ids, ``n_item``, ``n_shared`` and ``containment``."""
    texts = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    shingles = item_shingles(benchmark, item, item_text)
    sizes = sorted({SIZE} | {r["n_words"] for r in shingles.select("n_words").distinct().collect()})  # SIZE rows at most
    table = stored(sketches(shingles.select("item_id", "shingle").distinct()), "item_sketches")

    sketch = table.where("in_sketch").select("item_id", "shingle", "least")
    hits = document_shingles(texts, sizes).join(_sent(sketch), "shingle").distinct()
    pairs = hits.groupBy("doc_id", "item_id", "least").count().where("count >= least")
    pairs = stored(pairs.select("doc_id", "item_id"), "sketch_pairs")

    searched = texts.alias("d").join(pairs.alias("p"), F.expr("d.doc_id <=> p.doc_id"), "left_semi")
    items = table.select("item_id", "shingle", "n_item")
    shared = document_shingles(searched, sizes).join(_sent(items), "shingle").distinct()
    counted = shared.groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_shared"))
    met = F.expr("c.doc_id <=> p.doc_id AND c.item_id <=> p.item_id")
    found = counted.where(f"100 * n_shared >= {CONTAINED} * n_item").alias("c").join(pairs.alias("p"), met, "left_semi")
    return found.select(
        F.col("doc_id").alias(key), F.col("item_id").alias(item), "n_item", "n_shared",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )
