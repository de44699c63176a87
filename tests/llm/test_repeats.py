import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import repeats
from ledgermill.llm.queries import op2_repeats

FOLDER = "/root/testdata/sf0.001"


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    count = {}
    for r in raw:
        for i in range(len(r) - size + 1):
            count[r[i : i + size]] = count.get(r[i : i + size], 0) + 1
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if count[r[i : i + size]] > 1:
                gone[i : i + size] = b"\x01" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


def test_transform_sorts_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(30):
        parts = [rng.integers(97, 100, rng.integers(1, 40)).astype(np.uint8) for _ in range(rng.integers(1, 12))]
        parts.sort(key=lambda x: -len(x))
        length = np.array([len(x) for x in parts])
        symbols, common = repeats.transform(np.concatenate(parts), length)
        # end marks differ and sort first, by text
        suffixes = sorted(([*p[k:].tolist(), i - 1000], p[k - 1] if k else np.concatenate(parts).max() + 1) for i, p in enumerate(parts) for k in range(len(p) + 1))
        assert symbols.tolist() == [c for _, c in suffixes]
        shared = [0]
        for (a, _), (b, _) in zip(suffixes, suffixes[1:], strict=False):
            shared.append(next(k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y))
        assert common.tolist() == shared


def got(frame, use):
    return {r["row"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.remove(frame, "row", use=use).collect()}


@pytest.mark.parametrize("crowd, stretch, collection", [(2000, 1 << 20, 2 << 20), (1, 1 << 20, 300), (3, 90, 1000)])
def test_random_texts_equal_brute_force(spark, crowd, stretch, collection):
    use = repeats.Settings(24, 5, collection, crowd, stretch)
    rng = random.Random(crowd)
    pool = ["".join(rng.choices("abcdé \n", k=rng.randrange(10, 60))) for _ in range(12)]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh", k=15)) for _ in range(rng.randrange(8))) for _ in range(60)]
    texts += [None, "", "a" * 23, "a" * 24, "a" * 25, "ab" * 300, texts[0], texts[1] + "x", "y" + texts[1], texts[2] * 2, "x\x00" * 30]
    frame = spark.createDataFrame([(7, t, i, "k") for i, t in enumerate(texts)], "doc_id long, text string, row long, kept string").repartition(3)
    want = brute(texts, 24)
    found = got(frame, use)
    for i, expected in enumerate(want):
        assert found[i] == expected, i


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], 400), strict=True))
    result = op2_repeats(spark, FOLDER).collect()
    assert len(result) == len(rows)
    for r in result:
        n, gone, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, spans, hashlib.sha256(kept).hexdigest())
    assert sum(r["n_removed"] > 0 for r in result) > 5


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "row long, text string"), repeats.Settings()) == {}


def test_texts_reach_the_workers_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    frame = spark.range(400, numPartitions=1).selectExpr("id AS doc_id", "repeat(sha2(string(id % 300), 256), 800) AS text")  # 51 KB each
    result = repeats.remove(frame)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    largest = result.mapInArrow(sizes, "n long").agg({"n": "max"}).head()[0]
    spark.conf.unset(name)
    assert largest < 8 << 20  # all texts of a task at once, before
