import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import line_dedup, set_tools
from ledgermill.llm.queries import op4_line_dedup

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(docs):
    """Kept text and number of lines by doc_id."""
    lines = []
    for doc, text in sorted((d, t) for d, t in docs if d is not None and t is not None):
        lines += [(doc, i, set(WORD.findall(lower(x))), x) for i, x in enumerate(text.split("\n"))]
    out = {d: ["" if t is not None else None, 0, 0] for d, t in docs}
    index, kept = {}, {}
    for k, (doc, i, words, raw) in enumerate(lines):
        seen = {j for w in words for j in index.get(w, ())}
        match = any(100 * len(words & lines[j][2]) >= 80 * len(words | lines[j][2]) and lines[j][:2] != (doc, i) for j in seen)
        for w in words:
            index.setdefault(w, []).append(k)
        out[doc][1] += 1
        if match:
            out[doc][2] += 1
        else:
            kept.setdefault(doc, []).append(raw)
    for doc, own in kept.items():
        out[doc][0] = "\n".join(own)
    return out


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = brute(docs)
    rows = op4_line_dedup(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text, n, gone = want[r["doc_id"]]
        assert (r["n_lines"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256((text or "").encode()).hexdigest())
    assert sum(r["n_removed"] for r in rows) > 10


def family(rng, count):
    """Variants of a few lines, some near the threshold."""
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 40))] for _ in range(12)]
    for _ in range(count):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(300)}"
        yield " ".join(words) if rng.random() < 0.9 else rng.choice(["", "  ", "A a", "\t"])


@pytest.mark.parametrize("limits, steps", [((16, 128, None), 64), ((2, 16, None), 64), ((4, None), 64), ((1, 2, None), 2), ((None,), 3)])
def test_families_equal_brute_force(spark, monkeypatch, limits, steps):
    monkeypatch.setattr(line_dedup, "LIMITS", limits)
    monkeypatch.setattr(line_dedup, "STEPS", steps)
    rng = random.Random(len(limits))
    docs = [(i, "\n".join(family(rng, rng.randrange(1, 8)))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, "x y z\n" * 3000), (1003, " ".join(f"v{i}" for i in range(30000))),
             (1004, " ".join(f"v{i}" for i in range(2000, 30000))), (None, docs[0][1]), (1005, "Ünï CÖDE a b c"), (1006, "Ünï CÖDE A b c")]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n_lines int, word string").repartition(3)
    want = brute(docs)
    got = line_dedup.dedup(frame).collect()
    assert len(got) == len(docs)
    for r in got:
        if r["doc_id"] is None:
            assert r["text"] == docs[0][1] and r["n_removed"] == 0
        else:
            assert [r["text"], r["n_lines"], r["n_removed"]] == want[r["doc_id"]], r["doc_id"]


def test_empty_and_repeated(spark):
    frame = spark.createDataFrame([(1, "a b c\na b c"), (1, "a b c\na b c")], "doc_id long, text string")
    assert [r["text"] for r in line_dedup.dedup(frame).collect()] == ["a b c", "a b c"]
    assert line_dedup.dedup(frame.limit(0)).collect() == []


def test_only_lines_with_a_word_asked_for_are_built(monkeypatch):
    texts = ["alpha beta gamma delta epsilon\nnone of these words is asked\n\nzeta alpha eta theta iota", "", "other words once more"]
    batch = pa.record_batch([pa.array([4, 5, 6], pa.int64()), pa.array(texts)], ["doc", "text"])
    filter_ = np.zeros(set_tools.BLOOM_BITS >> 6, np.uint64)
    asked = line_dedup._Lines.read(pa.record_batch([pa.array([1], pa.int64()), pa.array(["alpha"])], ["doc", "text"])).word
    slot = asked & np.uint64(set_tools.BLOOM_BITS - 1)
    filter_[slot >> np.uint64(6)] = np.uint64(1) << (slot & np.uint64(63))
    some, every = line_dedup._Lines.read(batch, filter_), line_dedup._Lines.read(batch)
    assert list(zip(some.doc, some.number, strict=True)) == [(4, 0), (4, 3)]
    assert list(zip(every.doc, every.number, strict=True)) == [(4, 0), (4, 1), (4, 3), (6, 0)]
    assert some.low.tolist() == every.low[[0, 2]].tolist()
    sizes = []
    prefixes = line_dedup._Lines.prefixes
    monkeypatch.setattr(line_dedup._Lines, "prefixes", lambda self, table: sizes.append(len(self.size)) or prefixes(self, table))
    list(line_dedup._near_lines(np.full(set_tools.RARITY_SLOTS, 2, np.uint8), filter_, [batch]))
    assert sizes == [2]


def test_only_lines_in_pairs_are_read_again_and_slots_count_all_tasks():
    texts = ["one two\n\nthree four five\nsix", "", "seven\neight nine", "ten"]
    batch = pa.record_batch([pa.array([4, 5, 6, 7], pa.int64()), pa.array(texts)], ["doc", "text"])
    filter_ = np.zeros(line_dedup.set_tools.BLOOM_BITS >> 6, np.uint64)
    for slot in line_dedup._ids(np.array([4, 6]), np.array([2, 0])) & np.uint64(line_dedup.set_tools.BLOOM_BITS - 1):
        filter_[slot >> np.uint64(6)] |= np.uint64(1) << (slot & np.uint64(63))
    some, every = line_dedup._Lines.read(batch, ids=filter_), line_dedup._Lines.read(batch)
    assert list(zip(some.doc.tolist(), some.number.tolist(), strict=True)) == [(4, 2), (6, 0)]
    assert set(some.low.tolist()) <= set(every.low.tolist()) and len(every.low) == 6
    tasks = [pa.Table.from_batches(line_dedup._digests(iter(part))) for part in ([batch], [batch.slice(0, 1)], [])]
    lines = [t.filter(pa.compute.is_null(t["block"])).num_rows for t in tasks]
    assert lines == [6, 3, 0]
    counts = pa.concat_tables(tasks).drop_columns(["doc", "line", "low", "high"])
    found = {}
    for block in pa.compute.unique(counts["block"].drop_null()).to_pylist():
        rows = line_dedup._slot_counts(counts.filter(pa.compute.equal(counts["block"], block)))
        found |= dict(zip(rows["slot"].to_pylist(), rows["n"].to_pylist(), strict=True))
    twice = every.word[np.isin(every.doc[every.line], [4])] & np.uint64(line_dedup.set_tools.RARITY_SLOTS - 1)
    assert found == {int(slot): 2 for slot in twice}
