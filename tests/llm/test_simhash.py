import random
import re

import numpy as np
import pytest
import xxhash

from ledgermill.llm import simhash
from ledgermill.llm.queries import op13_simhash

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mark(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs):
    marks = [(d, mark(t)) for d, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(d, m) for d, m in marks if d is not None]
    for k, (d, m) in enumerate(known):
        for e, n in known[:k]:
            if (m ^ n).bit_count() <= 2:
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return sorted(((d, f"{m:016x}", find(d) if d is not None else None) for d, m in marks), key=str)


def got(frame):
    return sorted((tuple(r) for r in simhash.linked(frame).collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = sorted((tuple(r) for r in op13_simhash(spark, FOLDER).collect()), key=str)
    assert rows == brute(docs) and len({r[2] for r in rows}) < len(rows)


def test_odd_rows_and_clashing_names(spark):
    long = " ".join(f"w{k % 9000}" for k in range(200_000))
    docs = [
        (4, None), (3, ""), (9, " \t\n"), (5, "One two THREE four"), (2, "one two\tthree\x0bfour"), (8, "one two"), (1, long), (7, long + " end"),
        (None, "one two three four"), (6, "alpha beta gamma"), (6, "one two"), (6, "one two"), (10, "alpha beta gamma"), (11, "é É x"),
    ]
    frame = spark.createDataFrame([(*d, 1, "x", 2.0) for d in docs], "doc_id long, text string, mark int, cell string, entry double")
    rows = got(frame.repartition(3))
    assert rows == brute(docs)
    ids = {(r[0], r[1]): r[2] for r in rows}
    assert {r[2] for r in rows if r[0] in (6, 8, 10)} == {6} and ids[(9, "0" * 16)] == 3
    assert got(frame.limit(0)) == []


def clusters(rng, n):
    """Fingerprints in chains of one or two changed bits, beside unrelated ones."""
    out = []
    for _ in range(n):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 40, 90])):
            out.append(at)
            for _ in range(rng.choice([1, 1, 2, 3])):
                at ^= 1 << rng.randrange(64)
    rng.shuffle(out)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_near_counts_bits(radius):
    rng = random.Random(radius)
    marks = np.array(clusters(rng, 12)[:300], np.uint64)
    sliced = simhash.planes(marks)
    for shift in (1, 5, 63, 64, 65, 130):
        if shift >= len(marks):
            continue
        wanted = np.zeros(len(marks), bool)
        wanted[: len(marks) - shift] = True
        hits = simhash.near(sliced, shift, simhash._packed(wanted, sliced.shape[1]), radius)
        hits = np.unpackbits(hits.view(np.uint8), bitorder="little")[: len(marks)]
        want = [i + shift < len(marks) and (int(marks[i]) ^ int(marks[i + shift])).bit_count() <= radius for i in range(len(marks))]
        assert hits.astype(bool).tolist() == want


def joined(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("crowd", [4096, 3])
def test_cells_join_what_all_pairs_join(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(3)
    marks = clusters(rng, 30)
    base = rng.getrandbits(64)
    marks = list(dict.fromkeys(marks + [base & ~0xFFFFFFFF | rng.getrandbits(32) & rng.getrandbits(32) & rng.getrandbits(32) for _ in range(200)]))
    signed = [m - (m >> 63 << 64) for m in marks]
    classes = spark.createDataFrame(list(enumerate(signed)), "entry long, mark long")
    cells = simhash._cells(classes)
    links = [tuple(r) for r in simhash.set_tools.grouped(cells, "cell", simhash._links, "a long, b long").collect()]
    assert all((marks[a] ^ marks[b]).bit_count() <= 2 for a, b in links)
    pairs = [(a, b) for a in range(len(marks)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 2]
    assert joined(len(marks), links) == joined(len(marks), pairs)
