import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import ngram_join, set_tools
from ledgermill.llm.queries import SQL, op8_ngram_join

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    sets = [(d, runs(t)) for d, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for k, (d, own) in enumerate(sets):
        if d is None:
            continue
        for j in {j for r in own for j in index.get(r, ())}:
            if 100 * len(own & sets[j][1]) >= 80 * len(own | sets[j][1]):
                a, b = find(d), find(sets[j][0])
                root[max(a, b)] = min(a, b)
        for r in own:
            index.setdefault(r, []).append(k)
    return sorted(((d, len(own), find(d) if d is not None else None) for d, own in sets), key=str)


def got(frame):
    return sorted((tuple(r) for r in ngram_join.linked(frame).collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = sorted((tuple(r) for r in op8_ngram_join(spark, FOLDER).collect()), key=str)
    assert rows == brute(docs) and len({r[2] for r in rows}) < len(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert sorted(con.sql(SQL["op8_ngram_join"]).fetchall(), key=str) == rows


@pytest.mark.parametrize("pivots, small, part, ranks", [(2, 32, 20000, 16), (0, 3, 9, 2)])
def test_families_equal_brute_force(spark, monkeypatch, pivots, small, part, ranks):
    for name, value in (("PIVOTS", pivots), ("SMALL", small), ("PART", part), ("RANKS", ranks)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(pivots)
    base = [[f"W{rng.randrange(5000)}" for _ in range(rng.randrange(1, 150))] for _ in range(8)]
    docs = []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        docs.append((i, rng.choice([" ", "\t\n "]).join(words)))
    docs += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "one two three"), (None, docs[3][1]),
             (3, docs[3][1]), (906, "w " * 40000), (907, " ".join(f"u{i}" for i in range(30000))), (908, " ".join(f"u{i}" for i in range(2000, 31000)))]
    frame = spark.createDataFrame([(d, t, 1, "q") for d, t in docs], "doc_id long, text string, size int, component string").repartition(3)
    assert got(frame) == brute(docs)


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(4)
    points = rng.poisson(rng.choice([1, 5, 20], (500, 1)), (500, ngram_join.DIMENSIONS)).astype(np.int32)
    points[300:] = np.maximum(0, points[:200] + rng.integers(-1, 2, (200, ngram_join.DIMENSIONS)))
    sizes = points.sum(axis=1)
    tree = ngram_join.RTree(points, sizes)
    for k in range(500):
        bound = np.minimum(points, points[k]).sum(axis=1) >= ngram_join.needed(sizes, sizes[k])
        fits = bound & (100 * np.maximum(sizes, sizes[k]) * 0 + 100 * np.minimum(sizes, sizes[k]) >= 80 * np.maximum(sizes, sizes[k]))
        assert set(np.flatnonzero(fits)) <= set(tree.search(points[k], int(sizes[k]))) <= set(np.flatnonzero(bound))


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_repeated_ids_join_their_texts(spark):
    a, b, c = ("one two three four five six seven", "alpha beta gamma delta eps zeta", "lone text of some five words")
    docs = [(5, a), (5, b), (2, b), (9, a), (9, None), (7, c), (7, ""), (8, None), (None, a)]
    frame = spark.createDataFrame([(d, t, 1, "n") for d, t in docs], "doc_id long, text string, low int, row string")
    assert got(frame) == brute(docs)
    assert {r[2] for r in got(frame) if r[0] in (2, 5, 9)} == {2}
    kept = sorted((tuple(r)[:2] for r in ngram_join.representatives(frame).collect()), key=str)
    assert kept == sorted([(5, a), (2, b), (9, None), (7, c), (7, ""), (8, None), (None, a)], key=str)
    assert ngram_join.representatives(frame).columns == frame.columns


def test_groups_of_equal_members_are_one():
    rows = [(1, 10), (1, 20), (2, 20), (2, 10), (2, 10), (3, 10), (3, 30), (4, 40), (5, 10), (5, 20), (5, 30)]
    batch = pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["run", "low"])
    groups = {}
    for row in ngram_join._shared_runs(batch).to_pylist():
        groups.setdefault(row["run"], []).append(row["low"])
    assert sorted(groups.values()) == [[10, 20], [10, 20, 30], [10, 30]]


def test_only_texts_of_pairs_are_moved(spark):
    texts = spark.createDataFrame([(i << 33, "x" * i) for i in range(200)], "entry long, text string")
    pairs = spark.createDataFrame([(3 << 33, 5 << 33), (3 << 33, 9 << 33)], "a long, b long")
    assert sorted(r["entry"] >> 33 for r in ngram_join._of_pairs(texts, pairs).collect()) == [3, 5, 9]


def test_points_are_compact_and_whole():
    numbers = ["w " * 3 + " ".join(f"u{i}" for i in range(n)) for n in (3, 400, 200_000)]
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array(numbers)], ["entry", "text"])
    parts = list(ngram_join._points([batch]))
    stored = pa.concat_arrays([p.column(3) for p in parts])
    assert [len(p) for p in stored.to_pylist()] == [256, 256, 1024]
    assert (ngram_join._unpacked(stored) == ngram_join._Sets(batch.column(1)).points()).all()


def test_small_graphs_take_one_stored_table(spark, monkeypatch):
    edges = spark.createDataFrame([(9, 8), (8, 7), (3, 9), (3, 3), (20, 21), (21, 20), (5, 5)], "a long, b long").repartition(3)
    path = spark.range(200).selectExpr("1000 + id AS a", "1001 + id AS b")
    edges = edges.union(path)
    want = {3: 3, 7: 3, 8: 3, 9: 3, 20: 20, 21: 20, **{1000 + k: 1000 for k in range(201)}}
    written, stored = [], set_tools.stored
    monkeypatch.setattr(set_tools, "stored", lambda frame, purpose: written.append(purpose) or stored(frame, purpose))
    assert {r["node"]: r["component"] for r in set_tools.components(edges).collect()} == want
    assert len(written) == 1  # before, two for every round
    monkeypatch.setattr(set_tools, "EDGES", 1)
    assert {r["node"]: r["component"] for r in set_tools.components(edges).collect()} == want
    assert set_tools.components(edges.where("a = b")).count() == 0


def test_texts_of_unlike_sizes_are_not_moved(spark, monkeypatch):
    # beginnings of one text, whose rarest runs they share, and four near copies in three classes
    docs = [(k, " ".join(f"p{i}" for i in range(n))) for k, n in enumerate([20, 60, 200, 700])]
    near = [f"n{i}" for i in range(80)]
    docs += [(100 + k, " ".join(near[:40] + [f"x{k}"] * (k % 2) + near[40:])) for k in range(4)]
    tables, stored = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda frame, purpose: tables.setdefault(purpose, stored(frame, purpose)) if purpose == "texts" else stored(frame, purpose))
    monkeypatch.setattr(set_tools, "rarity_table", lambda counts: np.zeros(set_tools.RARITY_SLOTS, np.uint8))
    assert got(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)) == brute(docs)
    assert sorted(r["text"][:2] for r in tables["texts"].collect()) == ["n0"] * 3  # before, also the four others


@pytest.mark.parametrize("n", [1, 2, 5, 9, 40, 333, 1000])
def test_groups_keep_every_pair_that_may_link(n):
    rng = np.random.default_rng(n)
    for _ in range(200):
        m = int(rng.integers(-(-n * 80 // 100), n * 100 // 80 + 1))
        size = np.array([n, m])
        must = ngram_join.needed(size[:1], size[1:])[0]
        last = size + (-size * 80 // 100)
        # the first common run stands at most so far behind that what follows suffices
        place = np.array([rng.integers(0, x - must + 1) for x in size])
        low = ngram_join._coded(size) | np.array([1, 2], np.uint64)
        eighth = (ngram_join.PLACES * place // (last + 1)).astype(np.uint64) << np.uint64(ngram_join.PLACE_BIT)
        batch = pa.record_batch([pa.array([7, 7]), pa.array((low | eighth).view(np.int64))], ["run", "low"])
        assert set(ngram_join._shared_runs(batch).column(1).to_numpy().view(np.uint64)) == set(low)
        least, below = ngram_join._size_range(low)
        assert (least <= size).all() and (size < below).all()


def test_groups_are_cut_where_sizes_are_too_far_apart():
    size = np.array([100, 110, 118, 400, 430, 5000])
    low = ngram_join._coded(size) | np.arange(1, 7, dtype=np.uint64)
    late = np.uint64((ngram_join.PLACES - 1) << ngram_join.PLACE_BIT)
    rows = [(1, x) for x in low] + [(2, low[0] | late), (2, low[1] | late), (3, low[0]), (3, low[3]), (4, low[5])]
    batch = pa.record_batch([pa.array([r for r, _ in rows]), pa.array(np.array([x for _, x in rows]).view(np.int64))], ["run", "low"])
    groups = {}
    for row in ngram_join._shared_runs(batch).to_pylist():
        groups.setdefault(row["run"], []).append(row["low"])
    assert sorted(sorted(int(x) % 8 for x in g) for g in groups.values()) == [[1, 2, 3], [4, 5]]
