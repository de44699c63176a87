import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from ledgermill.llm import neighbours
from ledgermill.llm.queries import op10_neighbours

FOLDER = "/root/testdata/sf0.1"


def brute(rows, queries, k):
    good = {}
    for i, v in rows:
        if v is None or any(x is None for x in v):
            continue
        v = np.array(v, float)
        if np.isfinite(v).all() and v.any():
            good.setdefault(i, []).append(v)
    out = {}
    for q in queries:
        if q in good:
            scores = []
            for i, vs in good.items():
                if i != q:
                    scores.append((-max((v * w).sum() / (np.linalg.norm(v) * np.linalg.norm(w)) for v in vs for w in good[q]), i))
            out[q] = sorted(scores)[:k]
    return out


def check(got, want, k):
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q, best in want.items():
        own = sorted(by.get(q, []))
        assert [x[0] for x in own] == list(range(1, min(k, len(best)) + 1))
        assert all(a[2] >= b[2] for a, b in zip(own, own[1:], strict=False))
        hits += len({x[1] for x in own} & {i for _, i in best})
        total += len(best)
    assert set(by) == {q for q, best in want.items() if best}
    return hits / max(1, total)


def test_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert check(op10_neighbours(spark, FOLDER).collect(), want, 5) >= 0.9


def test_edges_and_ties(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 7)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 8)).tolist()
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(40)]  # one vector with many copies, also among the queries
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0] * 7 + [None]), (204, [float("nan")] + [1.0] * 7), (205, [float("inf")] * 8)]
    rows += [(5, base[5]), (150, [2 * x for x in base[0]])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    queries = frame.where("vec_id % 50 = 0 OR vec_id IN (5, 7, 101)")
    want = brute(rows, [i for i, _ in rows if i % 50 == 0 or i in (5, 7, 101)], 5)
    got = neighbours.nearest(frame, queries, 5).collect()
    assert check(got, want, 5) == 1.0
    for q, best in want.items():
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert np.allclose([x[2] for x in own], [-s for s, _ in best], atol=1e-15, rtol=0)
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 100), key=lambda r: r["rank"])] == [i for _, i in want[100]]
    assert neighbours.nearest(frame.limit(0), queries, 5).collect() == []
    assert neighbours.nearest(frame, queries.limit(0), 5).collect() == []
    assert len(neighbours.nearest(frame.where("vec_id IN (1, 7)"), frame.where("vec_id = 7"), 5).collect()) == 1


def test_levels_are_chosen_over_all_trees(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "WANTED", 300)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert check(op10_neighbours(spark, FOLDER).collect(), want, 5) >= 0.6


def brute_by_blocks(ids, vectors, asked, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for at in range(0, len(asked), 200):
        rows = asked[at : at + 200]
        score = unit[rows] @ unit.T
        score[np.arange(len(rows)), rows] = -2
        for r, own in zip(rows, score, strict=True):
            top = np.argsort(-own, kind="stable")[:k]
            out[int(ids[r])] = [(-own[j], int(ids[j])) for j in top]
    return out


def test_recall_where_the_forest_is_used(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(3)
    size = 32
    centres = rng.standard_normal((600, size))
    given = centres[rng.integers(0, 600, 30_000)] + 0.45 * rng.standard_normal((30_000, size))
    group = rng.standard_normal(size) + 0.15 * rng.standard_normal((2000, size))  # a dense group besides
    vectors = np.concatenate([given, group])
    ids = np.arange(len(vectors))
    table = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(list(vectors), pa.list_(pa.float64()))})
    pq.write_table(table, tmp_path / "embeddings.parquet", row_group_size=5000)
    seen, keep = {}, neighbours.stored

    def spy(frame, name):
        seen[name] = keep(frame, name)
        return seen[name]

    monkeypatch.setattr(neighbours, "stored", spy)
    got = op10_neighbours(spark, str(tmp_path)).collect()
    levels = {r["level"]: r["count"] for r in seen["levels"].groupBy("level").count().collect()}
    assert 0 not in levels and len(levels) > 1  # the forest, at several depths
    want = brute_by_blocks(ids, vectors, np.where(ids % 50 == 0)[0], 5)
    assert check(got, want, 5) >= 0.9


def test_no_growing_table_is_broadcast(spark, monkeypatch):
    sent, keep = [], neighbours.stored

    def read(frame):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        text = frame._jdf.queryExecution().explainString(mode)
        sent.extend(re.findall(r"\(\d+\) BroadcastExchange\nInput \[\d+\]: \[([^\]]*)\]", text))

    monkeypatch.setattr(neighbours, "stored", lambda frame, name: (read(frame), keep(frame, name))[1])
    read(op10_neighbours(spark, FOLDER))
    columns = {re.sub(r"#\d+L?", "", c).strip() for x in sent for c in x.split(",")}
    assert columns <= {"size", "share", "tree", "first", "parts", "level", "prefix"}  # a few rows for each number of components
    assert not [x for x in sent if re.search(r"\b(n|query)#", x)]


def test_each_dimension_by_itself(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(20)] + [(100 + i, rng.standard_normal(3).tolist()) for i in range(4)]
    rows.append((500, rng.standard_normal(9).tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, frame, 5).collect()
    assert not [r for r in got if r["query_id"] == 500]  # alone of its kind
    for low, high in ((0, 20), (100, 104)):
        some = [r for r in rows if low <= r[0] < high]
        want = brute(some, [i for i, _ in some], 5)
        assert check([r for r in got if low <= r["query_id"] < high], want, 5) == 1.0
