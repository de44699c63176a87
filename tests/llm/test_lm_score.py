import math
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgermill.llm import lm_score
from ledgermill.llm.queries import op1_lm_score

FOLDER = "/root/testdata/sf0.001"


def brute(docs, target):
    counts = [[Counter(), Counter()], [Counter(), Counter()]]  # model, (n-grams, contexts)
    grams = {}
    for i, (d, t) in enumerate(docs):
        padded = ["<"] * 4 + list(t or "")
        grams[i] = [tuple(padded[k - 4 : k + 1]) for k in range(4, len(padded))]
        for model in ([0, 1] if d in target and d is not None else [1]):
            counts[model][0].update(grams[i])
            counts[model][1].update(g[:-1] for g in grams[i])
    letters = len({g[-1] for own in grams.values() for g in own}) or 1
    share = max(1, sum(counts[0][0].values())) / max(1, sum(counts[1][0].values()))
    out = []
    for i, (d, _) in enumerate(docs):
        loss = [
            sum(math.log(c[1][g[:-1]] + a * letters) - math.log(c[0][g] + a) for g in grams[i]) / max(1, len(grams[i]))
            for c, a in zip(counts, (0.1 * share, 0.1), strict=True)
        ]
        out.append((d, len(grams[i]), *loss, loss[0] - loss[1]))
    return sorted(out, key=str)


def same(got, want):
    got = sorted((tuple(r) for r in got), key=lambda r: str(r[:2]))
    want = sorted(want, key=lambda r: str(r[:2]))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for a, b in zip(sorted(got, key=lambda r: (str(r[:2]), r[4])), sorted(want, key=lambda r: (str(r[:2]), r[4])), strict=True):
        assert all(math.isclose(x, y, abs_tol=1e-5) for x, y in zip(a[2:], b[2:], strict=True)), (a, b)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    target = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    same(op1_lm_score(spark, FOLDER).collect(), brute(docs, target))


def test_edges_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK", 5000)
    docs = [(i, "abc déf 漢 🤷 " * (i % 7)) for i in range(40)] + [(None, "null key"), (50, None), (51, ""), (3, "again"), (3, "again"), (60, "x" * 50000)]
    frame = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, block int, gram string")
    chosen = spark.createDataFrame([(3,), (3,), (5,), (None,), (999,)], "doc_id long")
    same(lm_score.score(frame, chosen).collect(), brute(docs, {3, 5}))
    same(lm_score.score(frame, chosen.limit(0)).collect(), brute(docs, set()))
    assert lm_score.score(frame.limit(0), chosen).collect() == []


def test_losses_are_looked_up_once_and_in_order(monkeypatch):
    asked = []
    search = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *rest: asked.append(np.atleast_1d(v)) or search(a, v, *rest))
    texts = pa.table({"key": pa.array([1, 2, 3], pa.int64()), "text": ["abcabcabc", None, "zyx abcabc"]})
    gram = np.unique(np.concatenate([lm_score.grams(texts.column("text").combine_chunks())[0]]))
    losses = pa.table({"gram": pa.array(gram.view(np.int64)), "target": np.ones(len(gram)), "background": np.arange(len(gram), dtype=float)})
    out = lm_score._score(texts, losses).to_pydict()
    assert out["n_tokens"] == [9, 0, 10] and out["target_loss"] == [1, 0, 1]
    known = [v for v in asked if v.dtype == np.uint64]
    assert sum(map(len, known)) == len(gram) and all((v[1:] > v[:-1]).all() for v in known)
