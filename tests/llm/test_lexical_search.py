import math
import re
from collections import Counter

import pytest
from compare import compare, database

from ledgermill.llm import lexical_search
from ledgermill.llm.queries import SQL, op12_lexical_search

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    found = [(d, Counter(terms(t))) for d, t in docs]
    many = sum(bool(c) for _, c in found)
    total = sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, Counter()).update(terms(text))
    rows = []
    for i, q in wanted.items():
        scored = []
        for d, c in found:
            m = 75 + 25 * c.total() * many // max(total, 1)
            score = sum(
                n * math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                for t, n in q.items() if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        rows += [(i, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(rows, key=str)


def got(docs, items, k):
    return sorted((tuple(r) for r in lexical_search.rank(docs, items, k).collect()), key=str)


def test_query_equals_sql_and_brute_force(spark):
    ok, note = compare(spark, database(FOLDER), op12_lexical_search, SQL["op12_lexical_search"], FOLDER)
    assert ok, note
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 20)
    assert got(docs, items, 20) == want


DOCS = [
    (1, "The cat; the dog.", "x"), (2, None, "x"), (3, "", None), (4, "\x00 \x7f--", "x"), (5, "ÄPFEL äpfel Äpfel", "x"),
    (6, "cat", "x"), (6, "cat", "x"), (None, "cat", "x"), (7, "cat " * 30000 + "straße", "x"), (8, "catcat cat_cat 東京 x", "x"), (9, "category", "x"),
]
ITEMS = [(1, "CAT cat äpfel"), (1, "the"), (2, None), (3, "!?"), (None, "東京 straße Äpfel"), (4, "nowhere found"), (5, "cat")]


@pytest.mark.parametrize("block, cells", [(1 << 20, 1 << 21), (2, 3)])
def test_odd_rows_blocks_and_clashing_names(spark, monkeypatch, block, cells):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    docs = spark.createDataFrame([(*d, 7, 8, 9) for d in DOCS], "doc_id long, text string, score string, rank int, item int, term int")
    items = spark.createDataFrame([(*i, "y") for i in ITEMS], "item_id long, text string, doc_id string")
    for k in (1, 3, 20):
        assert got(docs.repartition(3), items, k) == brute([d[:2] for d in DOCS], ITEMS, k)
    assert got(docs.limit(0), items, 3) == [] == got(docs, items.limit(0), 3)
    assert got(docs.where("doc_id < 5 AND doc_id > 1"), items, 3) == []
