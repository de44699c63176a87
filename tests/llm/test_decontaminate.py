import re

import duckdb

from ledgermill.llm import decontaminate
from ledgermill.llm.queries import SQL, op7_decontaminate

FOLDER = "/root/testdata/sf0.01"


def words(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def shingles(text):
    """Shingles of an item: runs of five words, or all its words."""
    w = words(text)
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def held(item, text):
    """How many of an item's shingles a text holds."""
    w, n = words(text), len(next(iter(item), ()))
    return len(item & {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    want = sorted(con.sql(SQL["op7_decontaminate"]).fetchall())
    got = sorted(tuple(r) for r in op7_decontaminate(spark, FOLDER).collect())
    assert got == want and len(got) > 5


def test_edges(spark):
    item = "one two three four five six seven eight nine ten"
    items = [(1, item), (2, None), (3, ""), (4, "short item"), (4, "short item"), (5, "--- ***"), (6, "Paris"), (7, "to be or not"), (None, "an item of a null id")]
    long = "filler " * 30000
    docs = [
        (1, None), (2, ""), (3, long + item.upper().replace(" ", "***, ") + " " + long), (4, item.replace("ten", "x")),
        (5, item.replace("five", "x")), (6, "Short, ITEM!"), (7, "a short item here"), (8, item), (8, item), (None, item),
        (9, long + "paris"), (10, "that is: to be, or not " + long), (11, "to be or"), (12, "comparison"), (13, "not an item of a null id here"),
    ]
    bench = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, shingle int")
    frame = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, item_id int")
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontaminate.contaminated(frame, bench).collect()}
    want = {}
    for d, text in docs:
        for i, t in items:
            own = shingles(t)
            if own and 10 * held(own, text) >= 8 * len(own):
                want[d, i] = held(own, text) / len(own)
    assert got == want and (3, 1) in got and {(6, 4), (7, 4), (9, 6), (10, 7)} <= set(got) and (5, 1) not in got
    assert decontaminate.contaminated(frame.limit(0), bench).collect() == []
    assert decontaminate.contaminated(frame, bench.limit(0)).collect() == []


def test_large_item_tables_are_joined_without_sending(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SENT_ROWS", 0)
    test_edges(spark)


def test_pairs_of_the_sketch_are_all_that_is_verified(spark):
    """A document that holds a fifth of every item, by chance in the sketch or not, is no pair."""
    items = [(k, " ".join(f"w{k}x{i}" for i in range(5 + 9 * k))) for k in range(12)]
    docs = [(100 * k + cut, " ".join(text.split()[cut:])) for k, text in items for cut in range(0, len(text.split()), 2)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_shared"] for r in decontaminate.contaminated(frame, bench).collect()}
    want = {(d, k): held(shingles(t), text) for d, text in docs for k, t in items if 10 * held(shingles(t), text) >= 8 * len(shingles(t))}
    assert got == want and len(want) > 40


def test_plan_probes_the_sketch_only(spark):
    """Nothing but sketch rows is joined with the documents before pairs are known."""
    sets = decontaminate.item_shingles(spark.read.parquet(f"{FOLDER}/benchmark.parquet"), "item_id", "text")
    rows = decontaminate.sketches(sets.select("item_id", "shingle").distinct())
    assert 0 < rows.where("in_sketch").count() < 0.6 * rows.count()
    assert rows.where("least < 1").count() == 0
