import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import personal_data as pii
from ledgermill.llm.queries import op3_personal_data
from ledgermill.llm.text import column

FOLDER = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(a, pii.KINDS[k], b) for a, k, b in sorted(found)]


@pytest.fixture(scope="module")
def model():
    return pii.train(pii.read_labelled())


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        text = "".join(rng.choices("a._+-@@...1234 5() \n9é", k=rng.randrange(40)))
        assert pii.base_spans(text) == plain(text), text


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op3_personal_data(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain(docs[r["doc_id"]] or "")
        text = [f"{k}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == k for x in base) for k in pii.KINDS]
        assert set(text) <= set(r["spans"].split(","))
    added = sum(len(r["spans"].split(",")) if r["spans"] else 0 for r in rows) - sum(sum(r[f"n_{k}"] for k in pii.KINDS) for r in rows)
    print("added spans", added)


def test_viterbi_is_the_best_of_all_paths(model):
    from itertools import product

    words = pii.tokens(column(pa.array(["call (499) 555-6503 now", "x 12 a@b"])))
    score = pii.emissions(model, words)
    best = pii.viterbi(model, score, words.begins)
    for begin, end in zip(words.begins, [*words.begins[1:], len(score)], strict=True):
        def value(path):
            return model.first[path[0]] + sum(score[begin + t, s] for t, s in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False))
        top = max(product(range(len(pii.STATES)), repeat=end - begin), key=value)
        assert np.isclose(value(top), value(tuple(best[begin:end])))


def test_added_spans_on_held_out_sentences(spark, model):
    texts = [
        "Please call (212) 555-0188 tonight.", "Bitte tel. 030 8812 7743 anrufen", "write to operator@localhost soon", None, "",
        "In 1987 there were 4200 cats.", "chapter 9, section 1.3.2", "no numbers at all " * 20000, "call (212) 555-0188 " * 5000,
    ]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    got = {r["doc_id"]: [(s["kind"], texts[r["doc_id"]][s["start"] : s["end"]], s["base"]) for s in r["spans"]] for r in pii.find(frame, model).collect()}
    assert got[0] == [("phone", "(212) 555-0188", False)]
    assert got[1] == [("phone", "030 8812 7743", False)]
    assert got[2] == [("email", "operator@localhost", False)]
    assert got[3] == got[4] == got[5] == got[6] == got[7] == []
    assert len(got[8]) >= 4900


def test_long_texts_take_linear_time(model):
    for text in ("a" * 300_000, "1" * 300_000, "1 " * 150_000, "+1" * 150_000, "a@" * 150_000, "1." * 150_000):
        pii.spans_of(model, pa.array([text]))


def test_empty_table(spark, model):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []
