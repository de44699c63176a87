import hashlib
import random
import zlib

import pytest
from compare import compare, database

from ledgermill.llm import conversations
from ledgermill.llm.queries import SQL, op11_conversation_repair

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]


def cheapest(rows):
    """Cost, edits and lines by going through all states; rows are (role, text, fault)."""
    ways = {"": (0, "", [])}

    def add(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def inserts(ways):
        for _ in range(2):
            more = dict(ways)
            for state, (c, e, o) in ways.items():
                new = "a" if state == "u" else "u"
                add(more, new, (c + 2, e + "I", [*o, {"u": "user:", "a": "assistant:"}[new]]))
            ways = more
        return ways

    for role, text, fault in rows:
        now = {}
        for state, (c, e, o) in inserts(ways).items():
            add(now, state, (c + 3, e + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            late, new = fault == "truncated", "a" if state == "u" else "u"
            if role[:1] == new or (role[:1] == "s" and state == ""):
                add(now, role[:1], (c + late, e + "K", [*o, f"{role}:{text}"]))
            add(now, new, (c + 2 + late, e + "R", [*o, f"{ {'u': 'user', 'a': 'assistant'}[new] }:{text}"]))
        ways = now
    return min((w for s, w in inserts(ways).items() if s in ("", "a")), key=lambda w: w[:2])


def brute(rows):
    out = []
    by = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = by.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            own += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, own in by.items():
        own.sort()
        seen, marked = set(), []
        for _, _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for k, t, _, _ in own if k}
        cost, audit, lines = cheapest(marked)
        counts = [sum(f == x for _, _, f in marked) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in conversations.repaired(conversations.damaged(frame)).select(*COLUMNS).collect()), key=str)


def test_query_equals_sql_and_brute_force(spark):
    ok, note = compare(spark, database(FOLDER), op11_conversation_repair, SQL["op11_conversation_repair"], FOLDER)
    assert ok, note
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    want = brute([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert sorted((tuple(r) for r in op11_conversation_repair(spark, FOLDER).collect()), key=str) == want


def made(rng, n, longest):
    roles = ["user", "assistant", "system", "tool", "", "User", "ua", None]
    texts = ["Hello.", "What?", "so", "", " \n", "yes!", "cut off ", "Done. \t", None, "é", "x."]
    rows = []
    for conv in range(n):
        size = rng.choice([1, 2, 3, 5, 8, longest])
        for k in range(size):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.7 else rng.choice(roles)
            if rng.random() < 0.5:
                role = ("user", "assistant")[k % 2]
            turn = rng.choice([None, 0, k, k, k, k, k + 3])
            rows.append((conv if conv else None, turn, role, rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randrange(50)}."))
    return rows


@pytest.mark.parametrize("segment, longest", [(64, 40), (1, 9), (2, 30), (3, 70)])
def test_made_rows_equal_brute_force(spark, monkeypatch, segment, longest):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = made(random.Random(segment), 60, longest)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, number int, kind string, part int")
    assert got(frame.repartition(3)) == brute(rows)


def test_long_conversation_repeats_and_empty_table(spark):
    rows = [(1, k // 3, "user" if k % 2 else "assistant", "again." if k % 7 == 0 else f"{k}.") for k in range(3000)] + [(1, 5, "user", "same.")] * 200
    rows += [(2, 0, "user", "long " * 100_000 + "."), (3, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(frame.repartition(5)) == brute(rows)
    assert got(frame.limit(0)) == []


def test_prices_are_the_cheapest_costs():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice("suax"), rng.randrange(3), rng.choice([1, 1, 1, 2])) for _ in range(rng.randrange(9))]
        lattice = conversations.Lattice(rows, conversations.AT_END)
        edits = lattice.path(conversations.NONE)
        flat = [(role, str(k), f) for k, (role, fault, n) in enumerate(rows) for f in [("", "truncated", "blank")[fault]] + ["duplicate"] * (n - 1)]
        cost, audit, _ = cheapest(flat)
        state = edits[-1][1] if edits else conversations.NONE
        assert (lattice.price[0], "".join(x for x, _ in edits) + conversations.TAIL[state]) == (cost, audit)
