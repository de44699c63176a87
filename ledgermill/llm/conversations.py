"""Repair of the structure of conversations by the auction shortest-path algorithm.

A conversation is sound when its role initials read ``(s?(ua)+)?``.  It is repaired by
edits of its rows in order: Keep (0), Rerole to user or assistant (2), Delete (3), and Insert an empty
user or assistant row anywhere (2); blank rows and repeats of an earlier row
must go, and a truncated row that stays costs 1 more.  Of the cheapest repairs
the one whose edit initials are least in ASCII order is taken.

The edits are arcs of a lattice: a node is a row to come and one of four states of the rows put out
so far (none, after s, after u, after a).  The auction keeps a price per node, never
above the cost of an arc plus the price at its end, and one path from the origin.  While an
arc at the path's end is tight (price equals cost plus price) the path is extended by it,
otherwise the price is raised until one is and the path contracts by a node.  Prices
only rise, all costs are whole numbers, and when the path reaches the end its prices are the
cheapest costs.  Of tight arcs the least letter is followed; no arc that was not tight when a
path extended can be on a cheapest one, so the path found is also the least in order.

Rows are dealt by ranges of (conversation, turn), equal rows as one with a number, and cut into
segments of up to ``SEGMENT`` of them, so that a conversation of any length is spread over
tasks.  One that lies within a segment is settled there.  Of the others each segment gives
the cheapest cost between any two states, as prices at the origins; these are passed
backwards from segment to segment, every segment is traced from each of its states, and the traces are strung
together.  SHA-256 reads a text from its beginning, so the strings of one conversation
are read by one task, as a stream, none of them held.

Rows are ordered by turn (nulls first), equal turns by role, then text; null role and text count
as one space.  Null conversation ids are one conversation.  Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.storage import stored

SEGMENT = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
GOOD, CUT, GONE = 0, 1, 2  # rows as they are, truncated, to be deleted
NONE, S, U, A = range(4)  # what was put out last
AT_END = [0, 2 * INSERT, INSERT, 0]  # cheapest way from a state to a sound end, by inserts only
TAIL = ["", "II", "I", ""]
NEXT = [U, U, A, U]
WANTED = {U: "u", A: "a"}  # the initial of a row that may be kept there
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60
BLANKS = " \t\n\x0b\f\r"

Row = tuple[str, int, int]  # initial, fault of the first of the equal rows, number of equal rows


class Lattice:
    """Prices over the edits of some rows; ``ends`` are the costs of what comes after them, by state."""

    def __init__(self, rows: list[Row], ends: list[int]) -> None:
        self.rows, self.ends, self.n = rows, ends, len(rows)
        self.paired = min(ends[U], ends[A]) < FAR  # else nothing may be put out after s
        self.known: dict[int, list[tuple[str, int, int]]] = {}
        # cost that no edit of a row avoids: a sound first bound for all four states
        bound = [min(ends)]
        for _, fault, count in reversed(rows):
            bound.append(bound[-1] + DELETE * (count - (fault != GONE)) + TRUNCATED * (fault == CUT))
        bound.reverse()
        self.price = [b for b in bound for _ in range(4)]

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """Letter, cost and end of every edit at a node, in order of the letters."""
        at, state = divmod(node, 4)
        initial, fault, count = self.rows[at]
        repeats = "D" * (count - 1)  # copies of a row that comes first must go
        rest = DELETE * (count - 1)
        stay, to = rest + TRUNCATED * (fault == CUT), NEXT[state]
        out = [("D" + repeats, DELETE + rest, node + 4)]
        if self.paired:
            out.append(("I", INSERT, 4 * at + to))
        if fault != GONE and initial == "s" and state == NONE:
            out.append(("K" + repeats, KEEP + stay, 4 * (at + 1) + S))
        if fault != GONE and self.paired:
            if initial == WANTED[to]:
                out.append(("K" + repeats, KEEP + stay, 4 * (at + 1) + to))
            out.append(("R" + repeats, REROLE + stay, 4 * (at + 1) + to))
        return out

    def path(self, origin: int) -> list[tuple[str, int]] | None:
        """Cheapest edits from a state before the first row, least in order: letters and the state after each."""
        price, ends = self.price, self.ends
        last = 4 * self.n
        walked: list[tuple[int, str]] = []  # nodes left behind, and the letters that led on
        node = origin
        while True:
            if node >= last:
                least, best = ends[node - last], None
            else:
                arcs = self.known.get(node) or self.known.setdefault(node, self.arcs(node))
                least, best = min((cost + price[end], k) for k, (_, cost, end) in enumerate(arcs))
            if price[node] < least:
                if least >= FAR and node == origin:
                    price[node] = FAR
                    return None
                price[node] = least
                if walked:
                    node = walked.pop()[0]
            elif best is None:
                nodes = [w[0] for w in walked[1:]] + [node] if walked else []
                return [(letter, end % 4) for (_, letter), end in zip(walked, nodes, strict=True)]
            else:
                letter, _, end = arcs[best]
                walked.append((node, letter))
                node = end


def costs(rows: list[Row]) -> list[int]:
    """Cheapest cost from each state before the rows to each state after them, row by row of a 4 x 4 table."""
    out = [FAR] * 16
    for end in range(4):
        ends = [FAR] * 4
        ends[end] = 0
        lattice = Lattice(rows, ends)
        for origin in range(4):
            lattice.path(origin)
            out[4 * origin + end] = min(lattice.price[origin], FAR)
    return out


class _Written:
    """The repaired rows as edits produce them."""

    def __init__(self, edits: list[tuple[str, int]], roles: list[str], texts: list[str]) -> None:
        self.audit = "".join(letter for letter, _ in edits)
        lines, at = [], 0
        for letter, state in edits:
            if letter[0] == "I":
                lines.append("user:" if state == U else "assistant:")
                continue
            if letter[0] == "K":
                lines.append(f"{roles[at]}:{texts[at]}")
            elif letter[0] == "R":
                lines.append(f"{'user' if state == U else 'assistant'}:{texts[at]}")
            at += 1
        self.lines = lines
        self.state = edits[-1][1] if edits else None


def _tail(state: int) -> list[str]:
    return ["user:", "assistant:"][2 - len(TAIL[state]) :]


FACTS = "blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, turns long, first_initial string, last_initial string"
SUMS = ["blank", "duplicate", "truncated", "illegal"]


def _facts(kinds: list[int], numbers: list[int], turns: list[int | None], initials: list[str]) -> list:
    """Counts over the damaged rows: kinds are 0 good, 1 truncated, 2 a repeat, 3 blank."""
    real = [k for k, n in enumerate(numbers) if n]
    blank = sum(numbers[k] for k in real if kinds[k] == 3)
    duplicate = sum(numbers[k] - (kinds[k] != 2) for k in real if kinds[k] != 3)
    pairs = sum(numbers[k] - 1 for k in real) + sum(initials[a] + initials[b] not in LEGAL for a, b in zip(real, real[1:]))
    known = [turns[k] for k in real if turns[k] is not None]
    return [
        blank, duplicate, sum(kinds[k] == 1 for k in real), pairs, known[0] if known else None, known[-1] if known else None,
        len(set(known)), initials[real[0]] if real else None, initials[real[-1]] if real else None,
    ]


def _segments(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, turn, role, text, kind, number) as segments; whole conversations settled."""
    part = TaskContext.get().partitionId()
    conv, held, seq, whole = None, [], 0, False
    ready: list[list] = []

    def segment(closed: bool) -> list:
        """closed: nothing of the conversation lies elsewhere."""
        nonlocal seq
        turns, roles, texts, kinds, numbers = (list(x) for x in zip(*held, strict=True))
        initials = [(r or "")[:1] for r in roles]
        facts = _facts(kinds, numbers, turns, initials)
        rows = [(initials[k], min(kinds[k], GONE), numbers[k]) for k in range(len(held)) if numbers[k]]
        if not closed:
            table = costs(rows)
            keep = [k for k in range(len(held)) if numbers[k]]
            own = [[x[k] for k in keep] for x in (roles, texts, kinds, numbers)]
            out = [conv, part, seq, False, *facts, None, None, None, table, *own]
        else:
            lattice = Lattice(rows, AT_END)
            edits = lattice.path(NONE)
            keep = [k for k in range(len(held)) if numbers[k]]
            done = _Written(edits, [roles[k] for k in keep], [texts[k] for k in keep])
            state = NONE if done.state is None else done.state
            digest = hashlib.sha256("\n".join(done.lines + _tail(state)).encode()).hexdigest()
            out = [conv, part, seq, True, *facts, lattice.price[NONE], done.audit + TAIL[state], digest, None, None, None, None, None]
        held.clear()
        seq += 1
        return out

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in ready], t) for k, t in enumerate(TYPES)], NAMES)
        ready.clear()
        return out

    first = True
    for batch in batches:
        convs, *columns = (c.to_pylist() for c in batch.columns)
        for own, *row in zip(convs, *columns, strict=True):
            if held and own != conv:
                ready.append(segment(whole))
                whole = True  # the conversation that begins here begins here
            elif held and len(held) == size:
                ready.append(segment(False))
                whole = False
            elif first:
                whole = False  # may have begun in the part before
            first = False
            conv = own
            held.append(row)
            if len(ready) >= 4096:
                yield flushed()
    if held:
        ready.append(segment(False))  # may go on in the part after
    if ready:
        yield flushed()


_FIELDS = [
    ("conv", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("closed", pa.bool_()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("cost", pa.int64()), ("audit", pa.string()), ("digest", pa.string()),
    ("costs", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("kinds", pa.list_(pa.int32())), ("numbers", pa.list_(pa.int64())),
]
NAMES, TYPES = [n for n, _ in _FIELDS], [t for _, t in _FIELDS]
SCHEMA = (
    f"conv long, part int, seq long, closed boolean, {FACTS}, cost long, audit string, digest string, "
    "costs array<long>, roles array<string>, texts array<string>, kinds array<int>, numbers array<long>"
)
TRACED = f"conv long, part int, seq long, {FACTS}, cost array<long>, audit array<string>, state array<int>, written array<array<string>>"


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole conversations, last one first: each with the costs of what comes after it."""
    conv, ends, first = None, AT_END, True
    for batch in batches:
        after = []
        for own, table in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if first or own != conv:
                conv, ends, first = own, AT_END, False
            after.append(ends)
            ends = [min(min(table[4 * x + y] + ends[y] for y in range(4)), FAR) for x in range(4)]
        yield pa.record_batch([*batch.columns[:3], pa.array(after, pa.list_(pa.int64()))], ["conv", "part", "seq", "ends"])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every segment repaired from each of the four states."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            rows = [(r[:1], min(kind, GONE), n) for r, kind, n in zip(row["roles"], row["kinds"], row["numbers"], strict=True)]
            lattice = Lattice(rows, row["ends"])
            done, state = [], []
            for origin in range(4):
                edits = lattice.path(origin)
                done.append(_Written(edits, row["roles"], row["texts"]))
                state.append(origin if done[-1].state is None else done[-1].state)
            made = {"cost": lattice.price[:4], "audit": [x.audit for x in done], "state": state, "written": [x.lines for x in done]}
            yield pa.RecordBatch.from_pylist([row | made], schema=_TRACED)


_TRACED = pa.schema([(n, t) for n, t in _FIELDS if n in ("conv", "part", "seq") or n in SUMS or n in ("first_turn", "last_turn", "turns", "first_initial", "last_initial")] + [
    ("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string())), ("state", pa.list_(pa.int32())), ("written", pa.list_(pa.list_(pa.string()))),
])


def _strung(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Traced segments in order, as one row per conversation."""
    names = ["conv", *SUMS, "gaps", "cost", "audit", "digest"]
    types = [pa.int64(), *[pa.int64()] * 6, pa.string(), pa.string()]
    held: dict | None = None

    def whole() -> pa.RecordBatch:
        for line in _tail(held["state"]):
            add(line)
        gaps = 0 if held["low"] is None else held["high"] - held["low"] + 1 - held["turns"]
        values = [held["conv"], *[held[s] for s in SUMS], gaps, held["cost"], "".join(held["audit"]) + TAIL[held["state"]], held["digest"].hexdigest()]
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def add(line: str) -> None:
        held["digest"].update((("\n" if held["lines"] else "") + line).encode())
        held["lines"] += 1

    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if held is None or held["conv"] != row["conv"]:
                if held is not None:
                    yield whole()
                held = {"conv": row["conv"], **dict.fromkeys(SUMS, 0), "low": None, "high": None, "turns": 0, "initial": None, "cost": row["cost"][NONE], "state": NONE, "audit": [], "digest": hashlib.sha256(), "lines": 0}
            for s in SUMS:
                held[s] += row[s]
            if held["initial"] is not None and row["first_initial"] is not None:
                held["illegal"] += held["initial"] + row["first_initial"] not in LEGAL
            held["turns"] += row["turns"] - (row["first_turn"] is not None and row["first_turn"] == held["high"])
            if row["first_turn"] is not None:
                held["low"] = row["first_turn"] if held["low"] is None else held["low"]
                held["high"] = row["last_turn"]
            held["initial"] = row["last_initial"] if row["last_initial"] is not None else held["initial"]
            held["audit"].append(row["audit"][held["state"]])
            for line in row["written"][held["state"]]:
                add(line)
            held["state"] = row["state"][held["state"]]
    if held is not None:
        yield whole()


def damaged(frame: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with faults put in by a hash of (conversation, turn): conv, turn, role, text and their number, 0 where a row is dropped."""
    def or_space(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(or_space(F.col(key)), F.lit(":"), or_space(F.col(turn)))) % 20
    body = or_space(F.col(text))
    return frame.select(
        F.col(key).cast("long").alias("conv"),
        F.when(kind != 0, F.col(turn).cast("long")).alias("turn"),
        F.when(kind == 4, "user").when(kind != 0, or_space(F.col(role))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(body, "[.!?]", "")).when(kind != 0, body).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("number"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv, turn, role, text, number): counts of faults, cost, edits and digest.

    Rows of number 0 only say that there is such a conversation.
    """
    named = rows.select("conv", "turn", *[F.when(F.col("number") > 0, F.coalesce(c, F.lit(" "))).alias(c) for c in ("role", "text")], "number")
    single = stored(named.groupBy("conv", "turn", "role", "text").agg(F.sum("number").alias("number")), "rows")
    mark = [F.xxhash64("text").alias("low"), F.hash("text").alias("high")]
    keys = single.where("number > 0").select("conv", "turn", "role", *mark)
    order = F.struct(F.col("turn").isNotNull(), "turn")
    repeats = keys.groupBy("conv", "role", "low", "high").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeats = repeats.toDF("r_conv", "r_role", "r_low", "r_high", "first")
    same = F.col("conv").eqNullSafe(F.col("r_conv")) & (F.col("role") == F.col("r_role")) & (F.col("low") == F.col("r_low")) & (F.col("high") == F.col("r_high"))
    marked = single.select("*", *mark).join(repeats, same, "left")
    later = F.col("r_role").isNotNull() & (order != F.col("first"))
    trimmed = F.rtrim("text", F.lit(BLANKS))
    kind = F.when(trimmed == "", 3).when(later, 2).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0)
    marked = marked.select("conv", "turn", "role", "text", F.when(F.col("number") > 0, kind).otherwise(0).cast("int").alias("kind"), "number")
    dealt = marked.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 32))
    dealt = dealt.sortWithinPartitions("conv", "turn", "role", "text")
    size = SEGMENT
    segments = stored(dealt.mapInArrow(lambda batches: _segments(size, batches), SCHEMA), "segments")

    closed = segments.where("closed").select(
        "conv", *SUMS, F.when(F.col("first_turn").isNull(), 0).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).alias("gaps"),
        "cost", "audit", "digest",
    )
    spread = segments.where("NOT closed")
    prices = spread.select("conv", "part", "seq", "costs").repartition("conv")
    prices = prices.sortWithinPartitions("conv", F.desc("part"), F.desc("seq")).mapInArrow(_backwards, "conv long, part int, seq long, ends array<long>")
    traced = spread.join(prices.drop("conv"), ["part", "seq"]).select("conv", "part", "seq", *[c.split()[0] for c in FACTS.split(", ")], "roles", "texts", "kinds", "numbers", "ends")
    traced = traced.mapInArrow(_traced, TRACED).repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return closed.unionByName(traced.mapInArrow(_strung, "conv long, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string, digest string"))
