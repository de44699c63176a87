"""Personal data in texts: fixed patterns, and a linear-chain CRF over word shapes.

The patterns of four kinds (email, ip, card, phone) give the base spans.  A
conditional random field with B and I states per kind adds spans that the
patterns miss, such as numbers in local form; it never takes a base span away, and
of its spans those that meet a base span are left out.  It is trained from a small
labelled table, and decoded by Viterbi for all word sequences of a batch at once.
A sequence is a run of words of one line, each at most ``REACH`` words from a word
that holds a digit or an at sign; other words cannot be part of these kinds.

Null and empty texts give no spans.  Repeated rows give repeated results, other
columns are not read.  Texts are scanned whole, in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.text import Texts, column, slices

KINDS = ("email", "ip", "card", "phone")
STATES = ["O", *[f"{edge}-{kind}" for kind in KINDS for edge in "BI"]]
REACH = 2
LABELLED = Path(__file__).with_name("pii_labelled.txt")

# ---- base spans -----------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A digit run that fails at its start fails at every later digit as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the longest local part before it that no earlier match holds."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        free = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the pattern matches, by start and then kind in the order of ``KINDS``."""
    found = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    found += [
        (m.start(), 1, m.end()) for m in _IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    ]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.sub("", m[0])) <= 15]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


# ---- word shapes ----------------------------------------------------------

_CLASSES = np.zeros((256, 9), np.int32)
for _k, _members in enumerate(
    [b"0123456789", b"@", b".", b"+", b"()", b"-", b"=\"'_:", bytes([*range(65, 91), *range(97, 123), *range(128, 256)]), b"#$%&*!|/\\<>"]
):
    _CLASSES[list(_members), _k] = 1
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_TRIM = b".,;:!?*#$%&\"'|<>[]{}"
_TRIMMED = np.zeros(256, bool)
_TRIMMED[list(_TRIM)] = True
# Context words of the features, one number each.
CONTEXT = ["call", "phone", "tel", "mobile", "dial", "fax", "card", "visa", "karte", "tarjeta", "mail", "email", "server", "token", "version", "order", "isbn", "section", "pages", "id"]
_SIZES = (7, 5, 5, 3, 2, 2, 4, 2, 2)
SHAPES = int(np.prod(_SIZES))


@dataclass
class Tokens:
    """Words of sequences: byte ranges, shape, context word, and where sequences begin."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    shape: np.ndarray
    context: np.ndarray
    begins: np.ndarray


def tokens(texts: Texts) -> Tokens:
    """The words that may matter, cut into sequences."""
    data, none = texts.data, np.empty(0, np.int64)
    inside = ~_BLANK[data]
    strong = (data == 64) | ((data >= 48) & (data <= 57))
    if not strong.any():
        return Tokens(none, none, none, none, none, none)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[edges] = inside[edges]
    ends[edges[1:] - 1] = inside[edges[1:] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    marks = np.unique(np.searchsorted(start, np.flatnonzero(strong), "right") - 1)
    near = np.zeros(len(start), bool)
    for step in range(-REACH, REACH + 1):
        near[np.clip(marks + step, 0, len(start) - 1)] = True
    text = np.searchsorted(texts.offsets, start, "right") - 1
    lines = np.flatnonzero(data == 10)
    line = np.searchsorted(lines, start)
    # keep a word only if a marked one of its own line is in reach
    keep = np.flatnonzero(near)
    reach = np.zeros(len(keep), bool)
    marked = np.zeros(len(start), bool)
    marked[marks] = True
    for step in range(-REACH, REACH + 1):
        other = keep + step
        ok = (other >= 0) & (other < len(start))
        o, k = other[ok], keep[ok]
        reach[ok] |= marked[o] & (line[o] == line[k]) & (text[o] == text[k])
    keep = keep[reach]
    start, end, text, line = start[keep], end[keep], text[keep], line[keep]
    new = np.ones(len(keep), bool)
    new[1:] = (np.diff(keep) != 1) | (np.diff(line) != 0) | (np.diff(text) != 0)
    length = end - start
    cell = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
    counts = np.add.reduceat(_CLASSES[data[cell]], np.cumsum(length) - length) if len(keep) else np.empty((0, 9), np.int32)
    digit, at, dot, plus, bracket, dash, quote, letter, noise = counts.T
    size = np.searchsorted([2, 4, 6, 9, 12, 20], length, "right")
    share = np.where(digit == 0, 0, np.where(digit == length, 4, 1 + np.minimum(2, 3 * digit // np.maximum(1, length))))
    plain = np.where(dot > 3, 4, np.minimum(dot, 3))
    first = data[start] if len(keep) else np.empty(0, np.uint8)
    lead = np.where(first == 43, 2, np.where(first == 40, 1, 0))
    parts = (size, share, plain, lead, at > 0, bracket > 0, np.minimum(dash, 3), quote > 0, (letter > 0) & (digit > 0))
    shape = np.zeros(len(keep), np.int64)
    for count, part in zip(_SIZES, parts, strict=True):
        shape = shape * count + part
    raw = data.tobytes()
    known = {w.encode(): i + 1 for i, w in enumerate(CONTEXT)}
    context = np.array([known.get(raw[a:b].strip(_TRIM + b"=").lower(), 0) if b - a < 12 else 0 for a, b in zip(start, end, strict=True)], np.int64)
    return Tokens(start, end, text, shape, context, np.flatnonzero(new))


# ---- the model ------------------------------------------------------------


def _features() -> np.ndarray:
    """Of every shape, the numbers of its active features."""
    rest = np.arange(SHAPES)
    columns = []
    for size in reversed(_SIZES):
        columns.append(rest % size)
        rest = rest // size
    offsets = np.cumsum([0, *_SIZES[:-1]])
    return np.stack(columns[::-1], axis=1) + offsets


@dataclass
class Model:
    """Scores of a state by shape and context word at distance -1, 0 and 1, and of transitions."""

    shape: np.ndarray  # [3, SHAPES, states]
    context: np.ndarray  # [3, words, states]
    step: np.ndarray
    first: np.ndarray


def _shifted(values: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values before, at and after each position of its own sequence; -1 outside."""
    before, after = np.full(len(values), -1), np.full(len(values), -1)
    before[1:], after[:-1] = values[:-1], values[1:]
    before[begins], after[begins[1:] - 1] = -1, -1
    return before, values, after


def emissions(model: Model, words: Tokens) -> np.ndarray:
    out = np.zeros((len(words.shape), len(STATES)))
    for weights, values in ((model.shape, words.shape), (model.context, words.context)):
        for k, own in enumerate(_shifted(values, words.begins)):
            out += np.where(own[:, None] >= 0, weights[k][own], 0)
    return out


def viterbi(model: Model, score: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Best states of all sequences: one step moves every sequence that is long enough."""
    best = np.zeros(len(score), np.int64)
    if not len(score):
        return best
    length = np.diff([*begins, len(score)])
    order = np.argsort(-length, kind="stable")
    begins, length = begins[order], length[order]
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length[0]) + 1)]  # sequences longer than t
    back = np.zeros(score.shape, np.int8)
    now = score[begins] + model.first
    for t in range(1, int(length[0])):
        n = active[t]
        paths = now[:n, :, None] + model.step
        at = begins[:n] + t
        back[at] = paths.argmax(axis=1)
        now[:n] = paths.max(axis=1) + score[at]
    state = now.argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        n = active[t]
        at = begins[:n] + t
        best[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return best


def read_labelled(path: Path = LABELLED) -> list[str]:
    return [x for x in path.read_text().splitlines() if x and not x.startswith("#")]


def train(sentences: list[str], rounds: int = 200, rate: float = 0.3, penalty: float = 0.02) -> Model:
    """Maximum likelihood with a quadratic penalty, by adaptive gradient steps."""
    texts, wanted = [], []
    for sentence in sentences:
        plain, spans = "", []
        for part in re.split(r"(\{\w+\|[^}]*\})", sentence):
            if part.startswith("{"):
                kind, _, part = part[1:-1].partition("|")
                spans.append((len(plain.encode()), len((plain + part).encode()), KINDS.index(kind)))
            plain += part
        texts.append(plain)
        wanted.append(spans)
    words = tokens(column(pa.array(texts)))
    offsets = column(pa.array(texts)).offsets
    state = np.zeros(len(words.start), np.int64)
    for i, (a, b, t) in enumerate(zip(words.start, words.end, words.text, strict=True)):
        for start, end, kind in wanted[t]:
            if a - offsets[t] < end and b - offsets[t] > start:
                state[i] = 1 + 2 * kind + (a - offsets[t] > start)
    table, s = _features(), len(STATES)
    width, length = table.max() + 1, np.diff([*words.begins, len(state)])
    model = Model(np.zeros((3, SHAPES, s)), np.zeros((3, len(CONTEXT) + 1, s)), np.zeros((s, s)), np.zeros(s))
    weights = [np.zeros((3, width, s)), model.context, model.step, model.first]
    pace = [np.full(w.shape, 1e-6) for w in weights]
    shapes, contexts = _shifted(words.shape, words.begins), _shifted(words.context, words.begins)
    for _ in range(rounds):
        model.shape = weights[0][:, table].sum(axis=2)
        score = emissions(model, words)
        gradient = [-penalty * w for w in weights]
        surplus = np.zeros_like(score)
        for begin, n in zip(words.begins, length, strict=True):
            own, truth = score[begin : begin + n], state[begin : begin + n]
            forward, backward = np.zeros((n, s)), np.zeros((n, s))
            forward[0] = own[0] + model.first
            for t in range(1, n):
                forward[t] = np.logaddexp.reduce(forward[t - 1][:, None] + model.step, axis=0) + own[t]
            for t in range(n - 2, -1, -1):
                backward[t] = np.logaddexp.reduce(model.step + own[t + 1] + backward[t + 1], axis=1)
            total = np.logaddexp.reduce(forward[-1])
            surplus[begin : begin + n] = -np.exp(forward + backward - total)
            surplus[np.arange(begin, begin + n), truth] += 1
            gradient[3] += surplus[begin]
            for t in range(1, n):
                gradient[2] -= np.exp(forward[t - 1][:, None] + model.step + own[t] + backward[t] - total)
                gradient[2][truth[t - 1], truth[t]] += 1
        for k in range(3):
            has = shapes[k] >= 0
            np.add.at(gradient[0][k], table[shapes[k][has]], surplus[has][:, None])
            np.add.at(gradient[1][k], contexts[k][has], surplus[has])
        for weight, slope, seen in zip(weights, gradient, pace, strict=True):
            seen += slope**2
            weight += rate * slope / np.sqrt(seen)
    model.shape = weights[0][:, table].sum(axis=2)
    model.step[0, 2::2] = model.first[2::2] = -50.0  # nothing begins inside
    for kind in range(len(KINDS)):
        other = [x for x in range(1, s) if (x - 1) // 2 != kind]
        model.step[other, 2 + 2 * kind] = -50.0
    return model


def added_spans(model: Model, texts: Texts) -> list[list[tuple[int, str, int]]]:
    """Of each text the model's spans in bytes, trimmed of outer punctuation."""
    words = tokens(texts)
    found: list[list[tuple[int, str, int]]] = [[] for _ in range(len(texts))]
    best = viterbi(model, emissions(model, words), words.begins)
    starts = np.flatnonzero(best % 2 == 1)
    for i in starts:
        last = i
        while last + 1 < len(best) and best[last + 1] == best[i] + 1 and words.text[last + 1] == words.text[i]:
            last += 1
        a, b = int(words.start[i]), int(words.end[last])
        while a < b and _TRIMMED[texts.data[a]]:
            a += 1
        while b > a and _TRIMMED[texts.data[b - 1]]:
            b -= 1
        if a < b:
            zero = int(texts.offsets[words.text[i]])
            found[words.text[i]].append((a - zero, KINDS[(best[i] - 1) // 2], b - zero))
    return found


SCHEMA = "array<struct<kind:string, start:int, end:int, base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def spans_of(model: Model, array: pa.Array) -> list[list[tuple]]:
    """Base and added spans of each text, by start and then kind; positions in code points."""
    texts = column(array)
    weak = np.cumsum(np.concatenate([[0], (texts.data == 64) | ((texts.data >= 48) & (texts.data <= 57))]))
    some = weak[texts.offsets[1:]] > weak[texts.offsets[:-1]]
    added = added_spans(model, texts)
    out: list[list[tuple]] = []
    for i in range(len(texts)):
        if not some[i]:
            out.append([])
            continue
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
        base = base_spans(raw.tobytes().decode("utf-8", "replace"))
        own = [(start, kind, end, True) for start, kind, end in base]
        if added[i]:
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            taken = np.array([(start, end) for start, _, end in base], np.int64).reshape(-1, 2)
            for a, kind, b in added[i]:
                start, end = int(points[a]), int(points[b])
                if not ((taken[:, 0] < end) & (taken[:, 1] > start)).any():
                    own.append((start, kind, end, False))
        out.append(sorted(own, key=lambda x: (x[0], KINDS.index(x[1]))))
    return out


def find(frame: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``spans`` of every row."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [[dict(zip(("start", "kind", "end", "base"), x, strict=True)) for x in own] for own in spans_of(shared.value, part.column(1))]
                yield pa.record_batch([part.column(0), pa.array(rows, _ARROW)], ["key", "spans"])

    picked = frame.selectExpr(f"`{key}` AS key", f"CAST(`{text}` AS STRING) AS text")
    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(run, f"key {kind}, spans {SCHEMA}").withColumnRenamed("key", key)
