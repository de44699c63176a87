"""Check statements for the registered queries.

``oracle/queries.sql`` holds one independent SQL statement per query, and
``oracle/models.sql`` the tables those statements share.  A statement names the
derived captures freely; the ones it needs are put in front of it as common
table expressions.
"""

from __future__ import annotations

import re
from pathlib import Path

from ledgermill.sources.erp import TABLES

FOLDER = Path(__file__).resolve().parent.parent / "oracle"
_NAME = re.compile(r"^-- name: (\w+)\s*$", re.MULTILINE)
_HINT = re.compile(r"^-- (double|text|bigint): (.+)$", re.MULTILINE)
_TYPES = {"double": "DOUBLE", "text": "VARCHAR", "bigint": "BIGINT"}


def blocks(file: str) -> dict[str, str]:
    parts = _NAME.split((FOLDER / file).read_text())[1:]
    return {name: body.strip().rstrip(";") for name, body in zip(parts[::2], parts[1::2])}


def _words(sql: str) -> set[str]:
    return set(re.findall(r"\w+", sql))


def _bare(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def compose(body: str, shared: dict[str, str]) -> str:
    """Put the shared tables a statement needs in front of it, in dependency order."""
    ordered: list[str] = []

    def need(sql: str, seen: tuple[str, ...]) -> None:
        for name in sorted(_words(sql) & shared.keys()):
            if name not in ordered and name not in seen:
                need(shared[name], (*seen, name))
                ordered.append(name)

    need(body, ())
    ctes = ",\n".join(f"{name} AS (\n{shared[name]}\n)" for name in ordered)
    if not ordered:
        return body
    if body.upper().startswith("WITH"):
        body = f"SELECT * FROM (\n{body}\n)"
    return f"WITH {ctes}\n{body}"


def _typed(body: str) -> str:
    """Wrap the statement in the casts its ``-- double: a, b`` comments ask for."""
    casts = [
        f"CAST({column.strip()} AS {_TYPES[kind]}) AS {column.strip()}"
        for kind, columns in _HINT.findall(body)
        for column in columns.split(",")
    ]
    body = _HINT.sub("", body).strip()
    if not casts:
        return body
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{body}\n)"


def statements() -> dict[str, str]:
    shared = {name: _bare(sql).strip() for name, sql in TABLES.items()}
    shared |= blocks("models.sql")
    return {name: compose(_typed(body), shared) for name, body in blocks("queries.sql").items()}
