"""Column helpers for keys, flags and texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(column: ColumnOrName) -> Column:
    return F.col(column) if isinstance(column, str) else column


def norm_key(column: ColumnOrName) -> Column:
    """Trimmed key; null and blank are the same key value ``''``."""
    return F.trim(F.coalesce(_c(column).cast("string"), F.lit("")))


def blank_to_null(column: ColumnOrName) -> Column:
    return F.nullif(F.trim(_c(column)), F.lit(""))


def is_pending(column: ColumnOrName) -> Column:
    """A pending item carries the marker ``#`` at the end of its id."""
    return F.trim(_c(column)).endswith("#")


def strip_pending(column: ColumnOrName) -> Column:
    return F.replace(F.trim(_c(column)), F.lit("#"), F.lit(""))


def describe(*parts: ColumnOrName, sep: str = " ") -> Column:
    """Join description parts; a missing part counts as empty text, never as null."""
    filled = [F.coalesce(_c(p), F.lit("")) for p in parts]
    joined: list[Column] = []
    for part in filled:
        joined += [F.lit(sep), part] if joined else [part]
    return F.trim(F.concat(*joined))


def composite_id(left: ColumnOrName, seq: ColumnOrName, width: int = 4) -> Column:
    """``customer-0007``: an id and a zero-padded sequence number."""
    return F.concat(_c(left), F.lit("-"), F.lpad(_c(seq).cast("string"), width, "0"))


def flag_if(condition: Column, yes: str = "Y", no: str | None = "N") -> Column:
    """Two-valued flag; an unknown condition counts as not met."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def material_flag(comment: ColumnOrName) -> Column:
    """``Y`` where the comment mentions a material shortage, else ``N`` (also without comment)."""
    return flag_if(_c(comment).ilike("%#MO%"))


def ship_complete_flag(note: ColumnOrName) -> Column:
    """``Y`` where the note asks for one complete shipment of the order, else null."""
    text = _c(note)
    return flag_if(text.ilike("%SHIP%COMPLETE%") & ~text.ilike("%LINE%"), no=None)


def first_column(df: DataFrame, names: Sequence[str], default: str | None = None) -> Column:
    """First non-null value among those of ``names`` that ``df`` has, ignoring case."""
    actual = {c.lower(): c for c in df.columns}
    found = [F.col(f"`{actual[n.lower()]}`") for n in names if n.lower() in actual]
    if not found and default is None:
        raise ValueError(f"none of the columns {list(names)} exists")
    if default is not None:
        found.append(F.lit(default))
    return F.coalesce(*found)


def case_map(column: ColumnOrName, rules: Mapping[object, object], default: Column | object = None) -> Column:
    """Code to label.  The first rule that equals the code wins."""
    value = _c(column)
    expr: Column | None = None
    for code, label in rules.items():
        expr = F.when(value == F.lit(code), F.lit(label)) if expr is None else expr.when(value == F.lit(code), F.lit(label))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def first_rule(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules (condition, result): the first condition that holds decides."""
    (condition, result), *rest = rules
    expr = F.when(condition, result if isinstance(result, Column) else F.lit(result))
    for condition, result in rest:
        expr = expr.when(condition, result if isinstance(result, Column) else F.lit(result))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def canonical(sources: Mapping[str, Column], unavailable: str = "UNAVAILABLE") -> tuple[Column, Column]:
    """Value by source priority, and the name of the source it came from."""
    value = F.coalesce(*sources.values())
    winner = first_rule([(c.isNotNull(), name) for name, c in sources.items()], unavailable)
    return value, winner
