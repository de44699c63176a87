"""Packed prices, extended amounts and quantities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.text import ColumnOrName, _c

# Layout of the packed price text.
SCALE_START, SCALE_LENGTH = 1, 1
MANTISSA_START, MANTISSA_LENGTH = 7, 10
IMPLIED_DECIMALS = 2


def decode_vp(packed: ColumnOrName) -> Column:
    """Packed price to decimal: mantissa / 10^(scale + 2).  Blank or malformed text gives null."""
    text = _c(packed)
    scale = F.substring(text, SCALE_START, SCALE_LENGTH).try_cast("int")
    mantissa = F.substring(text, MANTISSA_START, MANTISSA_LENGTH).try_cast("decimal(10,0)")
    divisor = F.pow(F.lit(10), scale + IMPLIED_DECIMALS).cast("decimal(11,0)")
    return (mantissa / divisor).cast("decimal(18,4)")


def decode_vp_tail(packed: ColumnOrName) -> Column:
    """Variant with four fixed decimals in the last ten characters."""
    digits = F.right(_c(packed), F.lit(10)).try_cast("decimal(10,0)")
    return (digits / F.lit(10000).cast("decimal(5,0)")).cast("decimal(18,4)")


def decode_vendor_price(text: ColumnOrName) -> Column:
    """Variant of the vendor price list: eight digits from position five, two decimals."""
    digits = F.substring(_c(text), 5, 8).try_cast("decimal(10,0)")
    return (digits / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def extend(quantity: ColumnOrName, unit: ColumnOrName) -> Column:
    return _c(quantity).cast("decimal(14,0)") * _c(unit)


def net_of(amount: ColumnOrName, less: ColumnOrName) -> Column:
    """Difference of two quantities where a missing one counts as zero."""
    return F.coalesce(_c(amount), F.lit(0)) - F.coalesce(_c(less), F.lit(0))


def minutes(hours: ColumnOrName) -> Column:
    return _c(hours) * 60


def cost_with_fallback(current: ColumnOrName, standard: ColumnOrName) -> Column:
    return F.coalesce(_c(current), _c(standard), F.lit(0))


def total_of_present(*parts: ColumnOrName) -> Column:
    """Sum of the parts that are present; zero where none is."""
    total = F.coalesce(_c(parts[0]), F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(_c(part), F.lit(0))
    return total
