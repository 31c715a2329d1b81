"""Amounts: cents to units, signs, and the German decimal notation of ledger files."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "decimal(20,2)"
UNITS = "decimal(24,6)"
LEDGER = "decimal(20,2)"

# Fixed value: charges that are stored with the opposite sign.
INVERTED_GLID = r"^(?:OVERPAYMENT.CREDIT|.*.MANUAL.BONUS)$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def units(cents: Column | str) -> Column:
    """Cents as exact currency units (a product, so never a double)."""
    return (_col(cents).cast(CENTS) * F.lit(Decimal("0.01"))).cast(UNITS)


def charge_sign(glid: Column | str) -> Column:
    """-1 for charge types kept with inverted sign, else 1."""
    return F.when(_col(glid).rlike(INVERTED_GLID), F.lit(-1)).otherwise(F.lit(1))


def sign_or_one(total: Column) -> Column:
    """-1 for a negative total, otherwise 1 (also for null and zero)."""
    return F.when(total < 0, F.lit(-1)).otherwise(F.lit(1))


def sign_or_zero(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value < 0, F.lit(-1)).when(value > 0, F.lit(1)).otherwise(F.lit(0))


def german_decimal(cents: Column | str) -> Column:
    """Absolute cents as ``12,30``."""
    whole = (F.abs(_col(cents)).cast(CENTS) * F.lit(Decimal("0.01"))).cast(LEDGER)
    return F.replace(whole.cast("string"), F.lit("."), F.lit(","))


def parse_german_decimal(text: Column | str) -> Column:
    """``12,30`` as a number; anything unparsable becomes null."""
    return F.replace(_col(text), F.lit(","), F.lit(".")).try_cast(LEDGER)
