"""Rounding and exact units.

``round_to`` follows ``floor(|x| * 10^k + 0.5) / 10^k`` with the sign of x; unlike
``F.round`` it works on the binary value, so 1.005 stays below the tie. Sums of
prices and errors run over whole units of 10^-k (bigint), which makes them exact
and independent of the order in which partial aggregates merge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Digits kept when prices, errors and rates are summed.
FINE = 9
#: Sums of units run in two limbs, so that 10^15 values up to 1 fit them.
LIMB = 20


def finite(col: Column) -> Column:
    """NaN and infinities are no numbers to compute with: null."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def to_units(col: Column, digits: int, signed: bool = True) -> Column:
    # null for what no bigint holds. Truncation after stepping half a unit away from zero. Kept short, and shorter
    # for values known not to be negative, so that long select lists stay below the
    # method size up to which the JVM compiles generated code.
    half = F.signum(col) * F.lit(0.5) if signed else F.lit(0.5)
    return (col * F.lit(float(10**digits)) + half).try_cast("bigint")


def from_units(col: Column, digits: int) -> Column:
    return col / F.lit(float(10**digits))


def round_to(col: Column, digits: int, signed: bool = True) -> Column:
    return from_units(to_units(col, digits, signed), digits)


def exact_volume(col: Column) -> Column:
    """Volumes are summed as decimals: no overflow, no order dependence."""
    return col.try_cast("decimal(38,9)")


def sum_units(units: Column, name: str) -> list[Column]:
    """Exact sum of units as two columns, ``name`` and ``name_high``; both merge by addition."""
    return [
        F.sum(units.bitwiseAND((1 << LIMB) - 1)).alias(name),
        F.sum(F.shiftright(units, LIMB)).alias(f"{name}_high"),
    ]


def summed(name: str, kind: str = "double") -> Column:
    """The sum behind the columns of ``sum_units``: rounded once as a double, exact as a decimal(38,0)."""
    return F.col(f"{name}_high").cast(kind) * F.lit(1 << LIMB).cast(kind) + F.col(name).cast(kind)


def fixed(col: Column, digits: int) -> Column:
    """printf ``%.kf`` of a value rounded first, so no formatter breaks a tie."""
    return F.format_string(f"%.{digits}f", round_to(col, digits))


def signed_fixed(col: Column, digits: int) -> Column:
    return F.format_string(f"%+.{digits}f", round_to(col, digits))


def percent(col: Column, digits: int) -> Column:
    return F.concat(fixed(col * F.lit(100.0), digits), F.lit("%"))
