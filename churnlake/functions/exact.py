"""Sums of doubles that do not depend on the order of additions.

A double is split into whole-number limbs of 24 bits, from 2**80 down to 2**-64. Limbs are added
as integers, which is exact in any order and partitioning, and the total is rounded to a double
once. Bits below 2**-64 are rounded off value by value; where a value reaches 2**80 or is not
finite, the plain sum stands in. A limb's sum has room for 2**38 values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS, LIMBS, LOWEST = 24, 6, -64
_LIMIT = 2.0 ** (LOWEST + BITS * LIMBS)
_MASK = (1 << BITS) - 1


def limbs(value: Column) -> list[Column]:
    """Limbs of a double, lowest first, as bigints; null for null, zeros beyond the range."""
    x = value.cast("double")
    safe = F.when(F.abs(x) < _LIMIT, x).when(x.isNotNull(), 0.0)
    scaled = [F.rint(safe * F.lit(2.0 ** -(LOWEST + BITS * j))) for j in range(LIMBS)]
    out = [scaled[j] - scaled[j + 1] * F.lit(2.0**BITS) for j in range(LIMBS - 1)]
    return [c.cast("bigint") for c in [*out, scaled[-1]]]


def rounded(sums: Sequence[Column]) -> Column:
    """The double nearest to the number whose limbs (lowest first) add up to ``sums``."""
    carried = [sums[0]]
    for j in range(1, LIMBS):
        carried.append(sums[j] + F.shiftright(carried[-1], BITS))
    low, mid, high = (
        (upper * (1 << BITS) + carried[j].bitwiseAND(F.lit(_MASK))).cast("double")
        * F.lit(2.0 ** (LOWEST + BITS * j))
        for j, upper in ((0, carried[1].bitwiseAND(F.lit(_MASK))),
                         (2, carried[3].bitwiseAND(F.lit(_MASK))), (4, carried[5]))
    )
    # the high part is zero or the larger one, so this is the error of its sum with the middle one
    top = high + mid
    return top + ((mid - (top - high)) + low)


def exact_sum(value: Column) -> Column:
    """An aggregate: the sum, rounded once."""
    x = value.cast("double")
    plain = F.max(F.abs(x)) >= F.lit(_LIMIT)          # NaN counts as large
    return F.when(plain, F.sum(x)).otherwise(rounded([F.sum(c) for c in limbs(value)]))


def exact_avg(value: Column) -> Column:
    """An aggregate: the mean of the values that are not null, from the exact sum."""
    return F.try_divide(exact_sum(value), F.count(value))


def limb_sums(value: Column, name: str) -> list[Column]:
    """Aggregates for a fold that is folded again: limb sums and the greatest size."""
    return [*[F.sum(c).alias(f"{name}_l{j}") for j, c in enumerate(limbs(value))],
            F.max(F.abs(value.cast("double"))).alias(f"{name}_most"),
            F.sum(value.cast("double")).alias(f"{name}_plain")]


def refolded(name: str, within: Column | None = None) -> Column:
    """An aggregate over ``limb_sums`` columns: the exact sum of what they were made of."""

    def only(column: str) -> Column:
        return F.col(column) if within is None else F.when(within, F.col(column))

    whole = rounded([F.sum(only(f"{name}_l{j}")) for j in range(LIMBS)])
    return F.when(F.max(only(f"{name}_most")) >= F.lit(_LIMIT),
                  F.sum(only(f"{name}_plain"))).otherwise(whole)
