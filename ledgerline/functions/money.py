"""Exact money arithmetic on columns that hold amounts as binary floats.

Adding doubles gives a result that depends on the order in which shuffled
blocks arrive. Where the caller states how many digits the stored amounts have
(``scale``), they are therefore summed as whole minor units: the result is exact and
the same on every run and after every task retry. An amount that is not whole
at the stated scale is an error, never rounded. Totals are kept in two halves,
both ``bigint``, which stay inside whole-stage code generation and are put together
as ``decimal(38,0)``; a half that would leave its range raises, with ANSI mode on or off.

Without a scale (the default) totals and means are ordinary double aggregates.

NaN counts as missing, like null, in units, totals and means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ColumnOrName = Column | str

_HALF = 20  # bits of the lower half: 2**43 rows of any amount fit its total
_LIMB = 27  # bits of the lower limb of a number that is squared
_WIDE = DecimalType(38, 0)


def _column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _present(value: ColumnOrName) -> Column:
    amount = _column(value).cast("double")
    return F.when(~F.isnan(amount), amount)


def units(value: ColumnOrName, scale: int) -> Column:
    """Amount with at most ``scale`` stored digits as a whole number of units.

    Exact while the amount has at most 15 significant digits, as a double must. An
    amount with more digits than ``scale`` raises.
    """
    scaled = _present(value) * F.lit(float(10**scale))
    whole = F.rint(scaled)
    stored = F.abs(scaled - whole) <= F.greatest(F.lit(1e-6), F.abs(scaled) * F.lit(1e-14))
    wrong = F.raise_error(F.concat(F.lit(f"not whole at {scale} digits: "), _column(value).cast("string")))
    return F.when(scaled.isNull() | stored, whole.cast("bigint")).otherwise(wrong.cast("bigint"))


def exact_total(whole: ColumnOrName) -> Column:
    """Aggregate: total of a bigint column as ``decimal(38,0)``; null without values."""
    number = _column(whole)
    high = F.try_sum(F.shiftright(number, _HALF)).cast(_WIDE)
    low = F.try_sum(number.bitwiseAND(F.lit(2**_HALF - 1).cast("bigint"))).cast(_WIDE)
    total = (high * F.lit(2**_HALF).cast(DecimalType(7, 0)) + low).cast(_WIDE)
    too_large = F.raise_error(F.lit("a total leaves its range")).cast(_WIDE)
    return F.when(F.count(number) > 0, F.coalesce(total, too_large))


def from_units(value: ColumnOrName, scale: int) -> Column:
    """Whole units back to a double amount."""
    return _column(value).cast("double") / F.lit(float(10**scale))


def units_total(value: ColumnOrName, scale: int | None = None) -> Column:
    """Aggregate: total of an amount column as a double, exact at a stated ``scale``."""
    if scale is None:
        return F.sum(_present(value))
    return from_units(exact_total(units(value, scale)), scale)


def units_mean(value: ColumnOrName, scale: int | None = None) -> Column:
    """Aggregate: mean of an amount column, from its exact total at a stated ``scale``."""
    if scale is None:
        return F.avg(_present(value))
    whole = units(value, scale)
    return exact_total(whole).cast("double") / F.count(whole) / F.lit(float(10**scale))


def exact_squares(whole: ColumnOrName) -> Column:
    """Aggregate: total of the squares of a bigint column as ``decimal(38,0)``; null without values.

    A number below 2**53 in size is split into two limbs. Each of the limbs' three products, below
    2**55, is summed in three parts of 20 bits, which fit for 2**43 rows, so the result is exact whatever the order of
    rows and partitions. A total beyond 38 digits raises.
    """
    number = _column(whole)
    high = F.shiftright(number, _LIMB)
    low = number.bitwiseAND(F.lit(2**_LIMB - 1).cast("bigint"))

    def total(product: Column, bits: int) -> Column:
        mask = F.lit(2**_HALF - 1).cast("bigint")
        parts = [product.bitwiseAND(mask), F.shiftright(product, _HALF).bitwiseAND(mask), F.shiftright(product, 2 * _HALF)]
        weighted = [
            F.try_multiply(F.try_sum(part).cast(_WIDE), F.lit(str(2 ** (bits + i * _HALF))).cast(_WIDE))
            for i, part in enumerate(parts)
        ]
        return F.try_add(F.try_add(weighted[0], weighted[1]), weighted[2])

    squares = F.try_add(F.try_add(total(high * high, 2 * _LIMB), total(high * low, _LIMB + 1)), total(low * low, 0))
    too_large = F.raise_error(F.lit("a total leaves its range")).cast(_WIDE)
    return F.when(F.count(number) > 0, F.coalesce(squares.cast(_WIDE), too_large))


def units_deviation(value: ColumnOrName, scale: int) -> Column:
    """Aggregate: sample standard deviation of an amount column with ``scale`` stored digits; null below two values.

    Worked out from the exact totals of units and of their squares: the sum of squared distances from the
    whole part of the mean is exact, and only the last division and the root are rounded. So it is the same bit
    for bit on every run and under any partitioning.
    """
    whole = units(value, scale)
    n = F.count(whole)
    total, squares = exact_total(whole), exact_squares(whole)
    count = n.cast(DecimalType(18, 0))
    middle = F.call_function("div", total, F.when(n > 0, count)).cast(DecimalType(18, 0))
    rest = (total - (middle * count).cast(_WIDE)).cast(DecimalType(18, 0))
    spread = (squares - (middle * F.lit(2).cast(DecimalType(1, 0)) * total).cast(_WIDE) + (middle * middle * count).cast(_WIDE)).cast(_WIDE)
    # n * spread - rest**2 is exact while it has 38 digits; beyond, the second term is far below rounding.
    exact = F.try_multiply(spread, count.cast(_WIDE)) - (rest * rest).cast(_WIDE)
    about = spread.cast("double") * n - rest.cast("double") * rest.cast("double")
    variance = F.coalesce(exact.cast("double"), about) / n / (n - 1)
    return F.when(n > 1, F.sqrt(variance) / F.lit(float(10**scale)))


def as_money(value: ColumnOrName, precision: int = 20, scale: int = 6) -> Column:
    """Amount as a decimal, for row-level products that are rounded afterwards."""
    return _column(value).cast(DecimalType(precision, scale))


def _factor(share: str) -> Column:
    return F.lit(share).cast(DecimalType(7, 4))


def share_of(value: ColumnOrName, share: str, digits: int = 2) -> Column:
    """``round(value * share, digits)`` without binary half-cent errors.

    ``share`` is decimal text such as ``"0.10"``.
    """
    return F.round(as_money(value) * _factor(share), digits).cast("double")


def raised_by(value: ColumnOrName, share: str, digits: int = 2) -> Column:
    """``round(value + value * share, digits)`` in the same way."""
    money = as_money(value)
    return F.round(money + money * _factor(share), digits).cast("double")
