"""Casts that follow the mart's typing rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webmart.functions.paths import strip_space

# Amounts below the first bound add up exactly to 15 decimals. Those from it to the second have seven digits at most behind
# the point, as a double has 17 in all, so nothing is cut off.
_SMALL, _FINE = 1e9, "decimal(27,15)"
_LARGE, _COARSE = 1e25, "decimal(32,7)"


def to_whole(text: Column) -> Column:
    """Text to bigint: ``'7'`` and ``'7.0'`` give 7; anything that is no whole number gives NULL."""
    number = text.try_cast("double")
    return F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def to_day(text: Column) -> Column:
    return F.try_to_date(text)


def to_flag(text: Column) -> Column:
    """Text to boolean: only ``true`` and ``false``, in any case; all else gives NULL."""
    word = F.lower(strip_space(text))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def rounded(number: Column) -> Column:
    """Number to bigint, halves away from zero (a plain cast would cut the fraction off)."""
    return F.round(number).cast("bigint")


def count_where(condition: Column) -> Column:
    """Rows that meet a condition; unlike ``count_if`` it adds no helper column below the aggregation."""
    return F.count(F.when(condition, F.lit(1)))


def amount_sums(amount: Column) -> list[Column]:
    """Sums of doubles by size, which can be added up again and put together with :func:`added`.

    Amounts below 1e25 are summed as decimals with all their digits, so the order of the rows, hence the partitioning, does
    not matter. Larger ones, infinities and NaN stay doubles: they show in the total instead of vanishing from it.
    """
    size = F.abs(amount)
    return [
        F.sum(F.when(size < _SMALL, amount.try_cast(_FINE))),
        F.sum(F.when((size >= _SMALL) & (size < _LARGE), amount.try_cast(_COARSE))),
        F.sum(F.when(size >= _LARGE, amount)),
    ]


def added(sums: list[Column]) -> Column:
    """The total of :func:`amount_sums`; NULL where there was no amount."""
    parts = [part.cast("double") for part in sums]
    fine, coarse, rest = (F.coalesce(part, F.lit(0.0)) for part in parts)
    return F.when(F.coalesce(*parts).isNotNull(), fine + coarse + rest)


def exact_sum(amount: Column) -> Column:
    return added(amount_sums(amount))
