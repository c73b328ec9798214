"""Column expressions used by several operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_round(value: Column, digits: int) -> Column:
    """Half-up rounding that ignores the last-bit noise of a float sum.

    Partial sums arrive in any order, so a double aggregate may differ in its
    last bits between runs; a value near a rounding boundary would then flip.
    Values too large for the decimal are rounded as doubles.
    """
    exact = F.round(value.try_cast("decimal(38,8)"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def tie_key(transaction_id: Column) -> Column:
    """Order of rows inside one second.

    The first 60 bits of a hash, so that its leading bits split a crowded second
    evenly and in order.
    """
    return F.conv(F.substring(F.md5(transaction_id), 1, 15), 16, 10).cast("long")


def tie_slice(tie: Column, bits: int) -> Column:
    """The leading bits of a tie key."""
    return F.shiftright(tie, 60 - bits)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def bin_edges(bins: int) -> list[float]:
    """Edges of equal bins on [0, 1]; multiples of the step, the last one exactly 1."""
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def bin_index(score: Column, bins: int) -> Column:
    """Bin of a score in [0, 1], last bin closed; null outside (not counted)."""
    inner = bin_edges(bins)[1:-1]
    position = reduce(lambda a, b: a + b, [(score >= F.lit(e)).cast("int") for e in inner])
    return F.when((score >= 0.0) & (score <= 1.0), position)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
