"""Running totals over ranges of many groups, without one window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sums_before(totals: DataFrame, keys: list[str], position: str, values: list[str], positions: int, fanout: int = 1000) -> DataFrame:
    """Add ``<value>_above`` for every value: the sum over smaller positions of the same keys.

    Positions are numbers below ``positions``, each at most once per key; keys are not null. They are cut into
    runs of ``fanout``; a run's totals are rows of the next level, until one run is left. A
    window never holds more than ``fanout`` rows, and with ``n`` positions there are
    log(n) / log(fanout) levels.
    """
    run = f"_{position}"
    rows = totals.withColumn(run, F.floor(F.col(position) / fanout).cast("long"))
    before = Window.partitionBy(*keys, run).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select("*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}_above") for v in values])
    if positions <= fanout:
        return inside.drop(run)
    runs = rows.groupBy(*keys, run).agg(*[F.sum(v).alias(v) for v in values])
    above = sums_before(runs, keys, run, values, -(-positions // fanout), fanout)
    offsets = above.select(*keys, run, *[F.col(f"{v}_above").alias(f"_{v}_runs") for v in values])
    # the window has dealt the rows by the columns of this join
    added = {f"{v}_above": F.col(f"{v}_above") + F.col(f"_{v}_runs") for v in values}
    return inside.join(offsets, [*keys, run]).withColumns(added).drop(run, *[f"_{v}_runs" for v in values])
