"""One row per transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.rules import HARD_RULES
from tallywatch.operators.contract import SILVER_COLUMNS, typed, valid_rows


def first_arrivals(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key.

    The filter on the rank lets Spark keep one row per key and map task before
    the shuffle, so a key with very many copies does not fill one reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_arrival", rank).where("_arrival = 1").drop("_arrival")


def silver(
    bronze: DataFrame,
    rules: dict[str, str] = HARD_RULES,
    arrival: list[Column] | None = None,
    validate_first: bool = True,
) -> DataFrame:
    """Typed, valid, deduplicated rows from the whole of Bronze.

    ``validate_first=False`` deduplicates before the rules, so an invalid first
    copy takes the valid later copy with it.
    """
    if arrival is None:
        arrival = [F.col("_ingested_at"), F.col("_source_file"), F.col("amount"), F.col("event_ts")]
    rows = typed(bronze)
    if validate_first:
        kept = first_arrivals(valid_rows(rows, rules), ["transaction_id"], arrival)
    else:
        kept = valid_rows(first_arrivals(rows, ["transaction_id"], arrival), rules)
    return kept.select(*[c for c in SILVER_COLUMNS if c in kept.columns])
