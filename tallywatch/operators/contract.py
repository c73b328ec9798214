"""Typed contract, quality rules and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.rules import HARD_RULES, SOFT_RULES, failed_names, fails, holds, passes

# Fields of the feed and the type each has in the clean table.
CONTRACT = {
    "transaction_id": "string",
    "event_ts": "timestamp",
    "customer_id": "string",
    "merchant_id": "string",
    "merchant_category": "string",
    "amount": "double",
    "currency": "string",
    "country": "string",
    "device_id": "string",
    "channel": "string",
    "is_fraud": "int",
    "fraud_type": "string",
}
LINEAGE = ("_source_file", "_ingested_at")
SILVER_COLUMNS = (*CONTRACT, *LINEAGE)

BRONZE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in CONTRACT]
    + [
        T.StructField("_rescued_data", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)


def typed(df: DataFrame) -> DataFrame:
    """Cast contract fields; a value that does not fit becomes null, never an error."""
    casts = {name: F.col(name).try_cast(kind) for name, kind in CONTRACT.items() if kind != "string"}
    return df.withColumns({name: cast for name, cast in casts.items() if name in df.columns})


def valid_rows(df: DataFrame, rules: dict[str, str] = HARD_RULES) -> DataFrame:
    return df.where(passes(rules))


def quarantine(df: DataFrame, rules: dict[str, str] = HARD_RULES) -> DataFrame:
    """Rows that fail at least one rule, with the reasons. Duplicates are kept."""
    return df.where(fails(rules)).withColumn("_quarantine_reason", failed_names(rules))


def expectation_metrics(
    df: DataFrame,
    hard: dict[str, str] = HARD_RULES,
    soft: dict[str, str] = SOFT_RULES,
) -> DataFrame:
    """Passed and failed row counts per rule, all rules in one pass."""
    rules = [(name, "hard", rule) for name, rule in hard.items()]
    rules += [(name, "soft", rule) for name, rule in soft.items()]
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(holds(rule)).alias(name) for name, _, rule in rules],
    )
    per_rule = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(kind).alias("severity"),
                F.col(name).alias("passed_rows"),
                (F.col("rows") - F.col(name)).alias("failed_rows"),
            )
            for name, kind, _ in rules
        ]
    )
    return counts.select(F.inline(per_rule))
