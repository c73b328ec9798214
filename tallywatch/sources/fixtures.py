"""Card transactions derived from the provided tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.expressions import stable_round
from tallywatch.operators.dedup import first_arrivals
from tallywatch.session import prepare

INGESTED_AT = "2024-02-01 00:00:00"
CLICKS = ("click", "view", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _every(modulus: int, remainder: int) -> Column:
    return F.pmod(F.col("event_id"), F.lit(modulus)) == remainder


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows with injected defects and duplicates, one per feed line."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    fraud = (F.col("event_type") == "error") & (F.col("value") >= 150)
    # Kinds of fraud.
    kinds = ("card_testing", "account_takeover", "merchant_collusion")
    kind = F.element_at(F.array(*[F.lit(name) for name in kinds]), (k % 3) + 1)
    copies = F.when(_every(211, 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return events.select(
        F.col("event_id"),
        F.explode(copies).alias("copy_no"),
        F.to_date("ts").alias("feed_date"),
        _unless(_every(419, 6), F.col("event_id").cast("string")).alias("transaction_id"),
        _unless(_every(401, 4), F.col("ts").cast("string")).alias("event_ts"),
        _unless(_every(409, 5), F.concat(F.lit("C"), F.col("user_id"))).alias("customer_id"),
        _unless(_every(251, 1), F.concat(F.lit("M"), k)).alias("merchant_id"),
        _unless(_every(251, 1), F.concat(F.lit("cat"), k % 10)).alias("merchant_category"),
        F.when(_every(337, 3), "N/A")
        .when(_every(331, 2), (-F.col("value")).cast("string"))
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
        F.when(_every(89, 7), "EUR").otherwise("USD").alias("currency"),
        F.when(_every(17, 0), F.concat(F.lit("F"), F.col("user_id") % 6))
        .otherwise(F.concat(F.lit("H"), F.col("user_id") % 8))
        .alias("country"),
        F.concat(F.lit("D"), "user_id", F.lit("_"), F.col("event_id") % 3).alias("device_id"),
        F.when(F.col("event_type").isin(*CLICKS), "online").otherwise("pos").alias("channel"),
        F.when(fraud, "1").otherwise("0").alias("is_fraud"),
        F.when(fraud, kind).alias("fraud_type"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as a Bronze table would hold them, with fixed lineage."""
    return raw_transactions(spark, sf_dir).withColumns(
        {
            "_source_file": F.format_string("transactions_%s.jsonl", F.col("feed_date")),
            "_ingested_at": F.to_timestamp(F.lit(INGESTED_AT)) + F.make_dt_interval(secs=F.col("copy_no")),
        }
    )


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as feed objects: numbers mostly as numbers, some with an unknown field."""
    rows = raw_transactions(spark, sf_dir)
    promo = F.when(_every(307, 0), F.concat(F.lit("P"), F.col("event_id") % 50)).alias("promo_code")
    number = F.col("amount").try_cast("double")
    as_text = number.isNull() | _every(13, 4)
    before = ["transaction_id", "event_ts", "customer_id", "merchant_id", "merchant_category"]
    after = ["currency", "country", "device_id", "channel"]
    rest = [*after, F.col("is_fraud").cast("int").alias("is_fraud"), "fraud_type", promo]
    numeric = F.to_json(F.struct(*before, number.alias("amount"), *rest))
    textual = F.to_json(F.struct(*before, "amount", *rest))
    return rows.select("feed_date", F.when(as_text, textual).otherwise(numeric).alias("value"))


def write_feed(lines: DataFrame, folder: str) -> None:
    """Add JSON-lines files, in one folder per feed date; a large date gets several."""
    lines.hint("rebalance", "feed_date").write.mode("append").partitionBy("feed_date").text(folder)


LINE = ("l_orderkey", "l_linenumber")


def _merchant() -> Column:
    return F.concat(F.lit("M"), "l_suppkey")


def _first_lines(lines: DataFrame) -> DataFrame:
    return first_arrivals(lines, list(LINE), [*map(F.col, ("l_shipdate", "l_extendedprice", "l_quantity", "l_partkey")), _merchant()])


def scorecard(transaction_id: Column, multiplier: int = 7919) -> Column:
    """A fixed score with ties, 0 and 1 included, in place of a model."""
    return F.pmod(transaction_id.cast("long") * multiplier, F.lit(1001)) / F.lit(1000.0)


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as typed transactions, a larger fact with many same-second rows; repeated (order, line) keys are reduced to one row each.

    Copies of a line go before the join, and those that a repeated order makes after it, on the
    table's own numbers: texts are built from the rows that stay.
    """
    order = table(spark, sf_dir, "orders")
    lines = _first_lines(table(spark, sf_dir, "lineitem"))
    return _first_lines(lines.join(order, lines.l_orderkey == order.o_orderkey)).select(
        F.concat_ws("-", *LINE).alias("transaction_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        _merchant().alias("merchant_id"),
        F.concat(F.lit("cat"), F.col("l_suppkey") % 10).alias("merchant_category"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("H"), F.col("l_partkey") % 7).alias("country"),
        F.concat(F.lit("D"), F.col("l_partkey") % 5).alias("device_id"),
        F.when(F.col("l_linestatus") == "O", "online").otherwise("pos").alias("channel"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_fraud"),
        F.when(F.col("l_returnflag") == "R", "returned").alias("fraud_type"),
    )


def points(features: DataFrame) -> DataFrame:
    """A fixed points score on the features, in place of a model."""
    over = stable_round(F.col("amount_over_avg"), 6)
    total = (
        F.coalesce("is_foreign", F.lit(0)) * 200
        + F.col("is_new_device") * 150
        + F.col("is_night") * 100
        + F.least("txn_count_1h", F.lit(2)) * 60
        + F.least("txn_count_24h", F.lit(5)) * 40
        + F.when(over > 2, 200).otherwise(0)
        + F.when(F.col("amount") > 100, 100).otherwise(0)
        + F.when(F.col("seconds_since_prev_txn") < 7200, 50).otherwise(0)
    )
    return features.withColumn("fraud_score", total / F.lit(1000.0))
