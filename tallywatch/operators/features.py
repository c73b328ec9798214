"""Point-in-time features per transaction.

Every history feature of a row looks only at rows before it: the velocity counts
and the previous timestamp work on whole seconds, the running average also on
earlier rows of the same second, in the order of ``tie_key``.

A customer's history is one window, so it must fit one task. Customers with more
rows than that take a second route with the same results, in which no group is
larger than the seconds of two days or a slice of one second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallywatch.config import DAY_SECONDS, DEFAULTS, HOUR_SECONDS, Settings
from tallywatch.functions.expressions import epoch_seconds, ratio, tie_key, tie_slice
from tallywatch.operators.gold import NIGHT_END_HOUR
from tallywatch.operators.skew import heavy_keys, lookup
from tallywatch.session import written

# Names and order of the model inputs.
FEATURE_COLS = [
    "amount",
    "log_amount",
    "hour",
    "is_night",
    "is_online",
    "is_foreign",
    "is_new_device",
    "txn_count_1h",
    "txn_count_24h",
    "amount_over_avg",
    "seconds_since_prev_txn",
    "merchant_fraud_rate",
]

SLICE_BITS = 12  # 4096 slices of a crowded second


def merchant_risk(train: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Smoothed incidence per merchant; give it rows of the training window only."""
    return train.groupBy("merchant_id").agg(
        (
            (F.sum("is_fraud") + settings.merchant_prior_fraud)
            / (F.count("*") + settings.merchant_prior_rows)
        ).alias("merchant_fraud_rate")
    )


def build_features(
    txns: DataFrame,
    risk: DataFrame,
    settings: Settings = DEFAULTS,
    hot_customers: DataFrame | None = None,
) -> DataFrame:
    """``txns`` with the feature columns added.

    ``txns`` is read more than once; give it a table, not a long plan.
    ``hot_customers`` may name the customers too large for one task if a profile
    table already has the counts; otherwise they are counted here.
    """
    rated = lookup(
        history(txns, settings, hot_customers), risk, "merchant_id", F.col("transaction_id"), settings, count_on=txns
    )
    return derived(rated, txns.columns, settings)


def history(txns: DataFrame, settings: Settings = DEFAULTS, hot_customers: DataFrame | None = None) -> DataFrame:
    """``txns`` with what each row's customer did before it, in columns that begin with an underscore."""
    if hot_customers is None:
        hot_customers = written(heavy_keys(txns, "customer_id", settings), "hot-customers")
    if hot_customers.isEmpty():
        return _windowed(keyed(txns))
    hot = hot_customers.select("customer_id")
    return _windowed(keyed(txns.join(hot, "customer_id", "left_anti"))).unionByName(
        _decomposed(keyed(txns.join(hot, "customer_id", "left_semi")))
    )


def derived(rated: DataFrame, columns: list[str], settings: Settings = DEFAULTS) -> DataFrame:
    """The given columns and the features, from history and merchant risk."""
    return _derive(rated, settings).select(*columns, *[c for c in FEATURE_COLS if c not in columns])


def keyed(txns: DataFrame) -> DataFrame:
    """Add the order of history: whole seconds, then the tie key."""
    return txns.withColumns(
        {"_sec": epoch_seconds(F.col("event_ts")), "_tie": tie_key(F.col("transaction_id"))}
    )


def device_key() -> Column:
    """The device as a key that is never null."""
    return F.coalesce(F.concat(F.lit("+"), "device_id"), F.lit("-"))


def _windowed(rows: DataFrame) -> DataFrame:
    """History by windows over whole customers: one shuffle serves all of them."""
    customer = Window.partitionBy("customer_id")
    in_order = customer.orderBy("_sec", "_tie", "transaction_id")
    by_second = customer.orderBy("_sec")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    device = Window.partitionBy("customer_id", "device_id").orderBy("_sec", "_tie", "transaction_id")
    return (
        rows.withColumn("_new_device", F.row_number().over(device) == 1)
        .withColumns(
            {
                "_home": F.first("country").over(
                    in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                ),
                "_prior_n": F.count("amount").over(before),
                "_prior_amount": F.sum("amount").over(before),
                "_prev_sec": F.lag("_sec").over(in_order),
            }
        )
        .withColumns(
            {
                "_n_1h": _within(F.count("*"), by_second, HOUR_SECONDS),
                "_n_24h": _within(F.count("*"), by_second, DAY_SECONDS),
            }
        )
    )


def _decomposed(rows: DataFrame) -> DataFrame:
    """The same history from sums per second, day and slice of a second.

    The sums feed several branches, so they are stored.
    """
    rows = rows.withColumns({"_slice": tie_slice(F.col("_tie"), SLICE_BITS), "_device": device_key()})
    slices = rows.groupBy("customer_id", "_sec", "_slice").agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("n"),
        F.sum("amount").alias("total"),
        F.min("_tie").alias("first_tie"),
    )
    slices = written(slices, "slices")
    seconds = (
        slices.groupBy("customer_id", "_sec")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.min("first_tie").alias("first_tie"),
        )
        .withColumn("_day", F.floor(F.col("_sec") / DAY_SECONDS))
    )
    seconds = written(seconds, "seconds")
    in_second = (
        Window.partitionBy("customer_id", "_sec")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = slices.select(
        "customer_id",
        "_sec",
        "_slice",
        F.coalesce(F.sum("n").over(in_second), F.lit(0)).alias("slice_n"),
        F.coalesce(F.sum("total").over(in_second), F.lit(0.0)).alias("slice_total"),
    ).join(_second_history(seconds), ["customer_id", "_sec"])

    in_slice = (
        Window.partitionBy("customer_id", "_sec", "_slice")
        .orderBy("_tie", "transaction_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first_rows = rows.groupBy("customer_id").agg(
        F.min_by("country", F.struct("_sec", "_tie")).alias("_home")
    )
    first_uses = rows.groupBy("customer_id", "_device").agg(
        F.min(F.struct("_sec", "_tie", "transaction_id")).alias("_first")
    )
    # an id seen twice in one second marks one of its rows
    same_id = Window.partitionBy("customer_id", "_device", "_sec", "_tie", "transaction_id").orderBy("_sec")
    return (
        rows.withColumns(
            {
                "_nth": F.row_number().over(same_id),
                "_own_n": F.count("amount").over(in_slice),
                "_own_total": F.coalesce(F.sum("amount").over(in_slice), F.lit(0.0)),
            }
        )
        .join(placed, ["customer_id", "_sec", "_slice"])
        .join(first_rows, "customer_id")
        .join(first_uses, ["customer_id", "_device"])
        .withColumns(
            {
                "_new_device": (F.col("_nth") == 1)
                & F.struct("_sec", "_tie", "transaction_id").eqNullSafe(F.col("_first")),
                "_prior_n": F.col("second_n") + F.col("slice_n") + F.col("_own_n"),
                "_prior_amount": F.col("second_total") + F.col("slice_total") + F.col("_own_total"),
                "_prev_sec": F.when(F.col("_tie") > F.col("first_tie"), F.col("_sec")).otherwise(
                    F.col("prev_sec")
                ),
            }
        )
        .drop("_slice", "_device", "_own_n", "_own_total", "_first", "_nth", "first_tie", "prev_sec")
        .drop("slice_n", "slice_total", "second_n", "second_total")
    )


def _second_history(seconds: DataFrame) -> DataFrame:
    """Per customer and second: what happened in earlier seconds.

    Each second is copied to the next day as well, so that the frames of a day
    see the whole day before; a group then has at most two days of seconds.
    """
    two_days = seconds.select(
        "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_shift")
    ).withColumns({"_day": F.col("_day") + F.col("_shift"), "_own": F.col("_shift") == 0})
    day = Window.partitionBy("customer_id", "_day").orderBy("_sec")
    before = day.rowsBetween(Window.unboundedPreceding, -1)
    in_day = two_days.select(
        "customer_id",
        "_sec",
        "_day",
        "_own",
        "first_tie",
        _within(F.sum("rows"), day, HOUR_SECONDS).alias("_n_1h"),
        _within(F.sum("rows"), day, DAY_SECONDS).alias("_n_24h"),
        _sum_if(F.col("_own"), "n", before, 0).alias("day_n"),
        _sum_if(F.col("_own"), "total", before, 0.0).alias("day_total"),
        F.lag("_sec").over(day).alias("day_prev"),
    ).where("_own")

    earlier_days = (
        Window.partitionBy("customer_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    )
    days = (
        seconds.groupBy("customer_id", "_day")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("_sec").alias("last"))
        .select(
            "customer_id",
            "_day",
            F.coalesce(F.sum("n").over(earlier_days), F.lit(0)).alias("days_n"),
            F.coalesce(F.sum("total").over(earlier_days), F.lit(0.0)).alias("days_total"),
            F.max("last").over(earlier_days).alias("days_prev"),
        )
    )
    return in_day.join(days, ["customer_id", "_day"]).select(
        "customer_id",
        "_sec",
        "first_tie",
        "_n_1h",
        "_n_24h",
        (F.col("days_n") + F.col("day_n")).alias("second_n"),
        (F.col("days_total") + F.col("day_total")).alias("second_total"),
        F.coalesce("day_prev", "days_prev").alias("prev_sec"),
    )


def _within(total: Column, by_second: WindowSpec, seconds: int) -> Column:
    """A total over the ``seconds`` before the current one, as a difference of running totals.

    Spark adds up a sliding frame anew for every row; running totals cost the
    same per row however long the frame.
    """
    until_now = total.over(by_second.rangeBetween(Window.unboundedPreceding, -1))
    before = total.over(by_second.rangeBetween(Window.unboundedPreceding, -seconds - 1))
    return F.coalesce(until_now, F.lit(0)) - F.coalesce(before, F.lit(0))


def _sum_if(condition: Column, value: str, window: WindowSpec, empty) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))).over(window), F.lit(empty))


def _derive(history: DataFrame, settings: Settings) -> DataFrame:
    prior_mean = ratio(F.col("_prior_amount"), F.col("_prior_n"))
    hour = F.hour("event_ts")
    return history.withColumns(
        {
            "log_amount": F.log1p("amount"),
            "hour": hour,
            "is_night": (hour < NIGHT_END_HOUR).cast("int"),
            "is_online": (F.col("channel") == "online").cast("int"),
            "is_foreign": (F.col("country") != F.col("_home")).cast("int"),
            "is_new_device": F.col("_new_device").cast("int"),
            "txn_count_1h": F.col("_n_1h"),
            "txn_count_24h": F.col("_n_24h"),
            "amount_over_avg": F.when(prior_mean.isNull(), 1.0).otherwise(
                F.col("amount") / prior_mean
            ),
            "seconds_since_prev_txn": F.coalesce(
                F.col("_sec") - F.col("_prev_sec"), F.lit(settings.no_previous_seconds)
            ),
            "merchant_fraud_rate": F.coalesce("merchant_fraud_rate", F.lit(0.0)),
        }
    )


def split_bounds(txns: DataFrame, settings: Settings = DEFAULTS) -> Column:
    """Last training date: the first date plus the split day, as a scalar subquery."""
    first = F.min(F.to_date("event_ts"))
    return txns.select(F.date_add(first, settings.train_test_split_day)).scalar()


def time_split(rows: DataFrame, split_date: Column) -> DataFrame:
    """Label each row ``train`` (up to the split date) or ``test`` (after it)."""
    return rows.withColumn(
        "split", F.when(F.to_date("event_ts") <= split_date, "train").otherwise("test")
    )
