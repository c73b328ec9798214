"""One row per customer and day, from which a day's features are built without its month.

A row of a day needs the seconds of the last 24 hours, so the rows of that day and of
the day before are read. Of the days before those it needs only sums, the newest
second, the first country and the devices used; these are kept per day, and only those
of customers who are active on the day are read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import DEFAULTS, Settings
from tallywatch.operators.dates import between_dates, on_date
from tallywatch.operators.features import derived, device_key, history, keyed
from tallywatch.operators.skew import lookup
from tallywatch.session import written

CUSTOMER_DAYS_DDL = (
    "event_date DATE, customer_id STRING, n BIGINT, total DOUBLE, last_sec BIGINT, "
    "first STRUCT<_sec: BIGINT, _tie: BIGINT, transaction_id: STRING, country: STRING>"
)
DEVICE_DAYS_DDL = "event_date DATE, customer_id STRING, _device STRING"


@dataclass(frozen=True)
class DayStates:
    customers: DataFrame
    devices: DataFrame

    def between(self, after: dt.date | None, until: dt.date) -> DayStates:
        """States of the days with ``after`` < day <= ``until``."""
        wanted = F.col("event_date") <= F.lit(until)
        if after is not None:
            wanted = wanted & (F.col("event_date") > F.lit(after))
        return DayStates(self.customers.where(wanted), self.devices.where(wanted))


def customer_days(txns: DataFrame) -> DataFrame:
    """Priced rows, their sum, the newest second and the first row of every customer and day."""
    day = F.to_date("event_ts").alias("event_date")
    return keyed(txns).groupBy(day, "customer_id").agg(
        F.count("amount").alias("n"),
        F.sum("amount").alias("total"),
        F.max("_sec").alias("last_sec"),
        F.min(F.struct("_sec", "_tie", "transaction_id", "country")).alias("first"),
    )


def device_days(txns: DataFrame) -> DataFrame:
    """The devices that a customer used on a day."""
    return txns.select(F.to_date("event_ts").alias("event_date"), "customer_id", device_key().alias("_device")).distinct()


def day_features(txns: DataFrame, states: DayStates, risk: DataFrame, date: dt.date, settings: Settings = DEFAULTS) -> DataFrame:
    """Features of the rows of one day, equal to those from ``lookback_days`` of rows.

    ``states`` must hold every day of the look-back that ends two days before ``date``.
    Rows without a customer, which clean rows never are, have no history here.
    """
    days = settings.lookback_days
    after = None if days is None else date - dt.timedelta(days=days)
    since = date - dt.timedelta(days=2)  # the last day read from the states
    if after is not None:
        since = max(after, since)
    two_days = between_dates(txns, since, date)
    active = written(on_date(two_days, date).select("customer_id").distinct(), "active-customers")
    two_days = written(two_days.join(active, "customer_id", "left_semi"), "two-days")
    today = written(on_date(history(two_days, settings), date), "day-history")
    past = states.between(after, since)
    return derived(
        lookup(_with_past(today, past, active, settings), risk, "merchant_id", F.col("transaction_id"), settings, count_on=two_days),
        txns.columns,
        settings,
    )


def _with_past(today: DataFrame, past: DayStates, active: DataFrame, settings: Settings) -> DataFrame:
    """Add the states of earlier days to the history that two days of rows gave."""
    earlier = written(
        past.customers.join(active, "customer_id", "left_semi").groupBy("customer_id").agg(
            F.sum("n").alias("_past_n"),
            F.sum("total").alias("_past_total"),
            F.max("last_sec").alias("_past_sec"),
            F.min("first").alias("_past_first"),
        ),
        "earlier-days",
    )
    amount, total = F.col("_prior_amount"), F.col("_past_total")
    rows = lookup(today, earlier, "customer_id", F.col("transaction_id"), settings).withColumns(
        {
            "_home": F.when(F.col("_past_first").isNull(), F.col("_home")).otherwise(F.col("_past_first.country")),
            "_prior_n": F.col("_prior_n") + F.coalesce("_past_n", F.lit(0)),
            "_prior_amount": F.coalesce(amount + total, amount, total),
            "_prev_sec": F.coalesce("_prev_sec", "_past_sec"),
        }
    )
    # only the first row of a customer's device in the two days can be its first use: one row for each pair
    known = past.devices.join(active, "customer_id", "left_semi").select("customer_id", "_device").distinct()
    first = rows.where("_new_device").withColumn("_device", device_key())
    seen = first.join(known.withColumn("_seen", F.lit(True)), ["customer_id", "_device"], "left")
    first = seen.withColumn("_new_device", F.col("_seen").isNull())
    return rows.where("NOT _new_device").unionByName(first.select(*rows.columns))
