"""Named quality rules over typed rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.functions.expressions import all_of, any_of

# Rule names appear in quarantine reasons and metrics.
# The amount rule also rejects NaN and Infinity, which compare above every number.
HARD_RULES = {
    "valid_transaction_id": "transaction_id IS NOT NULL",
    "valid_event_ts": "event_ts IS NOT NULL",
    "valid_customer": "customer_id IS NOT NULL",
    "valid_amount": "amount > 0 AND amount < double('Infinity')",
}
SOFT_RULES = {
    "known_merchant": "merchant_id IS NOT NULL",
    "known_currency": "currency IN ('USD')",
}
LATE_EVENT = "late_event"


def holds(rule: str) -> Column:
    """True or false, never null: a rule that cannot be decided has failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def passes(rules: dict[str, str]) -> Column:
    return all_of([holds(rule) for rule in rules.values()])


def fails(rules: dict[str, str]) -> Column:
    return any_of([~holds(rule) for rule in rules.values()])


def failed_names(rules: dict[str, str]) -> Column:
    """Comma-separated names of the failed rules, in rule order."""
    return F.concat_ws(", ", *[F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()])
