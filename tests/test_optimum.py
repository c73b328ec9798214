"""The gradient tells a fitted model from one that stopped early."""

import random

from tallywatch.operators.features import FEATURE_COLS
from tallywatch.operators.training import TrainingPlan, fit_logistic, logistic_gradient


def test_gradient_vanishes_only_at_the_optimum(spark):
    r = random.Random(4)
    rows = []
    for i in range(600):
        x = [r.gauss(0, 1) if r.random() > 0.05 else None for _ in FEATURE_COLS]
        rows.append((f"t{i}", *x, int((x[0] or 0) + r.gauss(0, 1) > 1.2)))
    ddl = "transaction_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLS) + ", is_fraud int"
    train = spark.createDataFrame(rows, ddl)
    steep = {}
    for iterations in (1, 1000):
        terms = logistic_gradient(fit_logistic(train, TrainingPlan(logistic_iterations=iterations)), train).collect()
        assert [t["term"] for t in terms] == [*FEATURE_COLS, "intercept"]
        assert terms[0]["train_rows"] == 600 and terms[0]["positives"] == sum(row[-1] for row in rows)
        steep[iterations] = max(abs(t["gradient"]) for t in terms)
    assert steep[1000] < 1e-5 < 1e-2 < steep[1]
