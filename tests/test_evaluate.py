"""Golden metrics: the 15 published confusion matrices (rows = truth, columns = prediction,
order La Nina, Neutral, El Nino) with their published accuracy and macro F1, and the published
RMSE pairs with their skill scores."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS
from panelcast.operators import evaluate

# (target, model, confusion matrix, accuracy, macro F1, per-class F1) as published
GOLDEN = [
    ("enso_t1", "logistic_regression", [[32, 0, 0], [2, 35, 4], [0, 1, 17]], 0.9231, 0.9169, (0.9697, 0.9091, 0.8718)),
    ("enso_t1", "random_forest", [[29, 3, 0], [2, 38, 1], [0, 0, 18]], 0.9341, 0.9401, (0.9206, 0.9268, 0.973)),
    ("enso_t1", "lightgbm", [[31, 1, 0], [2, 37, 2], [0, 0, 18]], 0.9451, 0.946, (0.9538, 0.9367, 0.9474)),
    ("enso_t1", "climatology", [[0, 32, 0], [0, 41, 0], [0, 18, 0]], 0.4505, 0.2071, (0.0, 0.6212, 0.0)),
    ("enso_t1", "persistence", [[28, 4, 0], [4, 34, 3], [0, 2, 16]], 0.8571, 0.8598, (0.875, 0.8395, 0.8649)),
    ("enso_t3", "logistic_regression", [[23, 9, 0], [5, 32, 4], [0, 3, 13]], 0.764, 0.7692, (0.7667, 0.7529, 0.7879)),
    ("enso_t3", "random_forest", [[23, 9, 0], [4, 27, 10], [0, 3, 13]], 0.7079, 0.7071, (0.7797, 0.675, 0.6667)),
    ("enso_t3", "lightgbm", [[23, 9, 0], [1, 28, 12], [0, 2, 14]], 0.7303, 0.7294, (0.8214, 0.7, 0.6667)),
    ("enso_t3", "climatology", [[0, 32, 0], [0, 41, 0], [0, 16, 0]], 0.4607, 0.2103, (0.0, 0.6308, 0.0)),
    ("enso_t3", "persistence", [[21, 11, 0], [11, 22, 8], [0, 5, 11]], 0.6067, 0.6139, (0.6562, 0.557, 0.6286)),
    ("enso_t6", "logistic_regression", [[13, 15, 4], [6, 24, 11], [0, 2, 11]], 0.5581, 0.5531, (0.5098, 0.5854, 0.5641)),
    ("enso_t6", "random_forest", [[15, 12, 5], [12, 23, 6], [0, 3, 10]], 0.5581, 0.5597, (0.5085, 0.5823, 0.5882)),
    ("enso_t6", "lightgbm", [[9, 17, 6], [8, 22, 11], [0, 2, 11]], 0.4884, 0.4802, (0.3673, 0.5366, 0.5366)),
    ("enso_t6", "climatology", [[0, 32, 0], [0, 41, 0], [0, 13, 0]], 0.4767, 0.2152, (0.0, 0.6457, 0.0)),
    ("enso_t6", "persistence", [[16, 16, 0], [14, 14, 13], [2, 5, 6]], 0.4186, 0.4145, (0.5, 0.3684, 0.375)),
]
# (target, rmse, rmse persistence, skill to 3 decimals) as published
REGRESSION = [("nino34_t1", 0.0767, 0.0753, -0.019), ("nino34_t3", 0.2702, 0.3499, 0.228), ("nino34_t6", 0.5759, 0.7353, 0.217)]


@pytest.fixture(scope="module")
def golden_preds(spark):
    rows = []
    for target, model, cm, *_ in GOLDEN:
        for i, row in enumerate(cm):
            for j, n in enumerate(row):
                rows += [(target, model, LABELS[i], LABELS[j])] * n
    rows += [("enso_t1", "persistence", None, LABELS[0]), ("enso_t1", "persistence", LABELS[1], None)]  # dropped (E1)
    return spark.createDataFrame(rows, "target string, model string, y_true string, y_pred string")


def test_golden_confusion_matrices(golden_preds):
    got = {(r.target, r.model): r for r in
           evaluate.classification_metrics(golden_preds, with_matrix=True).collect()}
    for target, model, cm, acc, f1, per in GOLDEN:
        r = got[(target, model)]
        assert r.accuracy == acc and r.f1_macro == f1, (target, model, r.accuracy, r.f1_macro)
        assert (r.f1_la_nina, r.f1_neutral, r.f1_el_nino) == per
        assert [list(x) for x in r.confusion_matrix] == cm
        assert r.n == sum(map(sum, cm))


def test_skill_scores(spark):
    rows = [(t, "boosted", a) for t, a, _, _ in REGRESSION] + [(t, "persistence", b) for t, _, b, _ in REGRESSION]
    reg = spark.createDataFrame(rows, "target string, model string, rmse double")
    got = {r.target: r.skill for r in evaluate.skill_score(reg).filter("model = 'boosted'").collect()}
    for t, _, _, s in REGRESSION:
        assert round(got[t], 3) == s


def test_beats_baseline_and_top(golden_preds):
    m = evaluate.classification_metrics(golden_preds)
    b = {r.target: r for r in evaluate.beats_baseline(m).collect()}
    assert b["enso_t1"].best_model == "lightgbm" and b["enso_t1"].beats_baseline
    assert b["enso_t6"].best_model == "random_forest" and b["enso_t6"].baseline_f1_macro == 0.4145
    top = {r.target: r.model for r in evaluate.top_model(m).collect()}
    assert top == {"enso_t1": "lightgbm", "enso_t3": "logistic_regression", "enso_t6": "random_forest"}
    lt = {r.lead: r for r in evaluate.lead_time_table(m, ["persistence", "climatology"]).collect()}
    assert lt[3].persistence == 0.6139 and lt[6].climatology == 0.2152


def test_normalized_confusion(golden_preds):
    nc = evaluate.normalized_confusion(golden_preds.filter("target = 'enso_t1' and model = 'lightgbm'"))
    got = {(r.y_true, r.y_pred): r.share for r in nc.collect()}
    assert abs(got[(LABELS[1], LABELS[1])] - 37 / 41) < 1e-12


def _dated(spark, rows):
    return spark.createDataFrame(rows, "target string, model string, period date, y_true string, y_pred string, crosses boolean")


def test_strata_and_init_month(spark):
    la, ne, en = LABELS
    rows = [("t", "m", dt.date(2000, 1, 1), la, la, True), ("t", "m", dt.date(2001, 1, 1), ne, la, True),
            ("t", "m", dt.date(2002, 1, 1), en, en, True), ("t", "m", dt.date(2000, 7, 1), ne, ne, False),
            ("t", "m", dt.date(2001, 7, 1), ne, ne, False)]
    df = _dated(spark, rows)
    s = {r.stratum: r for r in evaluate.by_barrier(df, "crosses").collect()}
    assert s["no_spring_barrier"].accuracy == 1.0 and s["crosses_spring"].n == 3
    assert s["crosses_spring"].delta_f1 == round(s["no_spring_barrier"].f1_macro - s["crosses_spring"].f1_macro, 4)
    im = {r.month: r for r in evaluate.by_init_month(df, "period").collect()}
    assert len(im) == 12
    assert im[1].n == 3 and im[1].f1_macro is not None
    assert im[7].f1_macro is None and im[7].n == 0 and im[7].n_raw == 2
    assert im[5].n_raw == 0


def test_regression_metrics(spark):
    df = spark.createDataFrame([("t", "m", 1.0, 1.5), ("t", "m", 2.0, 1.0), ("t", "m", None, 3.0)],
                               "target string, model string, y_true double, y_pred double")
    r = evaluate.regression_metrics(df).collect()[0]
    assert r.n == 2 and r.mae == 0.75 and r.rmse == round((0.25 / 2 + 1 / 2) ** 0.5, 4)
    assert F is not None


def test_all_strata_in_one_pass(spark):
    """One aggregate and grouping sets equal the three separate results."""
    import datetime as dt
    import random
    rng = random.Random(2)
    labels = [*evaluate.LABELS, None]
    rows = [("t1", m, dt.date(2001, rng.randint(1, 11), 1) if rng.random() < 0.95 else None, rng.choice([True, False, None]),
             rng.choice(labels), rng.choice(labels)) for m in ("a", "b") for _ in range(120)]
    p = spark.createDataFrame(rows, "target string, model string, period date, crosses boolean, y_true string, y_pred string")
    got = evaluate.all_strata(p, "period", "crosses").collect()
    pick = lambda r: (r.target, r.model, r.accuracy, r.f1_macro, r.f1_la_nina, r.n)
    assert sorted(map(pick, (r for r in got if r.part == "all"))) == sorted(map(pick, evaluate.classification_metrics(p).collect()))
    want = evaluate.by_barrier(p, "crosses").collect()
    assert sorted((*pick(r), r.stratum, r.delta_f1) for r in got if r.part == "barrier") == sorted((*pick(r), r.stratum, r.delta_f1) for r in want)
    months = {(r.model, r.month): (r.f1_macro, r.n_raw) for r in evaluate.by_init_month(p, "period").collect() if r.n_raw}
    assert {(r.model, r.month): (r.f1_macro, r.n) for r in got if r.part == "month"} == months
