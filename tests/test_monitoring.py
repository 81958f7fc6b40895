import numpy as np
import pytest
from pyspark.sql import functions as F

from stacklens.operators import drift, monitoring
from stacklens.plans import feature_etl, retraining
from stacklens.sources import testdata


def numpy_psi(base, cur, simple=False):
    edges = np.percentile(base, np.linspace(0, 100, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    extra = 0 if simple else 10e-6
    b = (np.histogram(base, edges)[0] + 1e-6) / (len(base) + extra)
    c = (np.histogram(cur, edges)[0] + 1e-6) / (len(cur) + extra)
    return float(np.sum((c - b) * np.log(c / b)))


def long(spark, values):
    return spark.createDataFrame([("f", float(v)) for v in values], "feature string, value double")


@pytest.mark.parametrize("seed,discrete", [(0, False), (1, True)])
def test_psi_equals_numpy(spark, seed, discrete):
    rng = np.random.default_rng(seed)
    base, cur = rng.normal(0, 1, 900), rng.normal(0.4, 1.2, 700)
    if discrete:  # repeated edges
        base, cur = np.round(base), np.round(cur)
    profile = drift.baseline_profile(long(spark, base))
    for smoothing in ("full", "simple"):
        row = drift.psi(profile, long(spark, cur), smoothing=smoothing).first()
        assert row.psi == pytest.approx(numpy_psi(base, cur, smoothing == "simple"), abs=6e-5)
    assert row.status == ("OK" if row.psi < 0.1 else "WARNING" if row.psi < 0.2 else "CRITICAL")


def test_kl_bins_at_exact_edges(spark):
    base, cur = [0.0, 0.05, 0.15, 0.3, 0.95, 1.0, 1.7], [0.15, 0.15, 0.6, -1.0]
    rows = [(float(v), True) for v in base] + [(float(v), False) for v in cur]
    edges = np.linspace(0, 1, 21)
    b = np.histogram(np.clip(base, 0, 1), edges)[0] + 1e-6
    c = np.histogram(np.clip(cur, 0, 1), edges)[0] + 1e-6
    b, c = b / (len(base) + 20e-6), c / (len(cur) + 20e-6)
    row = drift.kl_drift(spark.createDataFrame(rows, "score double, is_baseline boolean")).first()
    assert row.kl_divergence == pytest.approx(float(np.sum(c * np.log(c / b))), abs=1e-4)
    assert row.baseline_score_std == pytest.approx(np.std(base), abs=1e-4)


def test_category_on_one_side_only(spark):
    rows = [("f", "a", 50, 10), ("f", "b", 50, 40), ("f", "new", 0, 50)]
    counts = spark.createDataFrame(rows, "feature string, category string, base long, cur long")
    assert drift.chi2_drift(counts).first().status == "CRITICAL"
    assert drift.chi2_drift(counts, "counts").first().dof == 2
    shifts = {r.category: r.shift for r in drift.category_shifts(counts).collect()}
    assert shifts == {"a": -0.4, "b": -0.1, "new": 0.5}


def test_proportion_scale_hides_drift(spark):
    counts = spark.createDataFrame([("f", "a", 500, 450), ("f", "b", 500, 550)], "feature string, category string, base long, cur long")
    assert drift.chi2_drift(counts, "proportion").first().status == "OK"
    assert drift.chi2_drift(counts, "counts").first().status == "CRITICAL"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "kind string, feature string, value double, status string")


@pytest.mark.parametrize("rows,days,expected", [
    ([("numeric", "a", 0.01, "OK"), ("prediction", "score", 0.12, "WARNING")], 0, "OK"),
    ([("numeric", "a", 0.15, "WARNING")], 0, "WARNING"),
    ([("numeric", "a", 0.01, "OK"), ("prediction", "score", 0.5, "CRITICAL")], 0, "CRITICAL"),
    ([("categorical", "g", 9.0, "CRITICAL")], 0, "CRITICAL"),
    ([("numeric", "a", 0.01, "OK")], 35, "CRITICAL"),
])
def test_overall_status(spark, rows, days, expected):
    row = drift.drift_summary(rows_of(spark, *rows), days).first()
    assert row.overall_status == expected and row.retraining_recommended == (expected == "CRITICAL")


def test_few_values_are_not_monitored(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(9)], "x double")
    assert drift.feature_drift(frame, frame, ["x"]).count() == 0


def test_zero_scores_are_not_missing(spark):
    one = spark.range(1)
    row = monitoring.system_status(F.lit(0.0), F.lit(0.0), F.lit(None).cast("double"), one).first()
    assert (row.system_status, row.health_score, row.diversity_score) == ("CRITICAL", 0.0, 1.0)
    assert monitoring.system_status(F.lit(0.15), F.lit(1.0), F.lit(0.5), one).first().system_status == "WARNING"


def test_empty_table_is_unhealthy(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    checks = monitoring.table_health({"t": (empty, "ts")}, F.lit("2024-01-01").cast("timestamp")).collect()
    assert [r.passed for r in checks] == [False, False]


def test_decisions(spark):
    metrics = spark.createDataFrame([(0.1, 42), (0.21, 0), (0.0, 43), (0.2, None)], "overall_psi double, days_since_training int")
    assert [r.drift_detected for r in retraining.retrain_decision(metrics).collect()] == [False, True, True, False]
    scores = spark.createDataFrame([(0.5, 0.49), (0.5, 0.495), (0.1, None)], "challenger_score double, champion_score double")
    assert [r.promoted for r in retraining.promote_decision(scores).collect()] == [True, False, True]


def test_baseline_profile_round_trip(spark, loans, tmp_path):
    kept = retraining.save_baseline(loans, str(tmp_path / "base"))
    assert kept.count() == 2
    again = drift.psi(kept, drift.to_long(loans, ["loan_duration_days", "times_renewed"]))
    assert [r.psi for r in again.collect()] == [0.0, 0.0]


def test_metrics_reset(spark, tmp_path):
    path = str(tmp_path / "metrics")
    retraining.reset_metrics(spark, F.lit("2024-01-01").cast("timestamp"), path)
    row = spark.read.schema(retraining.METRICS_SCHEMA).json(path).first()
    assert row.overall_psi == 0.0 and row.days_since_training == 0


def test_retraining_cycle(spark, loans, tmp_path, monkeypatch):
    monkeypatch.setattr(retraining, "train_challenger", lambda train, path: {"als": retraining.als.fit(retraining.interactions(train), 4, 2)})
    quiet = spark.createDataFrame([(0.0, 1)], "overall_psi double, days_since_training int")
    due = spark.createDataFrame([(0.5, 1)], "overall_psi double, days_since_training int")
    stamp = F.lit("2024-01-01").cast("timestamp")
    args = (str(tmp_path / "models"), str(tmp_path / "registry"))
    assert retraining.retrain_if_needed(spark, loans, quiet, stamp, "v0", *args) is False
    assert retraining.retrain_if_needed(spark, loans, due, stamp, "v1", *args) is True
    # The same challenger does not beat itself.
    assert retraining.retrain_if_needed(spark, loans, due, stamp, "v2", *args) is False
    registry = retraining.read_registry(spark, args[1])
    assert registry.count() == 2 and retraining.champion(registry).first().version == "v1"


def test_feature_job_stops_at_the_gate(spark, tiny, tmp_path):
    dirty = testdata.loans(spark, tiny, dirty=True)
    with pytest.raises(ValueError, match="Validation failed"):
        feature_etl.run(spark, dirty, testdata.pos(spark, tiny), testdata.activity(spark, tiny), str(tmp_path))
