import numpy as np
import pytest
from conftest import rows
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fleetwarden.operators.sampling import with_split
from fleetwarden.plans import bindings as b
from fleetwarden.plans import learning, silver
from fleetwarden.session import staged


@pytest.fixture(scope="module")
def trained(spark, sf):
    """A label that the statistics do decide, so that training has something to find."""
    history = silver.training_dataset(b.readings(spark, sf)).withColumn(
        "abnormal_sensor", F.when(F.col("avg_energy") > 25000, "ok").otherwise("sensor_A")
    )
    history = staged(history)
    labels = learning.known_labels(history)
    frame = staged(learning.training_frame(history, labels))
    return frame, labels, learning.train(frame, learning.logistic(frame, iterations=40)), history


def test_metrics_equal_the_evaluator(trained):
    frame, labels, model, _ = trained
    metrics = {r["split"]: r for r in learning.split_metrics(learning.confusion(model, frame, labels)).collect()}
    for split in ("train", "val", "test"):
        scored = model.transform(frame.filter(F.col("split") == split))
        for name, column in (("f1", "weighted_f1"), ("accuracy", "accuracy")):
            want = MulticlassClassificationEvaluator(metricName=name).evaluate(scored)
            assert metrics[split][column] == pytest.approx(want)
    assert metrics["test"]["weighted_f1"] > 0.9


def test_weights_balance_the_classes(trained):
    frame, _, _, _ = trained
    fitted = frame.filter("split = 'train'")
    totals = [r[1] for r in rows(fitted.groupBy("abnormal_sensor").agg(F.sum("weight")))]
    assert totals[0] == pytest.approx(totals[1])


def test_proof_of_a_logistic_fit(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    label = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) > 0.3).astype(int) + (x[:, 2] > 1)
    data = [(Vectors.dense(a), float(k), 1.0 + i % 3) for i, (a, k) in enumerate(zip(x, label))]
    table = spark.createDataFrame(data, ["features", "label", "weight"]).repartition(5)
    fit = lambda reg, steps: LogisticRegression(
        family="multinomial", elasticNetParam=1.0, regParam=reg, weightCol="weight", maxIter=steps, standardization=False, tol=1e-10
    ).fit(table)
    good = learning.logistic_proof(fit(0.02, 300), table).collect()
    assert [r["off"] for r in good] == [0, 0, 0] and max(r["largest_miss"] for r in good) < 1e-5
    assert 0 < sum(r["weights"] for r in good) < 12  # the penalty leaves some out
    early = learning.logistic_proof(fit(0.02, 2), table).collect()
    assert sum(r["off"] for r in early) > 0
    # The slope of one class by hand.
    model = fit(0.02, 2)
    score = x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
    share = np.exp(score) / np.exp(score).sum(axis=1, keepdims=True)
    w = np.array([r[2] for r in data])
    slope = ((share[:, 1] - (label == 1)) * w) @ np.column_stack([x, np.ones(400)]) / w.sum()
    value = np.append(model.coefficientMatrix.toArray()[1], 0)
    miss = np.where(value == 0, np.maximum(np.abs(slope) - 0.02, 0), np.abs(slope + 0.02 * np.sign(value)))
    miss[-1] = abs(slope[-1])
    assert {r["label"]: r["largest_miss"] for r in early}[1] == pytest.approx(miss.max(), rel=1e-9)
    with pytest.raises(ValueError):
        learning.logistic_proof(LogisticRegression(regParam=0.1, weightCol="weight").fit(table), table)


def test_registered_function_agrees_with_the_pipeline(spark, trained):
    _, labels, model, history = trained
    learning.register_scorer(spark, "predict_maintenance_t", model, labels)
    inputs = history.select("turbine_id", *learning.INPUTS)
    gaps = inputs.limit(20).withColumns({"avg_energy": F.lit(None).cast("double"), "percentiles_sensor_A": F.lit(None).cast("array<double>")})
    scored = learning.score_status(model, labels)(inputs.unionByName(gaps))
    differ = scored.filter(F.expr(f"predict_maintenance_t({', '.join(learning.INPUTS)})") != F.col("prediction"))
    assert differ.isEmpty() and len(learning.INPUTS) == 14


def test_search_judges_on_validation_rows(spark, trained):
    frame, labels, _, _ = trained
    found = rows(learning.search(frame, labels, [18.0, 1e-3]))
    assert [c for c, _ in found] == [0.001, 18.0] and found[1][1] > found[0][1]
    lying = frame.withColumn("label", F.when(F.col("split") == "test", 1 - F.col("label")).otherwise(F.col("label")))
    assert rows(learning.search(lying, labels, [18.0])) == [found[1]]


def test_publish_and_score(spark, trained, tmp_path):
    frame, labels, model, _ = trained
    learning.publish(spark, model, labels, str(tmp_path), "prod", "run_1")
    again, names = learning.published(spark, str(tmp_path), "prod")
    assert names == labels
    rows_ = frame.select("turbine_id", "hourly_timestamp", "abnormal_sensor", *learning.NUMERIC, *learning.ARRAYS)
    scored = learning.score_status(again, names)(rows_.withColumn("avg_energy", F.col("avg_energy")))
    agree = scored.filter(F.col("prediction") == F.col("abnormal_sensor")).count()
    assert scored.columns == [*rows_.columns, "prediction"] and agree > 0.9 * frame.count()


def test_best_run_and_confusion_matrix(spark, trained):
    frame, labels, model, _ = trained
    counts = staged(learning.confusion(model, frame, labels))
    wide = learning.confusion_wide(counts, labels).collect()
    assert sum(r[f"predicted_{x}"] for r in wide for x in labels) == frame.filter("split = 'val'").count()
    metrics = learning.split_metrics(counts).withColumn("run", F.lit("a"))
    part = metrics.filter("split <> 'test'").withColumn("run", F.lit("b"))
    runs = {r["run"]: r for r in learning.runs_table(metrics.unionByName(part)).collect()}
    assert runs["b"]["test_f1"] is None and runs["a"]["val_f1"] == runs["b"]["val_f1"]


def test_split_covers_every_row(spark, sf):
    df = with_split(b.table(spark, sf, "orders"), ["o_orderkey"])
    assert df.filter(F.col("split").isNull()).isEmpty()


def test_forests_as_functions_agree_with_the_models(spark, trained):
    frame, labels, _, history = trained
    inputs = history.select("turbine_id", *learning.INPUTS)
    gaps = inputs.limit(20).withColumns({"avg_energy": F.lit(None).cast("double"), "percentiles_sensor_A": F.lit(None).cast("array<double>")})
    rows_ = inputs.unionByName(gaps)
    flat = learning.train_deep(frame, depth=12, trees=5)
    for name, model in (
        ("by_forest_t", learning.train(frame, learning.forest(5, 4), calendar=False)),
        ("by_deep_t", flat),
        ("by_timed_forest_t", learning.train(frame, learning.forest(3, 4))),
    ):
        learning.register_scorer(spark, name, model, labels)
        scored = learning.score_status(model, labels)(rows_)
        both = scored.withColumn("f", F.expr(f"{name}({', '.join(learning.INPUTS)})"))
        assert both.filter(~F.col("f").eqNullSafe(F.col("prediction"))).isEmpty()
    metrics = {r["split"]: r for r in learning.split_metrics(learning.confusion(flat, frame, labels)).collect()}
    assert metrics["test"]["weighted_f1"] > 0.9
    with pytest.raises(TypeError, match="no SQL function"):
        learning._scorer_of(type("M", (), {"stages": [None]})())


def test_halving_finds_the_winner_of_the_grid_with_fewer_long_fits(spark, trained):
    frame, labels, _, _ = trained
    strengths = [50.0, 18.0, 1.0, 1e-3, 1e-4]
    runs = learning.successive_halving(frame, labels, strengths, rungs=(5, 15, 40)).collect()
    assert [sum(r["rung"] == k for r in runs) for k in range(3)] == [5, 3, 2]
    winner = next(r for r in runs if r["rung"] == 2 and r["kept"])
    grid = {c: learning.split_metrics(learning.confusion(learning.train(frame, learning.logistic(frame, c, 40)), frame, labels)).filter("split = 'val'").first()["weighted_f1"] for c in strengths}
    assert grid[winner["inverse_reg"]] == pytest.approx(max(grid.values()), abs=0.005)
    assert winner["f1"] == pytest.approx(grid[winner["inverse_reg"]])
    assert sum(r["iterations"] for r in runs) < 40 * len(strengths)


def test_models_are_fitted_and_used_after_an_ingest(spark, trained, tmp_path):
    from fleetwarden.operators.quality import Expectation
    from fleetwarden.streaming import ingest

    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    spark.range(10).write.parquet(landing)
    counts = ingest.ingest_files(spark, landing, table, state, spark.range(1).schema, [Expectation("small", "id < 4")])
    assert counts["small"] == 6
    frame, labels, _, _ = trained
    model = learning.train(frame, learning.logistic(frame, iterations=3))
    assert learning.confusion(model, frame, labels).count() > 0


def test_many_rows_of_a_fit_are_dealt_evenly_and_stay_the_same(spark, trained, monkeypatch):
    """One label holds nearly all rows: dealt by labels, most files of a fit were empty or much larger than the others."""
    history = trained[3].withColumn("abnormal_sensor", F.when(F.col("avg_energy") > 0, "ok").otherwise("sensor_A"))
    frame = lambda: learning.training_frame(history, ["ok", "sensor_A"])
    plain = staged(frame())
    monkeypatch.setattr(learning, "DEALT_ROWS", 0)
    dealt = staged(frame())
    columns = [*learning.KEY, "abnormal_sensor", "label", "weight", "split"]
    assert rows(dealt.select(*columns)) == rows(plain.select(*columns))
    fitted = learning.features(dealt, calendar=False)[1]
    held = [r["n"] for r in fitted.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    cores, n = spark.sparkContext.defaultParallelism, plain.count()
    assert sum(held) == n and len(held) == cores and max(held) < 1.5 * n / cores


def test_function_queries_compute_their_statistics_once(spark, sf, monkeypatch):
    """Fit and comparison read one stored table of hourly statistics."""
    from fleetwarden.suite import queries

    calls, whole, logistic = [], silver.training_dataset, learning.logistic
    monkeypatch.setattr(silver, "training_dataset", lambda *a, **k: calls.append(1) or whole(*a, **k))
    monkeypatch.setattr(learning, "logistic", lambda frame: logistic(frame, iterations=3))
    found = queries.registered_scorer(spark, sf).first()
    assert len(calls) == 1
    assert found["n"] == whole(b.readings(spark, sf)).count() and found["different"] == 0
