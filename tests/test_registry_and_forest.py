"""Published model versions, and the forest with bagging by hash."""

import math

import pytest
from pyspark.sql import functions as F

from clientincome.operators import training
from clientincome.sources import registry


def _table(spark, path):
    spark.range(1).write.parquet(path)


def _publish(spark, root, version, parts=("model", "factor")):
    for p in parts:
        _table(spark, f"{root}/{version}/{p}")
    registry.publish(spark, root, version, f"{root}/{version}", 7, parts)


def test_newest_whole_version(spark, tmp_path):
    root = str(tmp_path / "models")
    assert registry.latest(spark, root) is None and registry.published(spark, root).count() == 0
    for v in ("2024-02", "2024-03", "2024-01"):
        _publish(spark, root, v)
    found = registry.latest(spark, root)
    assert (found["version"], found["path"], found["n_rows"]) == ("2024-03", f"{root}/2024-03", 7)
    assert registry.latest(spark, root, "2024-01")["version"] == "2024-01" and registry.latest(spark, root, "2023") is None


def test_unfinished_and_damaged_versions_are_passed_over(spark, tmp_path):
    root = str(tmp_path / "models")
    _publish(spark, root, "1")
    _publish(spark, root, "2")
    _table(spark, f"{root}/3/factor")  # a run that ended before its model was written
    with pytest.raises(FileNotFoundError, match="3 is unfinished"):
        registry.publish(spark, root, "3", f"{root}/3", 1, ("model", "factor"))
    assert registry.latest(spark, root)["version"] == "2"
    (tmp_path / "models" / "2" / "model" / "_SUCCESS").unlink()
    assert registry.latest(spark, root)["version"] == "1"
    (tmp_path / "models" / "published" / ".half").write_text("{")  # written aside, never moved into place
    assert registry.published(spark, root).count() == 2


def test_a_version_is_published_once(spark, tmp_path):
    root = str(tmp_path / "models")
    _publish(spark, root, "1")
    with pytest.raises(FileExistsError):
        registry.publish(spark, root, "1", f"{root}/1", 9, ("model", "factor"))
    assert registry.latest(spark, root)["n_rows"] == 7


@pytest.fixture(scope="module")
def rows(spark):
    x = F.col("id")
    return spark.range(600).select(
        (x * 7919 % 997).cast("decimal(18,2)").alias("saldo"), (x % 31).cast("decimal(18,2)").alias("potencial"), (x % 7).alias("recorrido"),
        (20 + x % 50).alias("edad"), (F.log10(1.0 + (x * 7919 % 997)) + (x % 7) / 10).alias("y"),
    )


def test_weights_are_poisson_draws(spark, rows):
    w = rows.select(*[training.tree_weight(t, 5).alias(f"w{t}") for t in range(8)]).toPandas()
    assert abs(w.to_numpy().mean() - 1) < 0.05 and abs(w.to_numpy().var() - 1) < 0.12
    assert abs((w == 0).to_numpy().mean() - math.exp(-1)) < 0.03
    assert abs(w.corr().to_numpy()[~__import__("numpy").eye(8, dtype=bool)]).max() < 0.2  # trees draw apart


def test_forest_is_the_same_on_any_layout(spark, rows):
    got = []
    for n in (1, 3, 9):
        model = training.fit_forest(training.fixed_layout(rows, "y", n), "y", num_trees=4, max_depth=3)
        p = model.transform(rows).select("prediction").orderBy("saldo", "potencial").collect()
        got.append([r[0] for r in p] + [v for _, v in training.feature_importances(model)])
    for other in got[1:]:
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got[0], other, strict=True))


def test_forest_is_the_mean_of_its_trees_and_survives_saving(spark, rows, tmp_path):
    model = training.fit_forest(rows, "y", num_trees=3, max_depth=2)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = training.load(str(tmp_path / "m"))
    forest = again.stages[-1]
    assert forest.getNumTrees == 3
    for r in again.transform(rows).limit(50).collect():
        assert math.isclose(r["prediction"], sum(t.predict(r["features"]) for t in forest.trees) / 3, rel_tol=1e-12)
    m = training.regression_metrics(again.transform(rows), "y").first()
    assert m["rmse"] < 0.6 * rows.agg(F.stddev_pop("y")).first()[0]


def test_parts_go_by_the_number_of_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_PART", 100)
    assert training.fixed_layout(rows, "y").rdd.getNumPartitions() == 7
