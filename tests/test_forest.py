import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.operators import model
from stopwise.operators.forest import BINS, DelayForest, find_cuts, fit_forest, grow_tree
from stopwise.plans import catalog
from stopwise.schemas import FEATURES

OPTIONS = {"num_trees": 12, "max_depth": 6, "min_instances": 2, "seed": 7}


def labelled(spark, n):
    return spark.sql(f"""SELECT timestamp '2024-01-01 06:00:00' + make_interval(0,0,0,0,0,0,id) AS timestamp,
        36.7D + id % 7 / 1000D AS lat, -4.45D + id / 1000D AS lon, 'A1' AS stop_id, 1 AS stop_sequence, 10D AS distance_m,
        timestamp '2024-01-01 06:05:00' AS scheduled_time, timestamp '2024-01-01 06:04:00' AS actual_time,
        300 - id AS seconds_to_scheduled, CAST(id % 300 AS bigint) AS true_delay_seconds FROM range({n})""")


def test_model_is_fitted_on_all_training_rows(spark, monkeypatch):
    given = []

    def fit(rows, **options):
        given.append(rows.count())
        return fit_delay_model(rows, num_trees=3, max_depth=3)

    fit_delay_model = model.fit_delay_model
    monkeypatch.setattr(catalog, "_training", lambda spark, folder: labelled(spark, 4000))
    monkeypatch.setattr(model, "fit_delay_model", fit)
    catalog._model(spark, "all-rows")
    catalog._model(spark, "all-rows")
    rows = catalog._clean_split(spark, "all-rows").filter("is_train").count()
    assert rows > 3000 and given == [rows]


def table(spark, n=600):
    return spark.range(n).select(
        (F.col("id") % 40).cast("double").alias("a"), (F.col("id") * 7 % 23).cast("int").alias("b"),
        F.lit(1.5).alias("c"), (F.col("id") % 40 * 3 + F.col("id") * 7 % 23 % 5).alias("y"))


def test_cuts_are_those_of_all_rows(spark):
    """A value that one row in many thousands has is a cut of its own."""
    df = spark.range(50_000).select(F.when(F.col("id") == 31_337, 9.0).otherwise(F.col("id") % 3).alias("a"),
                                    F.col("id").cast("double").alias("b"))
    few, many = find_cuts(df, ["a", "b"])
    assert few.tolist() == [0.5, 1.5, 5.5]
    assert len(many) == BINS - 1 and abs(many - np.arange(1, BINS) * 50_000 / BINS).max() < 3


def test_root_is_the_best_cut():
    rng = np.random.default_rng(3)
    bins, count = rng.integers(0, 6, (200, 2)).astype(np.uint8), rng.integers(1, 4, 200)
    label = np.where(bins[:, 1] > 2, 50.0, 0.0) + rng.integers(0, 20, 200)
    tree = grow_tree(bins, label, count, np.random.default_rng(5), max_depth=1, min_instances=2, tried=2)
    w = np.random.default_rng(5).poisson(count)

    def error(side):
        return (w[side] * (label[side] - np.average(label[side], weights=w[side])) ** 2).sum()

    left = {(f, c): bins[:, f] <= c for f in range(2) for c in range(5)}
    best = min(left, key=lambda k: error(left[k]) + error(~left[k]))
    assert (tree["feature"][0], tree["cut"][0]) == best and tree["feature"].tolist()[1:] == [255, 255]
    want = [np.average(label[s], weights=w[s]) for s in (left[best], ~left[best])]
    assert np.allclose(tree["value"], want)
    gain = error(w >= 0) - error(left[best]) - error(~left[best])
    assert np.isclose(tree["importance"].sum(), gain)


def test_same_trees_however_rows_lie_and_after_saving(spark, tmp_path):
    df = table(spark)
    one = fit_forest(df.coalesce(1), ["a", "b", "c"], "y", **OPTIONS)
    two = fit_forest(df.repartition(5, "b"), ["a", "b", "c"], "y", **OPTIONS)
    saved = DelayForest.load(spark, two.save(f"{tmp_path}/model"))
    assert one.cuts[0].tolist() == two.cuts[0].tolist()
    scores = [sorted(r["prediction"] for r in m.transform(df).collect()) for m in (one, two, saved)]
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == 600
    assert one.trees.count() == OPTIONS["num_trees"]
    shares = one.importances()
    assert np.isclose(shares.sum(), 1) and shares[2] == 0 and (shares >= 0).all()


def test_forest_learns_and_stays_between_the_labels(spark):
    df = table(spark)
    scored = fit_forest(df, ["a", "b"], "y", **{**OPTIONS, "max_depth": 25, "num_trees": 40}).transform(df)
    error, low, high = scored.agg(F.avg(F.abs(F.col("y") - F.col("prediction"))),
                                  F.min("prediction"), F.max("prediction")).first()
    assert error < 10 and low >= 0 and high <= 39 * 3 + 4


def test_rows_without_a_feature_are_left_out_and_none_to_fit_on_is_an_error(spark):
    df = table(spark, 50)
    odd = df.unionByName(df.limit(2).withColumn("a", F.lit(None).cast("double"))).unionByName(
        df.limit(1).withColumn("a", F.lit(float("nan"))))
    plain, fitted = (fit_forest(x, ["a", "b", "c"], "y", **OPTIONS) for x in (df, odd))
    assert fitted.transform(odd).count() == 50
    assert plain.transform(df).collect() == fitted.transform(df).collect()
    with pytest.raises(ValueError, match="no rows to fit on"):
        fit_forest(odd.filter("a IS NULL"), ["a", "b", "c"], "y", **OPTIONS)


def test_delay_model_keeps_its_size(spark):
    rows = model.add_features(labelled(spark, 60))
    assert model.fit_delay_model(rows).trees.count() == 400
    assert len(FEATURES) == 9
