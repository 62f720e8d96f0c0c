import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.operators import forecast as FC
from tillcast.operators import supervised as SV
from tillcast.operators import trees as T
from tillcast.plans.model_store import current_folder
from tillcast.plans import comparison, scoring, training
from tillcast.session import materialise

SMALL = {
    "ridge": [{"alpha": 1.0}, {"alpha": 10.0}], "random_forest": [{"n_estimators": 4, "max_depth": 3}],
    "gbt": [{"max_depth": 2, "learning_rate": 0.2, "max_iter": 4}],
    "gbt_leafwise": [{"n_estimators": 4, "max_depth": -1, "learning_rate": 0.2, "num_leaves": 5}],
}


def wave(series, days, seed):
    rng, i = np.random.default_rng(seed), np.arange(days)
    return pd.DataFrame({
        "series": series, "date": [dt.date(2019, 3, 1) + dt.timedelta(days=int(k)) for k in i],
        "revenue": (400 + 0.9 * i + 120 * (i % 7 == 2) + rng.gamma(2, 30, days)).round(2),
        "purchases": rng.integers(3, 40, days), "unique_streams": rng.integers(2, 22, days),
        "unique_customers": rng.integers(1, 18, days), "total_views": rng.integers(20, 90, days),
    })


@pytest.fixture(scope="module")
def features(spark):
    frame = pd.concat([wave("overall", 420, 3), wave("Eire", 360, 4), wave("Malta", 110, 5)])
    return materialise(SV.build_features(spark.createDataFrame(frame)), "features")


@pytest.fixture(scope="module")
def rows(features):
    return materialise(features.dropna(), "rows")


def slow_best_split(x, y, least):
    """Every cut of every feature, by sums of squares."""
    def spread(v):
        return ((v - v.mean()) ** 2).sum()

    best = (0.0, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= least:
                best = max(best, (spread(y) - spread(y[left]) - spread(y[~left]), (f, cut)), key=lambda b: b[0])
    return best[1]


@pytest.mark.parametrize("seed", range(5))
def test_first_split_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 9, (60, 4)).astype(float), rng.normal(size=60)
    tree = T.fit_boosted(x, y, 1, 1.0, 1, None, 5)
    f, cut = slow_best_split(x, y, 5)
    left = x[:, f] <= cut
    np.testing.assert_allclose(tree.predict(x), np.where(left, y[left].mean(), y[~left].mean()))


def test_trees_predict_what_they_were_fitted_to():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(80, 3))
    y = x[:, 0] * 2 + x[:, 1]
    np.testing.assert_allclose(T.fit_boosted(x, y, 1, 1.0, None, None, 1).predict(x), y, atol=1e-9)
    assert len(T.fit_boosted(x, y, 1, 1.0, None, 6, 1).value) == 11
    flat = T.fit_boosted(x, np.full(80, 3.0), 50, 0.1, 3, None, 1)
    assert len(flat.root) == 1 and (flat.predict(x) == 3.0).all()
    one = T.fit_forest(x[:1], y[:1], 3, None, 1, 1)
    np.testing.assert_allclose(one.predict(x[:1]), y[:1])


def test_every_family_is_finite_on_every_series(rows):
    best = {name: grid[0] for name, grid in SMALL.items()}
    out = comparison.holdout_predictions(rows, best).toPandas()
    assert np.isfinite(out["predicted"]).all()
    assert set(zip(out["series"], out["model"])) == {(s, m) for s in ("overall", "Eire") for m in FC.ALL_MODELS} | {
        ("Malta", m) for m in FC.ALL_MODELS}
    assert out.groupby(["series", "date"]).size().eq(len(FC.ALL_MODELS)).all()


def test_tuning_tries_every_candidate(rows):
    tuned = comparison.tune(rows, SMALL).toPandas()
    assert len(tuned) == 5 and tuned.groupby("family")["is_best"].sum().eq(1).all()
    best = tuned.loc[tuned.groupby("family")["cv_mae"].idxmin()]
    assert best["is_best"].all()


def test_compare_store_and_answer(spark, rows, features, tmp_path):
    done = comparison.compare_and_store(rows, str(tmp_path / "m"), SMALL)
    scores = done.metrics.where(F.col("model").isin(*FC.LEARNED)).groupBy("model").avg("normalised_mae").toPandas()
    assert done.winner == scores.sort_values(["avg(normalised_mae)", "model"])["model"].iloc[0]
    assert training.selected_approach(spark, str(tmp_path / "m"))[0] == done.winner
    skipped = {r["series"]: r["skip_reason"] for r in done.training.registry.collect()}
    assert set(skipped) == {"overall", "Eire", "Malta"}
    held = spark.read.option("header", True).csv(f"{current_folder(spark, str(tmp_path / 'm'))}/overall_holdout")
    assert held.count() == SV.chronological_holdout(rows).where("role = 'test' AND series = 'overall'").count()

    known = done.training.registry.where("skip_reason IS NULL").select("series")
    asked = spark.createDataFrame([("EIRE ", "2020-01-31"), ("overall", "2020-02-01"), ("eire", "2035-01-01")], "country string, date string")
    out = scoring.batch_predict(
        asked, features, known, training.stored_scorer(spark, str(tmp_path / "m")), summary=done.training.features,
    ).toPandas().set_index("country")
    assert list(out.loc[["EIRE ", "overall", "eire"], "status"]) == ["ok", "ok", "out_of_range"]
    assert np.isfinite(out.loc[["EIRE ", "overall"], "predicted_revenue_next_30d"]).all()
    assert out.loc["overall", "drift_detected"] in (True, False)
    events = scoring.predict_events(scoring.batch_predict(
        asked, features, known, training.stored_scorer(spark, str(tmp_path / "m")), summary=done.training.features,
    ), done.winner, "2020-03-01")
    assert events.count() == 2 and events.where("predicted_revenue_next_30d IS NULL").count() == 0


def test_stored_models_predict_as_fitted(rows):
    jobs = FC.candidates({n: g[:1] for n, g in SMALL.items()})
    models = materialise(FC.fit_models(rows, jobs), "models")
    stored = FC.predict_models(rows.select("series", "date", *SV.feature_names()), models)
    again = FC.held_out_predictions(
        rows.withColumn("role", F.explode(F.array(F.lit("train"), F.lit("test")))), jobs,
    ).withColumnRenamed("predicted", "fresh")
    both = stored.join(again, ["series", "date", "family"])
    assert both.count() == 4 * rows.count()
    assert both.where(F.abs(F.col("predicted") - F.col("fresh")) > 1e-6 * (1 + F.abs("fresh"))).count() == 0


def test_importance_finds_the_feature_that_matters(rows):
    made = rows.withColumn(SV.TARGET, F.col("revenue_sum_28d") * 3.0)
    models = FC.fit_models(made, FC.candidates({"gbt": [{"max_depth": 3, "learning_rate": 0.3, "max_iter": 20}]}))
    top = FC.permutation_importance(made, models, top=3).toPandas()
    first = top.sort_values("importance", ascending=False).groupby("series").head(1)
    assert (top.groupby("series").size() == 3).all()
    assert (first.loc[first["series"] != "Malta", "feature"] == "revenue_sum_28d").all()
    # Malta's eleven rows are fewer than two leaves hold: its trees never split.
    assert (top.loc[top["series"] == "Malta", "importance"] == 0).all()


def test_retraining_knows_nothing_after_its_date(spark, tmp_path):
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=k) for k in range(260)]
    lines = pd.DataFrame({
        "date": days * 2, "country": ["Eire"] * 260 + ["Malta"] * 260, "customer_id": list(range(520)), "invoice_clean": [str(k) for k in range(520)],
        "stream_id": ["s"] * 520, "price": [5.0 + k % 11 for k in range(520)], "times_viewed": [k % 7 for k in range(520)],
    })
    frame = spark.createDataFrame(lines).withColumn("customer_id", F.col("customer_id").cast("bigint"))
    cut, hp = days[199], {"family": "ridge", "hyperparameters": {"alpha": 1.0}}
    early = training.retrain(frame, str(tmp_path / "a"), as_of=cut, **hp)
    alone = training.retrain(frame.where(F.col("date") <= F.lit(cut)), str(tmp_path / "b"), **hp)
    late = training.retrain(frame, str(tmp_path / "c"), **hp)

    def weights(folder):
        return {r["series"]: r["weights"] for r in training.load_models(spark, str(tmp_path / folder)).collect()}

    assert early.registry.agg(F.max("last_date")).first()[0] == cut - dt.timedelta(days=30)
    assert late.registry.agg(F.max("last_date")).first()[0] == days[-1] - dt.timedelta(days=30)
    a, b, c = weights("a"), weights("b"), weights("c")
    assert alone.n_transactions == early.n_transactions < late.n_transactions
    for name in ("overall", "Eire", "Malta"):
        np.testing.assert_allclose(a[name], b[name], rtol=1e-6, atol=1e-6)
        assert not np.allclose(a[name], c[name])


def test_retraining_from_folders_equals_retraining_on_their_lines(spark, tmp_path):
    """Lines of both folders count, each folder cleaned on its own; a broken file is skipped."""
    folders = [tmp_path / "one", tmp_path / "two"]
    for number, folder in enumerate(folders):
        folder.mkdir()
        days = [dt.date(2019, 1, 1) + dt.timedelta(days=90 * number + k) for k in range(90)]
        (folder / "invoices-1.json").write_text(json.dumps([
            {"country": "Eire", "customer_id": k, "invoice": str(k), "price": 4.0 + k % 13, "stream_id": "s", "times_viewed": k % 5,
             "year": str(d.year), "month": str(d.month), "day": str(d.day)} for k, d in enumerate(days)
        ]))
    (folders[1] / "invoices-2.json").write_text("{broken")
    names = [str(f) for f in folders]
    hp = {"family": "ridge", "hyperparameters": {"alpha": 1.0}}
    done = training.retrain_directories(spark, names, str(tmp_path / "m"), **hp)
    registry = {r["series"]: r for r in done.registry.collect()}
    assert set(registry) == {"overall", "Eire"} and done.n_transactions == 180
    assert registry["overall"]["data_dirs"] == names
    assert registry["overall"]["n_training_rows"] == 180 - 69 - 30
    assert training.load_models(spark, str(tmp_path / "m")).count() == 2


def test_models_of_origins_are_those_of_their_own_rows(spark, tmp_path):
    random = np.random.default_rng(5)
    first, names = dt.date(2020, 1, 1), ["a", "b", "still"]
    days = pd.DataFrame({"date": [first + dt.timedelta(days=k) for k in range(90)]})
    days["series"] = "overall"
    days["a"], days["b"] = 1e6 + random.normal(0, 5, 90), random.uniform(0, 1, 90)
    days["still"] = np.where(np.arange(90) < 60, 3.0, 4.0)
    days[SV.TARGET] = 2 * days["a"] - 7 * days["b"] + random.normal(0, 0.1, 90)
    origins = pd.DataFrame({"series": "overall", "origin": [first + dt.timedelta(days=k) for k in (55, 40, 200)]})
    origins["last_observed"] = origins["origin"]
    train, asked = spark.createDataFrame(days), spark.createDataFrame(origins)
    for family, hp in (("ridge", {"alpha": 10.0}), ("gbt", {"max_iter": 5})):
        found = FC.fit_at_origins(train, asked, family, hp, 30, names, per_task=2).toPandas()
        assert sorted(found["n_train"]) == [11, 26, 90]
        for row in found.itertuples():
            own = days.iloc[:row.n_train]
            x, y = own[names].to_numpy(), own[SV.TARGET].to_numpy()
            expected = FC._applied(FC.fit_arrays(x, y, family, hp), x)
            assert np.allclose(FC._applied(FC._restored(row), x), expected, rtol=1e-9)
