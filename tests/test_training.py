import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from helpers import rows
from peerledger.catalog import model_queries
from peerledger.plans import training

OPTIONS = replace(training.TrainingOptions(folds=2, trials=2, ratio=3), parallelism=2).with_rounds(2)

NOTHING = training.Prepared(None, [], {}, OPTIONS)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(1)
    records = []
    for npi in range(120):
        bad = int(npi % 6 == 0)
        for year in (2019, 2020):
            records.append((npi, year, rng.gauss(2.0 * bad, 1.0), None if rng.random() < 0.1 else rng.random(), "7", bad))
    return spark.createDataFrame(records, "rndrng_npi bigint, year int, z double, noise double, t string, fraud_label int")


@pytest.fixture(scope="module")
def data(frame):
    return training.prepare(frame, ["rndrng_npi", "year"], OPTIONS)


def test_prepared_frame(data):
    assert data.features == ["year", "z", "noise", "t"]
    assert data.total() == training.sampling.ClassCounts(40, 200)
    train, expected = data.training_rows(0)
    assert train.filter("fold = 0").isEmpty()
    assert train.filter("fraud_label = 1").count() == data.total(0).positives
    assert abs(train.count() - expected) < 30
    plain = replace(data, options=replace(OPTIONS, undersample=False))
    assert plain.training_rows(0)[0].count() == data.frame.filter("fold <> 0").count()


def test_draws_are_seeded_and_in_range():
    for learner in (OPTIONS.learner_a, OPTIONS.learner_b):
        one, two = (learner.draw(random.Random(7)) for _ in range(2))
        assert one == two and set(one) == set(learner.space)
        assert all(learner.space[k].low <= v <= learner.space[k].high for k, v in one.items())


def test_cross_validation_and_search(data):
    per_fold = training.cross_validate(data, OPTIONS.learner_a, OPTIONS.learner_a.defaults())
    assert per_fold.count() == 2
    assert per_fold.agg(F.sum("total_count")).first()[0] == 240  # test sides are never undersampled
    assert per_fold.agg(F.avg("auroc")).first()[0] > 0.6
    trials = training.search(data, OPTIONS.learner_b)
    params, means = training.best_trial(trials)
    assert trials.count() == 2 and set(params) == set(training.SPACE_B)
    assert means["aucpr"] == max(r["metrics"]["aucpr"] for r in trials.collect())


def test_whole_run_saves_and_scores(spark, frame, data, tmp_path):
    log = str(tmp_path / "log")
    result = training.train(frame, OPTIONS, log=log, run="r1")
    assert result.oof.count() == 240
    assert result.classes.first()["fraud_count"] == 40
    assert all(r.first()["total_count"] == 240 for r in result.base_reports.values())
    logged = Counter((r["run_id"].rsplit("-", 1)[0] if "trial" in r["run_id"] else r["run_id"], r["parent_id"]) for r in spark.read.parquet(log).collect())
    trials = {("r1/a/trial", "r1/a"): 2, ("r1/b/trial", "r1/b"): 2}
    assert logged == Counter(trials | {("r1/a", "r1"): 1, ("r1/b", "r1"): 1, ("r1", None): 1})
    assert result.oof.select("row_key").distinct().count() == 240
    report = result.report.first()
    assert report["in_sample"] and report["auroc"] > 0.6
    shares = result.top.agg(F.sum("importance_a"), F.sum("importance_b")).first()
    assert shares[0] == pytest.approx(1) and shares[1] == pytest.approx(1)
    training.save(result, str(tmp_path / "out"))
    loaded = PipelineModel.load(str(tmp_path / "out" / "model"))
    fresh = frame.drop("fraud_label").withColumn("unseen", F.lit(3.0))
    by_name = training.score_features(fresh, str(tmp_path / "out"), ["rndrng_npi", "year"])
    known = {k: v for k, v in rows(training.score_table(data.frame, result.model), "row_key", "score")}
    assert all(abs(known[k] - v) < 1e-12 for k, v in rows(by_name, "row_key", "score"))
    assert training.score_features(fresh.drop("noise"), str(tmp_path / "out"), ["rndrng_npi", "year"]).count() == 240
    before = training.score_table(data.frame, result.model)
    assert rows(training.score_table(data.frame, loaded), "row_key", "score") == rows(before, "row_key", "score")
    assert before.filter("score <= 0 or score >= 1").isEmpty()
    assert spark.read.json(str(tmp_path / "out" / "best_params")).count() == 1
    top = spark.read.option("header", True).csv(str(tmp_path / "out" / "feature_importance"))
    assert top.columns == ["feature", "importance_a", "importance_b", "importance_avg"]


def test_samples_are_made_once(data, monkeypatch):
    made = []
    fresh = replace(data)
    monkeypatch.setattr(training, "stage", lambda df, name: made.append(name) or df)
    training.search(fresh, OPTIONS.learner_a)
    training.search(fresh, OPTIONS.learner_b)
    assert made.count("training-sample") == 2  # one per fold, whatever the trials and learners


def test_kept_categoricals_reach_the_model(spark, tmp_path):
    rng = random.Random(4)
    records = [(i, 2020, rng.random(), "I" if i % 2 else "O", int(i % 4 == 1)) for i in range(160)]
    kinds = "rndrng_npi bigint, year int, noise double, rndrng_prvdr_ent_cd string, fraud_label int"
    table = spark.createDataFrame(records, kinds)
    options = replace(OPTIONS, trials=1)
    result = training.train(table, options, ["rndrng_npi", "year"])
    assert {"rndrng_prvdr_ent_cd_ohe_I", "rndrng_prvdr_ent_cd_ohe_O"} <= set(result.features)
    training.save(result, str(tmp_path / "kept"))
    new = spark.createDataFrame([(1, 2021, 0.5, "I"), (2, 2021, 0.5, "never seen"), (3, 2021, 0.5, None)], kinds.rsplit(",", 1)[0])
    assert training.score_features(new, str(tmp_path / "kept"), ["rndrng_npi", "year"]).count() == 3
    with pytest.raises(ValueError, match="without a label"):
        training.train(table.withColumn("fraud_label", F.lit(None).cast("int")), options, ["rndrng_npi", "year"])


def test_prior_correction(spark):
    # 1:1 training odds on a population with a tenth of the negatives kept
    got = spark.range(1).select(training.correct_prior(F.lit(0.5), 0.1).alias("p")).first()["p"]
    assert got == pytest.approx(0.1 / 1.1)


def test_model_queries_run_the_library_defaults(monkeypatch):
    seen = {}
    monkeypatch.setattr(model_queries, "feature_table", lambda *tables: None)
    monkeypatch.setattr(model_queries, "stage", lambda df, name: df)
    for view in ("detail", "summary", "some_summary", "exclusions"):
        monkeypatch.setattr(model_queries.V, view, lambda spark, sf: None)
    monkeypatch.setattr(training, "prepare", lambda table, keys, options: replace(NOTHING, options=options))
    monkeypatch.setattr(training, "search", lambda data, learner, trials=None: seen.update(learner=learner, trials=trials or data.options.trials))
    default = training.TrainingOptions()
    options = model_queries.prepared(None, "").options
    assert (options.learner_a, options.learner_b, options.trials) == (default.learner_a, default.learner_b, default.trials)
    model_queries.hpo_search(None, "")
    assert seen == {"learner": default.learner_a, "trials": default.trials}


def test_model_queries_train_on_all_providers(monkeypatch):
    for view in ("detail", "summary", "some_summary", "exclusions"):
        monkeypatch.setattr(model_queries.V, view, lambda spark, sf, view=view: view)
    monkeypatch.setattr(model_queries, "feature_table", lambda *tables: tables[:3])
    monkeypatch.setattr(model_queries, "stage", lambda df, name: df)
    monkeypatch.setattr(training, "prepare", lambda table, keys, options: table)
    assert model_queries.prepared(None, "") == ("detail", "summary", "exclusions")


def test_penalised_leaves_follow_the_closed_form(spark):
    import random

    import numpy as np
    from pyspark.ml.linalg import Vectors

    draw = random.Random(2)
    points = [(draw.random(), draw.random()) for _ in range(300)]
    rows = [(Vectors.dense(x), int(x[0] + 0.4 * draw.random() > 0.8), 1.0 + i % 3) for i, x in enumerate(points)]
    train = spark.createDataFrame(rows, ["features", "fraud_label", "weight"])
    learner = replace(training.Learner("b", training.SPACE_B), rounds=4)
    model = learner.estimator(learner.defaults(), len(rows)).fit(train)
    old = [[tree.predict(Vectors.dense(x)) for x in points] for tree in model.trees]
    leaf = [[tree.predictLeaf(Vectors.dense(x)) for x in points] for tree in model.trees]
    y, w = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for l1, l2 in ((0.0, 3.0), (4.0, 0.5), (1e6, 0.0)):
        refitted = training.refit_leaves(model, train, l1, l2)
        assert refitted.treeWeights == model.treeWeights
        before = np.zeros(len(points))
        for t, weight in enumerate(model.treeWeights):
            chance = 1 / (1 + np.exp(-before))
            for number in set(leaf[t]):
                inside = np.array(leaf[t]) == number
                g, h = (w * (chance - y))[inside].sum(), (w * chance * (1 - chance))[inside].sum()
                expected = -np.sign(g) * max(abs(g) - l1, 0.0) / (h + l2) / 2
                got = refitted.trees[t].predict(Vectors.dense(points[int(np.flatnonzero(inside)[0])]))
                assert got == pytest.approx(expected, abs=1e-9)
            before += 2 * weight * np.array(old[t])


def test_penalties_change_predictions(data):
    learner = replace(OPTIONS.learner_b, rounds=2)
    train, rows = data.training_rows(0)
    plain = learner.defaults()
    scored = data.frame
    for name, params in (("plain", plain), ("ridge", plain | {"l2": 5.0})):
        model = learner.fit(train, params, rows)
        scored = training.score(scored.drop("prediction_b", "raw_b", "probability_b"), model, "b").withColumnRenamed("score_b", name)
    assert scored.filter("plain <> ridge").count() > 0


def test_fits_at_once_and_one_by_one_agree(data):
    learner, params = OPTIONS.learner_a, OPTIONS.learner_a.defaults()
    alone = replace(data, options=replace(data.options, parallelism=1))
    results = [sorted(map(tuple, training.cross_validate(d, learner, params).collect())) for d in (data, alone)]
    assert results[0] == results[1]


def test_stacker_meets_its_optimality_conditions(spark):
    """At the optimum of the summed logistic loss plus half the squared norm, the gradient of each weight and of the intercept is 0."""
    import random

    import numpy as np

    draw = random.Random(9)
    rows = [(a := draw.random(), b := draw.random(), int(a + 0.5 * b + 0.3 * draw.random() > 1.1)) for _ in range(400)]
    oof = spark.createDataFrame(rows, "score_a double, score_b double, fraud_label int")
    for strength in (1.0, 0.05):
        stacker = training.fit_stacker(oof, strength)
        x, y = np.array([r[:2] for r in rows]), np.array([r[2] for r in rows])
        w, c = np.array(stacker.coefficients.toArray()), stacker.intercept
        chance = 1 / (1 + np.exp(-(x @ w + c)))
        assert np.abs(x.T @ (chance - y) + w / strength).max() < 0.02
        assert abs((chance - y).sum()) < 0.02


def test_tasks_of_large_fits():
    """Samples of up to 800,000 rows keep 50,000 rows a task; larger ones do not start a task per 50,000 rows at every tree level."""
    assert [training.fit_tasks(n) for n in (0, 1, 50_001, 393_000, 800_000, 3_200_000, 3_900_000)] == [1, 1, 2, 8, 16, 16, 20]
