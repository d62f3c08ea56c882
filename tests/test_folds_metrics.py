import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from peerledger.operators import folds, metrics, sampling
from peerledger.operators.ranking import hash_rank


def providers(spark, n=200):
    return spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(n)], "rndrng_npi bigint, fraud_label int")


def claim_rows(spark, parts=4):
    records = [(i % 200, 2000 + i // 200, int(i % 200 % 20 == 0)) for i in range(2000)]
    return spark.createDataFrame(records, "rndrng_npi bigint, year int, fraud_label int").repartition(parts)


def digest(key, seed=42):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_rank_is_exact(spark, digits):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(500)], "id int, g int")
    got = {r["id"]: r["rank"] for r in hash_rank(df, "id", 42, ["g"], digits=digits).collect()}
    for g in (None, 0, 1):
        members = sorted((i for i in range(500) if (None if i % 3 == 0 else i % 2) == g), key=digest)
        assert [got[i] for i in members] == list(range(1, len(members) + 1))


def test_folds_are_balanced_and_stable(spark):
    got = [rows(folds.stratified_folds(providers(spark).repartition(n), 3)) for n in (1, 3, 8)]
    assert got[0] == got[1] == got[2]
    sizes = {}
    for _, label, fold in got[0]:
        sizes[label, fold] = sizes.get((label, fold), 0) + 1
    for label in (0, 1):
        counts = [sizes[label, f] for f in range(3)]
        assert max(counts) - min(counts) <= 1


def test_too_few_positives_is_an_error(spark):
    with pytest.raises(ValueError, match="fewer than 11"):
        folds.stratified_folds(providers(spark), 11)


def test_rows_follow_their_provider(spark):
    df = folds.assign_folds(claim_rows(spark), 4)
    assert df.count() == 2000
    assert folds.fold_leaks(df).isEmpty()
    table = df.select("rndrng_npi", "fold").distinct()
    train, test = folds.split(df, 1)
    assert train.count() + test.count() == 2000
    semi = folds.semi_split(claim_rows(spark), table, 1)
    columns = ("rndrng_npi", "year")
    assert rows(semi[0], *columns) == rows(train, *columns) and rows(semi[1], *columns) == rows(test, *columns)
    indices = folds.fold_indices(claim_rows(spark), table, 4, ["rndrng_npi", "year"])
    assert indices.count() == 8000
    assert indices.filter("split = 'test'").count() == 2000
    assert rows(indices.filter("fold = 1 and split = 'test'"), *columns) == rows(test, *columns)


def test_undersampling(spark):
    keys = ["rndrng_npi", "year"]
    got = [rows(sampling.undersample(claim_rows(spark, n), keys, ratio=3)) for n in (1, 3, 8)]
    assert got[0] == got[1] == got[2]
    assert sum(r[2] for r in got[0]) == 100
    frac = 300 / 1900
    wanted = {
        (n, y)
        for n, y, label in rows(claim_rows(spark))
        if label == 1 or int(digest(f"{n}|{y}")[:8], 16) / 2**32 < frac
    }
    assert {(r[0], r[1]) for r in got[0]} == wanted
    exact = sampling.undersample(claim_rows(spark), keys, ratio=3, exact=True)
    assert rows(exact.groupBy("fraud_label").count()) == [(0, 300), (1, 100)]
    everything = sampling.undersample(claim_rows(spark), keys, ratio=1000)
    assert everything.count() == 2000


def test_fraction_without_negatives():
    assert sampling.ClassCounts(5, 0).keep_fraction(100) == 0.0


# ---- Metrics against brute force ----------------------------------------------------------------


def brute(pairs, threshold):
    p, n = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    ap = tp = fp = 0
    for s in sorted({s for _, s in pairs}, reverse=True):
        here = [y for y, t in pairs if t == s]
        tp, fp = tp + sum(here), fp + len(here) - sum(here)
        ap += sum(here) / p * tp / (tp + fp) if p else 0.0
    wins = sum((a > b) + 0.5 * (a == b) for y, a in pairs if y for z, b in pairs if not z)
    hit = sum(1 for y, s in pairs if y and s >= threshold)
    false = sum(1 for y, s in pairs if not y and s >= threshold)
    return {
        "aucpr": ap,
        "auroc": wins / (p * n) if p * n else 0.0,
        "f2": 5 * hit / (5 * hit + 4 * (p - hit) + false) if hit else 0.0,
        "tpr": hit / p if p else 0.0,
        "tnr": (n - false) / n if n else 0.0,
        "precision": hit / (hit + false) if hit + false else 0.0,
        "fraud_count": p,
        "total_count": p + n,
    }


def scored(spark, seed, ties, classes=(0, 1)):
    rng = random.Random(seed)
    draw = (lambda: rng.choice([0.1, 0.2, 0.9])) if ties else rng.random
    data = [(f, rng.choice(classes), draw()) for f in (0, 1, None) for _ in range(80)]
    return data, spark.createDataFrame(data, "fold int, label int, score double")


@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("classes", [(0, 1), (0,), (1,), (0, 0, 0, 0, 1)])
@pytest.mark.parametrize("buckets", [2, 7])
def test_fold_metrics(spark, ties, classes, buckets):
    data, df = scored(spark, 3, ties, classes)
    got = {r["fold"]: r.asDict() for r in metrics.fold_metrics(df, ["fold"], 0.2, buckets=buckets).collect()}
    assert set(got) == {0, 1, None}
    for fold in got:
        expected = brute([(y, s) for f, y, s in data if f == fold], 0.2)
        assert {k: got[fold][k] for k in expected} == pytest.approx(expected)


def test_ungrouped_metrics_do_not_depend_on_layout(spark):
    data, df = scored(spark, 5, False)
    expected = brute([(y, s) for _, y, s in data], 0.5)
    for n in (1, 3, 8):
        got = metrics.ranking_metrics(df.repartition(n)).first()
        assert (got["aucpr"], got["auroc"]) == pytest.approx((expected["aucpr"], expected["auroc"]))
    cells = metrics.threshold_metrics(df, 0.5).first().asDict()
    assert {k: cells[k] for k in ("f2", "tpr", "tnr", "precision")} == pytest.approx(
        {k: expected[k] for k in ("f2", "tpr", "tnr", "precision")}
    )


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.4)], "label int, score double")
    assert rows(metrics.confusion(df, 0.5)) == [(1, 1, 1, 0)]


def test_sweep_equals_single_thresholds(spark):
    _, df = scored(spark, 9, True)
    points = [0.05, 0.1, 0.2, 0.5, 2.0]
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(df, points).collect()}
    assert sorted(sweep) == points
    for t in points:
        cells = metrics.threshold_metrics(df, t).first()
        got = sweep[t]
        assert [got[c] for c in ("tp", "fp", "tn", "fn")] == [cells[c] for c in ("tp", "fp", "tn", "fn")]
        assert (got["recall"], got["f2"]) == pytest.approx((cells["tpr"], cells["f2"]))
        assert got["alerts"] == got["tp"] + got["fp"]


@pytest.mark.parametrize("record", [(2, 0.5), (1, None), (None, 0.5)])
def test_bad_input_raises(spark, record):
    df = spark.createDataFrame([(0, 0.1), record], "label int, score double")
    with pytest.raises(Exception, match="must be 0 or 1"):
        metrics.confusion(df).collect()


def test_cv_summary(spark):
    columns = metrics.SUMMARISED
    df = spark.createDataFrame([(1, *[0.4] * 6), (0, *[0.2] * 6)], "fold int, " + ", ".join(f"`{c}` double" for c in columns))
    got = metrics.cv_summary(df).first()
    assert got["aucpr_mean"] == pytest.approx(0.3) and got["tnr_std"] == pytest.approx(0.1)  # population deviation
    assert got["f2_scores"] == [0.2, 0.4] and got["n_folds"] == 2
    assert metrics.cv_mean(df).select(F.round("auroc", 6)).first()[0] == 0.3
