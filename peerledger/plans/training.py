"""Folds, search, out-of-fold scores, stacking and final models, all on distributed frames."""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.functions.hashing import key_text
from peerledger.operators import encode, folds, metrics, sampling
from peerledger.operators.clean import audit_nulls
from peerledger.operators.labels import class_distribution
from peerledger.plans import boosting, runlog
from peerledger.plans.features import ROW_KEY, row_keys
from peerledger.session import delete_path, fresh_path, stage, stage_counted, staging

# Trees send values below every threshold left, so missing values form their own branch.
MISSING = -1e12
SPARE = (S.LABEL, S.PROVIDER, ROW_KEY)
EXPECTED = "features array<string>, categories map<string,array<string>>, missing double"
# Training rows of a task of a fit: few as long as tasks are few, for small tables to use all cores, then more, since every tree level
# starts all tasks again.
ROWS_PER_TASK, FEW_TASKS, MOST_ROWS_PER_TASK = 50_000, 16, 200_000


# ---- Search spaces ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Range:
    low: float
    high: float
    whole: bool = False
    log: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.whole:
            return rng.randint(int(self.low), int(self.high))
        if self.log:
            return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        return rng.uniform(self.low, self.high)


# What each learner is searched over.
SPACE_A = {
    "max_depth": Range(3, 10, whole=True),
    "learning_rate": Range(0.01, 0.3, log=True),
    "row_fraction": Range(0.6, 1.0),
    "column_fraction": Range(0.6, 1.0),
    "min_child": Range(1, 10, whole=True),
    "min_gain": Range(0, 5),
    "positive_weight": Range(25, 100),
}
SPACE_B = {
    "max_depth": Range(3, 10, whole=True),
    "learning_rate": Range(0.01, 0.3, log=True),
    "leaves": Range(20, 150, whole=True),
    "row_fraction": Range(0.6, 1.0),
    "column_fraction": Range(0.6, 1.0),
    "min_child": Range(0.001, 10, log=True),
    "l1": Range(0, 10),
    "l2": Range(0, 10),
    "positive_weight": Range(25, 100),
}


@dataclass(frozen=True)
class Learner:
    """A boosted-tree family: its search space and how drawn values become estimator settings.

    `min_gain` is a total over the rows of a node, whereas Spark compares a mean, hence the
    division by the training rows. A leaf limit becomes a depth limit. Where `l1` or `l2` is set, leaf
    values are fitted again with these penalties (`refit_leaves`).
    """

    name: str
    space: Mapping[str, Range]
    rounds: int = 100
    seed: int = 42
    max_bins: int = 64

    def draw(self, rng: random.Random) -> dict[str, float]:
        return {k: r.draw(rng) for k, r in self.space.items()}

    def defaults(self) -> dict[str, float]:
        """A fixed, moderate point of the space."""
        fixed = {"max_depth": 3, "learning_rate": 0.1, "row_fraction": 0.9, "column_fraction": 0.9}
        return fixed | {"min_child": 1, "positive_weight": 25.0}

    def depth(self, params: Mapping[str, float]) -> int:
        depth = int(params["max_depth"])
        return min(depth, math.ceil(math.log2(params["leaves"]))) if "leaves" in params else depth

    def estimator(self, params: Mapping[str, float], rows: int) -> GBTClassifier:
        return GBTClassifier(
            labelCol=S.LABEL,
            featuresCol="features",
            weightCol="weight",
            predictionCol=f"prediction_{self.name}",
            maxIter=self.rounds,
            maxDepth=self.depth(params),
            stepSize=params["learning_rate"],
            subsamplingRate=params["row_fraction"],
            featureSubsetStrategy=str(round(params["column_fraction"], 4)),
            minInstancesPerNode=max(1, round(params["min_child"])),
            minInfoGain=params.get("min_gain", 0.0) / max(1, rows),
            maxBins=self.max_bins,
            seed=self.seed,
        )

    def bins(self, params: Mapping[str, float]) -> tuple:
        """Fits on the same rows that agree in this share their bins."""
        return params["positive_weight"], self.max_bins, self.seed

    def fit(self, train: DataFrame, params: Mapping[str, float], rows: int, binned: boosting.Shared | None = None):
        weighted = sampling.class_weight(train, params["positive_weight"]).select("features", S.LABEL, "weight")
        model = (binned or boosting.Shared(1)).fit(weighted, self.estimator(params, rows), rows)
        if params.get("l1", 0.0) or params.get("l2", 0.0):
            model = refit_leaves(model, weighted, params.get("l1", 0.0), params.get("l2", 0.0))
        model.setProbabilityCol(f"probability_{self.name}")
        model.setRawPredictionCol(f"raw_{self.name}")
        return model


def _leaf_sums(batches: Iterator[pa.RecordBatch], values: np.ndarray, shrink: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of gradients and hessians per (tree, leaf), from rows (leaf of each tree, label, weight)."""
    gradients, hessians = np.zeros(values.shape), np.zeros(values.shape)
    trees = np.arange(len(values))
    for batch in batches:
        leaf = batch.column(0).flatten().to_numpy().reshape(-1, len(values)).astype(np.int64)
        label, weight = (batch.column(i).cast("double").to_numpy() for i in (1, 2))
        steps = 2 * shrink * values[trees, leaf]  # Spark's margin is half the log odds
        before = np.cumsum(steps, axis=1) - steps
        chance = 1 / (1 + np.exp(-before))
        np.add.at(gradients, (trees, leaf), weight[:, None] * (chance - label[:, None]))
        np.add.at(hessians, (trees, leaf), weight[:, None] * chance * (1 - chance))
    tree, leaf = np.nonzero(hessians)
    columns = [pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), pa.array(gradients[tree, leaf]), pa.array(hessians[tree, leaf])]
    yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "g", "h"])


def refit_leaves(model: GBTClassificationModel, train: DataFrame, l1: float, l2: float) -> GBTClassificationModel:
    """The same trees with penalised leaf values: -soft(G, l1) / (H + l2) in log odds, times the tree's weight, where G and H sum the
    leaf's gradients and hessians of the logistic loss at the margin of the trees before, and soft moves G towards 0 by at most l1.

    One aggregation of (features, label, weight) serves all trees, so the margins are those of the trees as first fitted. What is
    collected are the leaves, at most rounds times 2**depth.
    """
    spark = train.sparkSession
    path, again = fresh_path(spark, "boosted-trees"), fresh_path(spark, "refitted-trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    in_order = Window.partitionBy("treeID").orderBy("nodeData.id")
    leaves = nodes.filter("nodeData.leftChild < 0").withColumn("leaf", F.row_number().over(in_order) - 1)
    leaves = leaves.select(F.col("treeID").alias("tree"), "leaf", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"))
    found = leaves.toPandas()
    values = np.zeros((len(model.treeWeights), int(found["leaf"].max()) + 1))
    values[found["tree"], found["leaf"]] = found["value"]
    shrink = np.array(model.treeWeights)
    reached = model.copy().setLeafCol("leaf").transform(train).select(vector_to_array("leaf").alias("leaf"), S.LABEL, "weight")
    partial_sums = reached.mapInArrow(lambda batches: _leaf_sums(batches, values, shrink), "tree int, leaf int, g double, h double")
    sums = partial_sums.groupBy("tree", "leaf").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    soft = F.signum("g") * F.greatest(F.abs("g") - F.lit(float(l1)), F.lit(0.0))
    newton = F.coalesce(-F.try_divide(soft, F.col("h") + F.lit(float(l2))), F.lit(0.0)) / 2
    fitted = leaves.join(sums, ["tree", "leaf"]).select(F.col("tree").alias("treeID"), F.col("id").alias("_id"), newton.alias("_value"))
    matched = nodes.join(fitted, (nodes["treeID"] == fitted["treeID"]) & (F.col("nodeData.id") == F.col("_id")), "left")
    value = F.coalesce("_value", "nodeData.prediction")
    matched.select(nodes["treeID"], F.col("nodeData").withField("prediction", value).alias("nodeData")).write.parquet(f"{again}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{again}/metadata")
    spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{again}/treesMetadata")
    loaded = GBTClassificationModel.load(again)
    delete_path(spark, path)
    delete_path(spark, again)
    return loaded


@dataclass(frozen=True)
class TrainingOptions:
    folds: int = 3
    trials: int = 5
    undersample: bool = True
    ratio: float = 100
    seed: int = 42
    threshold: float = S.DEFAULT_THRESHOLD
    parallelism: int = 8  # fits at once
    learner_a: Learner = field(default_factory=lambda: Learner("a", SPACE_A))
    learner_b: Learner = field(default_factory=lambda: Learner("b", SPACE_B))

    def with_rounds(self, rounds: int) -> TrainingOptions:
        return replace(
            self,
            learner_a=replace(self.learner_a, rounds=rounds),
            learner_b=replace(self.learner_b, rounds=rounds),
        )


# ---- Prepared frame -----------------------------------------------------------------------------


def fit_tasks(rows: int) -> int:
    """Partitions of a training sample. They follow from its rows alone, so a fit draws the same rows on any cluster."""
    return max(1, -(-rows // MOST_ROWS_PER_TASK), min(FEW_TASKS, -(-rows // ROWS_PER_TASK)))


@dataclass(frozen=True)
class Prepared:
    """`frame` has row_key, provider, fold, label and the feature vector; folds are filters on it."""

    frame: DataFrame
    features: list[str]
    counts: Mapping[int, sampling.ClassCounts]
    options: TrainingOptions
    categories: Mapping[str, Sequence[str]] = field(default_factory=dict)
    samples: dict[int | None, DataFrame] = field(default_factory=dict, init=False, repr=False)
    lock: Lock = field(default_factory=Lock, init=False, repr=False)

    def total(self, fold: int | None = None) -> sampling.ClassCounts:
        used = [c for f, c in self.counts.items() if f != fold]
        return sampling.ClassCounts(sum(c.positives for c in used), sum(c.negatives for c in used))

    def training_rows(self, fold: int | None) -> tuple[DataFrame, int]:
        """Undersampled training rows of a fold (all rows for None) and their expected number.

        They are written once, in as many partitions as their number asks for, and read by every trial, both learners and the
        out-of-fold pass, which would else filter the whole frame each.
        """
        counts = self.total(fold)
        fraction = counts.keep_fraction(self.options.ratio) if self.options.undersample else 1.0
        expected = counts.positives + round(counts.negatives * fraction)
        with self.lock:
            if fold not in self.samples:
                rows = self.frame if fold is None else self.frame.filter(F.col("fold") != fold)
                seed = self.options.seed + (fold or 0)
                chosen = rows.filter(sampling.kept(F.col(ROW_KEY), F.col(S.LABEL), fraction, seed))
                self.samples[fold] = stage(chosen.repartition(fit_tasks(expected), ROW_KEY), "training-sample")
        return self.samples[fold], expected


def prepare(table: DataFrame, keys: Sequence[str] | None, options: TrainingOptions) -> Prepared:
    """Assign folds, fix types, assemble vectors; `keys` identify a row of `table`.

    The assembled frame is staged: every fit and every scoring pass reads it, and nothing before
    it is computed again.
    """
    names = keys or row_keys(table)
    key = F.col(ROW_KEY) if list(names) == [ROW_KEY] else key_text(names)
    kept = [c for c in S.SUMMARY_CATEGORIES if c in table.columns]
    categories = {}
    if kept:  # categoricals that a typed summary keeps: as flags, for as text they would become 0
        categories = encode.category_values(table, kept)
        table = encode.one_hot(table.withColumn(ROW_KEY, key), kept, categories)
        key = F.col(ROW_KEY)
    keyed = folds.assign_folds(table, options.folds, options.seed).withColumn(ROW_KEY, key)
    features = encode.feature_names(table, SPARE)
    typed = encode.fix_types(keyed, keep=(ROW_KEY,))
    assembled = encode.assemble(typed, features, missing=MISSING).select(ROW_KEY, S.PROVIDER, S.LABEL, "features", "fold")
    path = fresh_path(table.sparkSession, "training-frame")
    assembled.write.partitionBy("fold").parquet(path)  # a fold is a folder
    frame = table.sparkSession.read.schema(assembled.schema).parquet(path)
    return Prepared(frame, features, class_counts(frame), options, categories)


def class_counts(frame: DataFrame) -> dict[int, sampling.ClassCounts]:
    """Class counts per fold, one row per fold."""
    label = F.col(S.LABEL)
    grouped = frame.groupBy("fold").agg(
        F.count_if(label == 1).alias("positives"), F.count_if(label == 0).alias("negatives")
    )
    return {r["fold"]: sampling.ClassCounts(r["positives"], r["negatives"]) for r in grouped.collect()}


# ---- Cross-validation and search ----------------------------------------------------------------


def score(df: DataFrame, model, name: str) -> DataFrame:
    scored = model.transform(df)
    probability = vector_to_array(F.col(f"probability_{name}"))[1].alias(f"score_{name}")
    return scored.select(*df.columns, probability)


def fit_each(data: Prepared, wanted: Sequence[tuple[int | None, Learner, Mapping[str, float]]]) -> list:
    """A model for each (fold, learner, params), fitted on the training rows of the fold (all rows for None).

    A fit is one task or a small job per tree level, so one fit alone leaves a cluster idle: `parallelism` fits run at once, in
    the caller's scheduler pool, deep trees first because they take longest. Fits of one fold share its training rows, and their bins
    where the weights are the same.
    """
    trains = {fold: data.training_rows(fold) for fold in {fold for fold, *_ in wanted}}
    uses = Counter((fold, learner.bins(params)) for fold, learner, params in wanted)
    binned = {key: boosting.Shared(n) for key, n in uses.items()}

    def fit(fold: int | None, learner: Learner, params: Mapping[str, float]):
        rows, count = trains[fold]
        return learner.fit(rows, params, count, binned[fold, learner.bins(params)])

    order = sorted(range(len(wanted)), key=lambda i: -wanted[i][1].depth(wanted[i][2]))
    with ThreadPoolExecutor(max_workers=max(1, data.options.parallelism)) as pool:
        started = {i: pool.submit(inheritable_thread_target(fit), *wanted[i]) for i in order}
        return [started[i].result() for i in range(len(wanted))]


def out_of_fold(data: Prepared, chosen: Sequence[tuple[Learner, Mapping[str, float]]]) -> DataFrame:
    """(row_key, fold, label, score_<learner>...): each row scored by models that never saw its
    provider. Both learners score a row in the same pass, so nothing is aligned by position."""
    wanted = [(fold, learner, params) for fold in sorted(data.counts) for learner, params in chosen]
    models = iter(fit_each(data, wanted))
    parts = []
    for fold in sorted(data.counts):
        scored = data.frame.filter(F.col("fold") == fold)
        for learner, _ in chosen:
            scored = score(scored, next(models), learner.name)
        names = [f"score_{learner.name}" for learner, _ in chosen]
        parts.append(scored.select("row_key", "fold", S.LABEL, *names))
    return folds.union_parts(parts)


def cross_validate(data: Prepared, learner: Learner, params: Mapping[str, float]) -> DataFrame:
    """Metrics per fold. Only the training side of a fold is undersampled."""
    score_name = f"score_{learner.name}"
    scores = out_of_fold(data, [(learner, params)]).select("fold", S.LABEL, score_name)
    # Staged, because the metrics read the scores more than once and scoring is the dear part.
    scored = stage(scores, "fold-scores")
    return metrics.fold_metrics(scored, ["fold"], data.options.threshold, S.LABEL, score_name)


def search(data: Prepared, learner: Learner, trials: int | None = None) -> DataFrame:
    """(trial, params, metrics): seeded random draws, each judged by its cross-validated means.

    All trials and folds are fitted side by side; the held-out scores of all are written once, and one pass computes their metrics.
    """
    rng = random.Random(data.options.seed)
    draws = [learner.draw(rng) for _ in range(trials or data.options.trials)]
    wanted = [(trial, fold) for trial in range(len(draws)) for fold in sorted(data.counts)]
    models = fit_each(data, [(fold, learner, draws[trial]) for trial, fold in wanted])
    name = f"score_{learner.name}"
    parts = []
    for (trial, fold), model in zip(wanted, models):
        scored = score(data.frame.filter(F.col("fold") == fold), model, learner.name)
        parts.append(scored.select(F.lit(trial).alias("trial"), "fold", S.LABEL, name))
    with staging(data.frame.sparkSession):
        scored = stage(folds.union_parts(parts), "trial-scores")
        per_fold = metrics.fold_metrics(scored, ["trial", "fold"], data.options.threshold, S.LABEL, name)
        found = [r.asDict() for r in metrics.cv_mean(per_fold, ["trial"]).collect()]  # a row per trial
    means = {r.pop("trial"): r for r in found}
    results = [(trial, {k: float(v) for k, v in draw.items()}, means[trial]) for trial, draw in enumerate(draws)]
    schema = "trial int, params map<string,double>, metrics map<string,double>"
    return data.frame.sparkSession.createDataFrame(results, schema)


def best_trial(trials: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Parameters and metrics of the trial with the highest mean average precision."""
    row = trials.orderBy(F.col("metrics")["aucpr"].desc(), "trial").first()
    return dict(row["params"]), dict(row["metrics"])


# ---- Stacking and final models ------------------------------------------------------------------


def _stack_vector(df: DataFrame) -> DataFrame:
    built = VectorAssembler(inputCols=["score_a", "score_b"], outputCol="stack")
    return built.transform(df)


def fit_stacker(oof: DataFrame, strength: float = 1.0, max_iter: int = 1000):
    """Logistic regression on the two out-of-fold scores.

    The penalty equals a squared norm with inverse strength `strength` on the summed loss; Spark
    averages the loss, hence regParam = 1 / (rows * strength).
    """
    rows = oof.count()
    learner = LogisticRegression(
        labelCol=S.LABEL,
        featuresCol="stack",
        probabilityCol="probability_stack",
        rawPredictionCol="raw_stack",
        predictionCol="prediction_stack",
        maxIter=max_iter,
        regParam=1.0 / (rows * strength),
        elasticNetParam=0.0,
        standardization=False,
    )
    path = fresh_path(oof.sparkSession, "stacker")
    learner.fit(_stack_vector(oof)).write().save(path)
    # Read back without its training summary, which holds the session and cannot be sent to tasks.
    return LogisticRegressionModel.load(path)


def stacker_report(oof: DataFrame, stacker, threshold: float = S.DEFAULT_THRESHOLD) -> DataFrame:
    """Metrics of the stacker on its own training rows, marked as such, with its coefficients."""
    scored = stacker.transform(_stack_vector(oof))
    score = vector_to_array(F.col("probability_stack"))[1].alias("score")
    scores = stage(scored.select(S.LABEL, score), "stacked-scores")
    report = metrics.fold_metrics(scores, [], threshold, S.LABEL, "score")
    a, b = (float(c) for c in stacker.coefficients)
    return report.select(
        "*",
        F.lit(a).alias("weight_a"),
        F.lit(b).alias("weight_b"),
        F.lit(float(stacker.intercept)).alias("intercept"),
        F.lit(True).alias("in_sample"),
    )


def fit_final(data: Prepared, params_a: Mapping[str, float], params_b: Mapping[str, float]):
    """Both learners on the undersampled whole table."""
    a, b = fit_each(data, [(None, data.options.learner_a, params_a), (None, data.options.learner_b, params_b)])
    return a, b


def ensemble(model_a, model_b, stacker) -> PipelineModel:
    """One saveable model: both learners, their positive-class probabilities, the stacker."""
    take = [
        VectorSlicer(inputCol=f"probability_{n}", outputCol=f"positive_{n}", indices=[1]) for n in "ab"
    ]
    join = VectorAssembler(inputCols=["positive_a", "positive_b"], outputCol="stack")
    return PipelineModel([model_a, model_b, *take, join, stacker])


def score_table(frame: DataFrame, model: PipelineModel) -> DataFrame:
    """Score assembled rows with the ensemble."""
    scored = model.transform(frame)
    score = vector_to_array(F.col("probability_stack"))[1].alias("score")
    return scored.select(*[c for c in frame.columns if c != "features"], score)


def correct_prior(score, kept_fraction: float):
    """Probability on the full population for a model trained with that share of the negatives."""
    return score * F.lit(kept_fraction) / (score * F.lit(kept_fraction) + (F.lit(1.0) - score))


def shares(df: DataFrame, value: str, output: str) -> DataFrame:
    """(feature, share of the total). One row per feature column, so one small partition."""
    whole = F.sum(value).over(Window.partitionBy(F.lit(0)))
    share = F.coalesce(F.try_divide(F.col(value), whole), F.lit(0.0))
    return df.select("feature", share.alias(output))


def importance(spark: SparkSession, model, features: Sequence[str], name: str) -> DataFrame:
    """(feature, importance_<name>), scaled to sum 1 so that the two learners weigh the same."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    return shares(spark.createDataFrame(rows, "feature string, v double"), "v", f"importance_{name}")


def top_importance(a: DataFrame, b: DataFrame, n: int = 20) -> DataFrame:
    average = (F.col("importance_a") + F.col("importance_b")) / 2
    joined = a.join(b, "feature", "inner").withColumn("importance_avg", average)
    return joined.orderBy(F.col("importance_avg").desc(), "feature").limit(n)


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    trials_a: DataFrame
    trials_b: DataFrame
    oof: DataFrame
    report: DataFrame
    top: DataFrame
    base_reports: Mapping[str, DataFrame]  # out-of-fold metrics of each base learner
    classes: DataFrame
    features: list[str]
    categories: Mapping[str, Sequence[str]]


def save(result: TrainingResult, path: str) -> None:
    """Model, what it expects of a table (JSON), best parameters (JSON) and top features (CSV) under one folder."""
    result.model.write().overwrite().save(f"{path}/model")
    spark = result.oof.sparkSession
    best = {"a": best_trial(result.trials_a)[0], "b": best_trial(result.trials_b)[0]}
    rows = spark.createDataFrame([(best,)], "params map<string,map<string,double>>")
    rows.coalesce(1).write.mode("overwrite").json(f"{path}/best_params")
    expected = spark.createDataFrame([(list(result.features), dict(result.categories), MISSING)], EXPECTED)
    expected.coalesce(1).write.mode("overwrite").json(f"{path}/features")
    result.top.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/feature_importance")


def score_features(table: DataFrame, path: str, keys: Sequence[str] | None = None) -> DataFrame:
    """(row_key, score) of a feature table that needs no label, by the ensemble saved under `path`.

    Features are taken by name in the order of training. A flag that the table lacks is 0, any other missing feature follows the
    saved rule for missing values, and columns that training did not see are ignored.
    """
    spark = table.sparkSession
    expected = spark.read.schema(EXPECTED).json(f"{path}/features").first()
    names = keys or row_keys(table)
    keyed = table.withColumn(ROW_KEY, F.col(ROW_KEY) if list(names) == [ROW_KEY] else key_text(names))
    values = {c: v for c, v in (expected["categories"] or {}).items() if c in table.columns}
    if values:
        keyed = encode.one_hot(keyed, list(values), values)
    absent = [f for f in expected["features"] if f not in keyed.columns]
    if absent:
        keyed = keyed.withColumns({f: F.lit(0) if "_ohe_" in f else F.lit(None).cast("double") for f in absent})
    typed = encode.fix_types(keyed.select(ROW_KEY, *expected["features"]), keep=(ROW_KEY,))
    assembled = encode.assemble(typed, expected["features"], missing=expected["missing"])
    return score_table(assembled, PipelineModel.load(f"{path}/model"))


def log_search(trials: DataFrame, run: str, learner: str, path: str) -> None:
    """Append each trial to the run log, and the best one as their parent."""
    numbers = F.transform_values("metrics", lambda _, v: v.cast("double"))
    columns = [
        F.concat(F.lit(f"{run}/{learner}/trial-"), F.col("trial")).alias("run_id"),
        F.lit(f"{run}/{learner}").alias("parent_id"),
        F.lit("trial").alias("name"),
        F.transform_values("params", lambda _, v: v.cast("string")).alias("params"),
        numbers.alias("metrics"),
    ]
    runlog.append_runs(trials.select(*columns), path)
    params, means = best_trial(trials)
    best = runlog.record(trials.sparkSession, f"{run}/{learner}", "best trial", params, means, run, "best_")
    runlog.append_runs(best, path)


def train(
    table: DataFrame,
    options: TrainingOptions = TrainingOptions(),
    keys: Sequence[str] | None = None,
    log: str | None = None,
    run: str = "training",
) -> TrainingResult:
    """The whole run: validation, folds, two searches, out-of-fold scores, stacker, final models.

    `keys` identify a row; by default those of a feature table. With `log`, trials, best trials and the run itself are appended to
    the run log at that path. Rows without a label are an error.
    """
    if audit_nulls(table, [S.LABEL]).first()[0]:
        raise ValueError("rows without a label")
    classes = class_distribution(table)
    data = prepare(table, keys, options)
    spark = table.sparkSession
    trials_a, trials_b = search(data, options.learner_a), search(data, options.learner_b)
    params_a, params_b = best_trial(trials_a)[0], best_trial(trials_b)[0]
    scores = out_of_fold(data, [(options.learner_a, params_a), (options.learner_b, params_b)])
    oof, scored = stage_counted(scores, "oof")
    if scored != sum(c.positives + c.negatives for c in data.counts.values()):
        raise RuntimeError("some rows have no out-of-fold score")
    base = {n: metrics.fold_metrics(oof, [], options.threshold, S.LABEL, f"score_{n}") for n in "ab"}
    stacker = fit_stacker(oof)
    report = stacker_report(oof, stacker, options.threshold)
    a, b = fit_final(data, params_a, params_b)
    top = top_importance(
        importance(spark, a, data.features, "a"), importance(spark, b, data.features, "b")
    )
    if log is not None:
        log_search(trials_a, run, "a", log)
        log_search(trials_b, run, "b", log)
        settings = {"folds": options.folds, "trials": options.trials, "ratio": options.ratio, "seed": options.seed}
        runlog.append_runs(runlog.record(spark, run, "training", settings, report.first().asDict()), log)
    model = ensemble(a, b, stacker)
    return TrainingResult(model, trials_a, trials_b, oof, report, top, base, classes, data.features, data.categories)
