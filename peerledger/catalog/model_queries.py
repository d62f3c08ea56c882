"""Queries for folds, sampling, metrics, landing, run log and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerledger import schemas as S
from peerledger.catalog import views as V
from peerledger.catalog.feature_queries import STAT_DOUBLES, STAT_WHOLE, labelled, staged_stats
from peerledger.catalog.registry import query, round_sql, rounded
from peerledger.functions.hashing import key_text
from peerledger.operators import encode, folds, metrics, sampling
from peerledger.plans import runlog, training
from peerledger.plans.features import FeatureOptions, feature_table
from peerledger.session import fresh_path, stage
from peerledger.sources import pages, sinks
from peerledger.streaming.landing import land_page_stream, read_landed, read_progress

SQL = V.with_ctes
K = 3
ROW_KEYS = ["rndrng_npi", "year"]
UNIT_SQL = "cast(('0x' || substr(md5({key} || ':{seed}'), 1, 8))::bigint as double) / 4294967296.0"


def fold_table(spark: SparkSession, sf: str) -> DataFrame:
    providers = stage(folds.provider_labels(labelled(spark, sf)), "provider-labels")
    return folds.stratified_folds(providers, K)


def fold_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled provider-year rows with fold and row key, staged once."""
    rows = folds.assign_folds(labelled(spark, sf), K).withColumn("row_key", key_text(ROW_KEYS))
    return stage(rows, "fold-rows")


# ---- Folds and sampling ---------------------------------------------------------------------------


@query("stratified_folds", SQL("folds", "select rndrng_npi, fraud_label, fold from folds"))
def stratified_folds(spark, sf):
    return fold_table(spark, sf)


@query(
    "stratified_folds_hash",
    SQL(
        "providers",
        """select rndrng_npi, fraud_label,
 cast(('0x' || substr(md5(cast(rndrng_npi as varchar) || ':42'), 1, 8))::bigint % 3 as int) as fold from providers""",
    ),
)
def stratified_folds_hash(spark, sf):
    providers = stage(folds.provider_labels(labelled(spark, sf)), "provider-labels")
    return folds.stratified_folds(providers, K, method="hash")


SIDES = "case when fold = 0 then 'test' else 'train' end as side"


@query("fold_split", SQL("foldrows", f"select rndrng_npi, year, fraud_label, fold, {SIDES} from foldrows"))
def fold_split(spark, sf):
    train, test = folds.split(fold_rows(spark, sf), 0)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.select("rndrng_npi", "year", "fraud_label", "fold", "side")


@query("fold_semi_anti", SQL("foldrows", f"select rndrng_npi, year, fraud_label, {SIDES} from foldrows"))
def fold_semi_anti(spark, sf):
    train, test = folds.semi_split(labelled(spark, sf), stage(fold_table(spark, sf), "folds"), 0)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.select("rndrng_npi", "year", "fraud_label", "side")


@query(
    "fold_indices",
    SQL(
        "foldrows",
        """select cast(k.fold as int) as fold, case when k.fold = r.fold then 'test' else 'train' end as split, r.rndrng_npi, r.year
from foldrows r, (values (0), (1), (2)) k(fold)""",
    ),
)
def fold_indices(spark, sf):
    return folds.fold_indices(labelled(spark, sf), fold_table(spark, sf), K, ROW_KEYS)


@query(
    "leakage_check",
    SQL(
        "foldrows",
        """select cast(count(distinct rndrng_npi) as bigint) as providers,
 cast((select count(*) from (select rndrng_npi from foldrows group by 1 having count(distinct fold) > 1) t) as bigint) as leaks
from foldrows""",
    ),
)
def leakage_check(spark, sf):
    per = fold_rows(spark, sf).groupBy("rndrng_npi").agg(F.min("fold").alias("lo"), F.max("fold").alias("hi"))
    return per.agg(F.count("*").alias("providers"), F.count_if(F.col("lo") != F.col("hi")).alias("leaks"))


def _fraction(source: str, ratio: int) -> str:
    return f"""(select cast(least(count(*) filter (where fraud_label = 1) * {ratio}, count(*) filter (where fraud_label = 0)) as double)
  / count(*) filter (where fraud_label = 0) from {source})"""


ROW_KEY_SQL = "cast(rndrng_npi as varchar) || '|' || cast(year as varchar)"


@query(
    "undersample",
    SQL(
        "labelled",
        f"""select * from labelled where fraud_label = 1
 or {UNIT_SQL.format(key=ROW_KEY_SQL, seed=42)} < {_fraction("labelled", 5)}""",
    ),
)
def undersample(spark, sf):
    return sampling.undersample(stage(labelled(spark, sf), "labelled"), ROW_KEYS, ratio=5)


@query(
    "undersample_exact",
    SQL(
        "labelled",
        f"""select * exclude (rn) from (select *, row_number() over (partition by fraud_label
  order by md5({ROW_KEY_SQL} || ':42'), {ROW_KEY_SQL}) as rn from labelled) t
where fraud_label = 1 or rn <= least(5 * (select count(*) from labelled where fraud_label = 1),
  (select count(*) from labelled where fraud_label = 0))""",
    ),
)
def undersample_exact(spark, sf):
    return sampling.undersample(stage(labelled(spark, sf), "labelled"), ROW_KEYS, ratio=5, exact=True)


@query(
    "fold_train_test",
    SQL(
        "foldrows",
        f"""select rndrng_npi, year, fraud_label, fold, {SIDES} from foldrows where fold = 0 or fraud_label = 1
 or {UNIT_SQL.format(key=ROW_KEY_SQL, seed=42)} < {_fraction("(select * from foldrows where fold <> 0) t", 5)}""",
    ),
)
def fold_train_test(spark, sf):
    train, test = folds.split(fold_rows(spark, sf), 0)
    train = sampling.undersample(train, ROW_KEYS, ratio=5, seed=42)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.select("rndrng_npi", "year", "fraud_label", "fold", "side")


@query(
    "class_weight",
    SQL(
        "labelled",
        """select rndrng_npi, year, fraud_label,
 cast(case when fraud_label = 1 then 25 else 1 end as double) as weight from labelled""",
    ),
)
def class_weight(spark, sf):
    weighted = sampling.class_weight(labelled(spark, sf), 25.0)
    return weighted.select("rndrng_npi", "year", "fraud_label", "weight")


def _rate_scores(rows: DataFrame, column: str, output: str) -> DataFrame:
    """Out-of-fold positive rate of `column`: a score that plain SQL can state too."""
    parts = []
    for fold in range(K):
        train, test = folds.split(rows, fold)
        rates = train.groupBy(column).agg(F.avg("fraud_label").alias(output))
        parts.append(test.join(rates, column, "inner").select("row_key", output))
    return folds.union_parts(parts)


@query(
    "oof_assemble",
    SQL(
        "foldrows",
        f"""select row_key, fold, fraud_label, {round_sql(["score_a", "score_b"])} from (select r.row_key, r.fold, r.fraud_label,
  (select avg(t.fraud_label) from foldrows t where t.fold <> r.fold and t.rndrng_prvdr_ent_cd = r.rndrng_prvdr_ent_cd) as score_a,
  (select avg(t.fraud_label) from foldrows t where t.fold <> r.fold and t.year = r.year) as score_b
 from foldrows r) x""",
    ),
)
def oof_assemble(spark, sf):
    rows = fold_rows(spark, sf)
    a, b = _rate_scores(rows, "rndrng_prvdr_ent_cd", "score_a"), _rate_scores(rows, "year", "score_b")
    return rounded(folds.assemble_scores(rows.select("row_key", "fold", "fraud_label"), [a, b], ["row_key"]))


# ---- Metrics --------------------------------------------------------------------------------------

T1 = V.THRESHOLD
COUNTS = "tp, fp, tn, fn"
RATES = ["f2", "tpr", "tnr", "precision"]
FOLD_DOUBLES = ["aucpr", "auroc", *RATES, "threshold", "fraud_ratio"]


@query("confusion", SQL("m_all", f"select {COUNTS} from m_all"))
def confusion(spark, sf):
    return metrics.confusion(V.scored(spark, sf), T1)


@query("threshold_metrics", SQL("m_all", f"select {round_sql([*RATES, 'threshold'])}, {COUNTS} from m_all"))
def threshold_metrics(spark, sf):
    return rounded(metrics.threshold_metrics(V.scored(spark, sf), T1))


@query("avg_precision", SQL("m_all", f"select {round_sql(['aucpr'], 9)} from m_all"))
def avg_precision(spark, sf):
    return rounded(metrics.ranking_metrics(V.scored(spark, sf)).select("aucpr"), 9)


@query("auroc", SQL("m_all", f"select {round_sql(['auroc'], 9)} from m_all"))
def auroc(spark, sf):
    return rounded(metrics.ranking_metrics(V.scored(spark, sf)).select("auroc"), 9)


@query(
    "fold_metrics",
    SQL("m_fold", f"select fold, {round_sql(FOLD_DOUBLES)}, fraud_count, total_count from m_fold"),
)
def fold_metrics(spark, sf):
    return rounded(metrics.fold_metrics(V.scored(spark, sf), ["fold"], T1))


MEANS = ", ".join(f'avg("{m}") as "{m}"' for m in metrics.SUMMARISED)


@query(
    "cv_mean",
    SQL("m_trial", f"select trial, {round_sql(list(metrics.SUMMARISED))} from (select trial, {MEANS} from m_trial group by trial) t"),
)
def cv_mean(spark, sf):
    per_fold = metrics.fold_metrics(V.scored(spark, sf), ["trial", "fold"], T1)
    return rounded(metrics.cv_mean(per_fold, ["trial"]))


SUMMARY_COLUMNS = [f"{m}_{s}" for m in metrics.SUMMARISED for s in ("mean", "std")]
SUMMARY_SQL = ", ".join(
    f'avg("{m}") as {m}_mean, stddev_pop("{m}") as {m}_std' for m in metrics.SUMMARISED
)


@query(
    "cv_summary",
    SQL(
        "m_fold",
        f"""select {round_sql(SUMMARY_COLUMNS)}, n_folds, {", ".join(f'array_to_string([floor(x * cast(1e6 as double) + cast(0.5 as double)) / cast(1e6 as double) for x in {m}_scores], ",")' .replace('","', "','") + f" as {m}_scores" for m in metrics.SUMMARISED)}
from (select {SUMMARY_SQL}, cast(count(*) as bigint) as n_folds, {", ".join(f'list("{m}" order by fold) as {m}_scores' for m in metrics.SUMMARISED)} from m_fold) t""",
    ),
)
def cv_summary(spark, sf):
    summary = rounded(metrics.cv_summary(metrics.fold_metrics(V.scored(spark, sf), ["fold"], T1)))
    scale = F.lit(1e6)

    def text(name: str):
        steps = F.transform(name, lambda x: (F.floor(x * scale + F.lit(0.5)) / scale).cast("string"))
        return F.array_join(steps, ",").alias(name)

    return summary.select(*[text(c) if c.endswith("_scores") else c for c in summary.columns])


SWEEP = [0.0004, 0.5, 1.0, 2.5, 4.5, 9.0]
SWEEP_DOUBLES = ["threshold", "recall", "precision", "specificity", "f1", "f2", "lift"]


@query(
    "threshold_sweep",
    SQL(
        "scored",
        f"""select {round_sql(SWEEP_DOUBLES)}, alerts, {COUNTS} from (select threshold, tp, fp, tn, fn, tp + fp as alerts,
 coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as recall, coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) as "precision",
 coalesce(cast(tn as double) / nullif(tn + fp, 0), 0) as specificity, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1,
 coalesce(5.0 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0) as f2,
 coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) / (cast(tp + fn as double) / (tp + fp + tn + fn)) as lift
from (select t.threshold, cast(count(*) filter (where score >= t.threshold and label = 1) as bigint) as tp,
  cast(count(*) filter (where score >= t.threshold and label = 0) as bigint) as fp,
  cast(count(*) filter (where score < t.threshold and label = 0) as bigint) as tn,
  cast(count(*) filter (where score < t.threshold and label = 1) as bigint) as fn
 from scored, (values {", ".join(f"(cast({t} as double))" for t in SWEEP)}) t(threshold) group by t.threshold) c) d""",
    ),
)
def threshold_sweep(spark, sf):
    return rounded(metrics.threshold_sweep(V.scored(spark, sf), SWEEP))


# ---- Landing and run log --------------------------------------------------------------------------

RECORD_COLUMNS = "year, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id, event_type, value, props"
DIGEST_SQL = """select year, cast(count(*) as bigint) as records,
 cast(sum(('0x' || substr(md5(concat_ws('|', event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), user_id, event_type,
  cast(value as varchar), props)), 1, 8))::bigint) as varchar) as digest from records group by year"""


@query("decode_pages", SQL("records", f"select {RECORD_COLUMNS} from records"))
def decode_pages(spark, sf):
    return pages.decode_pages(V.pages(spark, sf), V.RECORD)


@query("land_batches", SQL("records", f"select {RECORD_COLUMNS} from records"))
def land_batches(spark, sf):
    path = fresh_path(spark, "landed")
    sinks.land_batches(pages.decode_pages(V.pages(spark, sf), V.RECORD), path, rows_per_file=S.LANDING_BATCH_ROWS)
    return spark.read.parquet(path)


def _audit_sql(broken: str, early: str) -> str:
    """Audit of `paged`, the records with their page number, of which some pages are broken and some start one place early."""
    return f"""
sound as (select * from paged where not ({broken})),
digests as ({DIGEST_SQL.replace("from records", "from sound")}),
starts as (
  select year, page, page * {V.PAGE_ROWS} - case when {early} then 1 else 0 end as start, count(*) as n from sound group by year, page
),
nexts as (select *, lead(start) over (partition by year order by start) as nxt from starts),
totals as (select year, count(*) as total from paged group by year),
declared as (select s.year, max(total) as total from starts s join totals t on s.year = t.year where s.page % 2 = 1 group by s.year),
breaks as (
  select year, count(*) as pages, sum(case when nxt > start + n then 1 else 0 end) + max(case when start > 0 and page = first then 1 else 0 end) as gaps,
    sum(case when nxt < start + n then 1 else 0 end) as overlaps, sum(case when n < {V.PAGE_ROWS} and nxt is not null then 1 else 0 end) as early
  from (select *, min(page) over (partition by year) as first from nexts) x group by year
),
corrupt as (select year, count(distinct case when {broken} then page end) as pages from paged group by year),
twins as (
  select a.year, min(b.year) as first_year from digests a join digests b
  on a.digest = b.digest and a.records = b.records and b.year < a.year group by a.year
)
select c.year, cast(coalesce(b.pages, 0) as bigint) as pages, coalesce(d.records, 0) as records, cast(coalesce(b.gaps, 0) as bigint) as gaps,
  cast(coalesce(b.overlaps, 0) as bigint) as overlaps, cast(0 as bigint) as repeated_pages,
  cast(coalesce(b.early, 0) as bigint) as early_short_pages, cast(t.total as bigint) as declared_total,
  cast(c.pages as bigint) as corrupt_pages, d.digest, w.first_year as same_content_as
from corrupt c left join breaks b on b.year = c.year left join digests d on d.year = c.year
left join declared t on t.year = c.year left join twins w on w.year = c.year"""


PAGED = f"paged as (select *, event_id // {V.PAGE_ROWS} as page from records),"
PAGED_AGAIN = f"""more as (select * from records union all select 2022, * exclude (year) from records where year = 2021),
paged as (select *, event_id // {V.PAGE_ROWS} as page from more),"""
BROKEN = "year = 2022 or (year = 2019 and page % 3 = 1)"


def _with_records(ctes: str) -> str:
    whole = SQL("records", "select")
    return whole[: whole.rindex("select")].rstrip() + ",\n" + ctes


@query("landing_audit", _with_records(PAGED + _audit_sql("false", "false")))
def landing_audit(spark, sf):
    return pages.audit_pages(V.pages(spark, sf), V.RECORD, V.PAGE_ROWS)


@query("landing_audit_damaged", _with_records(PAGED_AGAIN + _audit_sql(BROKEN, "year = 2020 and page % 4 = 2")))
def landing_audit_damaged(spark, sf):
    """Some pages are cut off, some overlap, and one year has nothing but broken pages."""
    return pages.audit_pages(V.damaged_pages(spark, sf), V.RECORD, V.PAGE_ROWS)


REJECTED_SQL = f"select distinct year, cast(page * {V.PAGE_ROWS} as bigint) as \"offset\" from paged where {BROKEN}"


@query("rejected_pages", _with_records(PAGED_AGAIN.rstrip(",") + "\n" + REJECTED_SQL))
def rejected_pages(spark, sf):
    return pages.rejected_pages(V.damaged_pages(spark, sf), V.RECORD).select("year", "offset")


STARTS_SQL = f"""
sound as (select * from paged where not ({BROKEN})),
starts as (
  select year, page, page * {V.PAGE_ROWS} - case when year = 2020 and page % 4 = 2 then 1 else 0 end as start, count(*) as n from sound group by year, page
),
totals as (select year, count(*) as total from paged group by year),
declared as (select s.year, max(total) as total from starts s join totals t on s.year = t.year where s.page % 2 = 1 group by s.year),
"""
BREAKS_SQL = f"""{STARTS_SQL}
steps as (
  select year, pos, sum(step) as step from (select year, start as pos, 1 as step from starts union all select year, start + n, -1 from starts) m group by year, pos
),
cover as (select year, pos, step, sum(step) over (partition by year order by pos) as cover from steps),
extent as (select year, min(pos) as first, max(pos) as last from steps group by year),
found as (
  select year, 'gap' as kind, pos as start, nxt as "end" from (
    select *, lead(pos) over (partition by year order by pos) as nxt from cover where (cover = 0) <> (cover - step = 0)) g where cover = 0
  union all
  select year, 'overlap', pos, nxt from (
    select *, lead(pos) over (partition by year order by pos) as nxt from cover where (cover > 1) <> (cover - step > 1)) o where cover > 1
),
edges as (select t.year, e.first, e.last, d.total from totals t left join extent e on e.year = t.year left join declared d on d.year = t.year)
select year, kind, cast(start as bigint) as start, cast("end" as bigint) as "end" from found where "end" is not null
union all select year, 'gap', 0, cast(coalesce(first, total) as bigint) from edges where first > 0 or first is null
union all select year, 'gap', cast(last as bigint), cast(total as bigint) from edges where total > last"""


@query("landing_gaps", _with_records(PAGED_AGAIN + BREAKS_SQL))
def landing_gaps(spark, sf):
    """The positions to fetch again, and those that were fetched twice."""
    return pages.page_breaks(V.damaged_pages(spark, sf), V.RECORD, V.PAGE_ROWS)


PROGRESS_SQL = f"""{STARTS_SQL}
broken as (select year, count(distinct page) as rejected from paged where {BROKEN} group by year),
landed as (select year, count(*) as pages, sum(n) as records, max(start + n) as reach from starts group by year)
select t.year, cast(coalesce(l.pages, 0) as bigint) as pages, cast(coalesce(l.records, 0) as bigint) as records,
  cast(coalesce(b.rejected, 0) as bigint) as rejected, cast(l.reach as bigint) as reach, cast(d.total as bigint) as declared_total
from totals t left join landed l on l.year = t.year left join broken b on b.year = t.year left join declared d on d.year = t.year"""


def _stream(spark, pages_frame: DataFrame) -> dict[str, str]:
    folders = {n: fresh_path(spark, f"stream-{n}") for n in ("source", "target", "checkpoint", "rejected", "progress")}
    pages_frame.write.json(folders["source"])
    for _ in range(2):  # the second run finds nothing new
        land_page_stream(spark, fields=V.RECORD, **folders)
    return folders


@query("stream_progress", _with_records(PAGED_AGAIN + PROGRESS_SQL))
def stream_progress(spark, sf):
    """What a stream over damaged pages has landed and set aside, year by year."""
    return read_progress(spark, _stream(spark, V.damaged_pages(spark, sf))["progress"])


LANDED_SQL = f"select {RECORD_COLUMNS} from paged where not ({BROKEN})"


@query("stream_landing_damaged", _with_records(PAGED_AGAIN.rstrip(",") + "\n" + LANDED_SQL))
def stream_landing_damaged(spark, sf):
    """The records of the sound pages; the corrupt ones are set aside."""
    return read_landed(spark, _stream(spark, V.damaged_pages(spark, sf))["target"])


@query("stream_landing", SQL("records", f"select {RECORD_COLUMNS} from records"))
def stream_landing(spark, sf):
    source, target = fresh_path(spark, "pages"), fresh_path(spark, "stream")
    checkpoint = fresh_path(spark, "stream-state")
    V.pages(spark, sf).write.json(source)
    for _ in range(2):  # the second run finds nothing new
        land_page_stream(spark, source, target, checkpoint, V.RECORD)
    return read_landed(spark, target)


RUN_METRICS = ["aucpr", "auroc", *RATES, "threshold", "fraud_count", "total_count", "fraud_ratio"]


@query(
    "run_log",
    SQL(
        "m_fold",
        f"""select 'fold-' || cast(fold as varchar) as run_id, 'cv' as parent_id, 'lines' as name, metric, {round_sql(["value"])}
from (unpivot (select fold, {", ".join(f'cast("{m}" as double) as "cv_{m}"' for m in RUN_METRICS)} from m_fold)
 on {", ".join(f'"cv_{m}"' for m in RUN_METRICS)} into name metric value value) u""",
    ),
)
def run_log(spark, sf):
    path = fresh_path(spark, "runs")
    per_fold = metrics.fold_metrics(V.scored(spark, sf), ["fold"], T1)
    run_id = F.concat(F.lit("fold-"), F.col("fold"))
    runs = runlog.runs_from(
        per_fold, "lines", run_id, F.lit("cv"), {"threshold": T1}, prefix="cv_", metrics=RUN_METRICS
    )
    runlog.append_runs(runs, path)
    return rounded(runlog.read_metrics(spark, path))


# ---- Importance -----------------------------------------------------------------------------------

TOP_FEATURES = [*STAT_WHOLE, *STAT_DOUBLES]


def _unpivot_sql(fn: str, name: str) -> str:
    cols = ", ".join(f"coalesce({fn}(cast({c} as double)), 0) as {c}" for c in TOP_FEATURES)
    return f"""(select feature, v / sum(v) over () as {name} from (unpivot (select {cols} from stats)
  on {", ".join(TOP_FEATURES)} into name feature value v) u)"""


@query(
    "topk_features",
    SQL(
        "stats",
        f"""select feature, {round_sql(["importance_a", "importance_b", "importance_avg"])} from (
 select a.feature, importance_a, importance_b, (importance_a + importance_b) / 2 as importance_avg
 from {_unpivot_sql("avg", "importance_a")} a join {_unpivot_sql("stddev_pop", "importance_b")} b on a.feature = b.feature
 order by importance_avg desc, a.feature limit 20) t""",
    ),
)
def topk_features(spark, sf):
    rows = staged_stats(spark, sf)

    def scale(function, name: str) -> DataFrame:
        values = rows.agg(*[F.coalesce(function(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in TOP_FEATURES])
        tall = values.unpivot([], TOP_FEATURES, "feature", "v")
        return training.shares(tall, "v", name)

    return rounded(
        training.top_importance(scale(F.avg, "importance_a"), scale(F.stddev_pop, "importance_b"))
    )


# ---- Models (no SQL twin) -------------------------------------------------------------------------

OPTIONS = training.TrainingOptions(folds=K, ratio=10)  # rounds and trials are the library's own


def prepared(spark: SparkSession, sf: str) -> training.Prepared:
    """The whole feature table, keyed, folded, assembled and staged once."""
    options = FeatureOptions(row_key=True)
    table = feature_table(V.detail(spark, sf), V.summary(spark, sf), V.exclusions(spark, sf), options)
    return training.prepare(stage(table, "feature-table"), None, OPTIONS)


def _defaults(data: training.Prepared):
    a, b = data.options.learner_a, data.options.learner_b
    return [(a, a.defaults()), (b, b.defaults() | {"leaves": 31, "learning_rate": 0.2})]


ROW_KEY_AUDIT_SQL = """
with lines as ({detail}),
more as (
  select rndrng_npi, yr, rndrng_prvdr_type, place_of_srvc from lines
  union all select rndrng_npi, yr, 'Hematology-Oncology', place_of_srvc from lines where rndrng_prvdr_type = 'Hematology/Oncology'
),
groups as (
  select distinct cast(rndrng_npi as bigint) as npi, yr, place_of_srvc,
    case rndrng_prvdr_type when 'Allergy/ Immunology' then 'Allergy/Immunology' when 'CRNA' then 'Certified Registered Nurse Anesthetist'
      else rndrng_prvdr_type end as kind
  from more
)
select count(*) as "rows", cast(0 as bigint) as duplicates from groups
"""


@query("row_key_audit", ROW_KEY_AUDIT_SQL.format(detail=V.plain(V.DETAIL)))
def row_key_audit(spark, sf):
    """Rows and repeated row keys where providers bill under two specialties that share a flag column."""
    lines = V.detail(spark, sf)
    twice = lines.filter("rndrng_prvdr_type = 'Hematology/Oncology'").withColumn("rndrng_prvdr_type", F.lit("Hematology-Oncology"))
    options = FeatureOptions(row_key=True)
    table = feature_table(lines.unionByName(twice), V.summary(spark, sf), V.exclusions(spark, sf), options)
    keys = table.groupBy("row_key").count()
    return keys.agg(F.sum("count").alias("rows"), (F.sum("count") - F.count("*")).alias("duplicates"))


@query("assemble_features")
def assemble_features(spark, sf):
    rows = encode.fix_types(labelled(spark, sf))
    return encode.assemble(rows, encode.feature_names(rows, training.SPARE)).select(
        "rndrng_npi", "fraud_label", F.col("features").cast("string").alias("features")
    )


VECTOR = ("tot_hcpcs_cds", "tot_sbmtd_chrg", "bene_avg_risk_scre")


@query(
    "assemble_vectors",
    SQL(
        "labelled",
        "\nunion all ".join(
            f"select rndrng_npi, year, {i} as place, floor(cast({c} as double) * cast(1e6 as double) + cast(0.5 as double)) / cast(1e6 as double) as value from labelled"
            for i, c in enumerate(VECTOR)
        ),
    ),
)
def assemble_vectors(spark, sf):
    """The feature vector, place by place."""
    rows = labelled(spark, sf)
    vectors = encode.assemble(rows.select(*ROW_KEYS, *VECTOR), VECTOR, missing=training.MISSING)
    return rounded(vectors.select(*ROW_KEYS, F.posexplode(vector_to_array("features")).alias("place", "value")))


def _fitted(spark, sf, position: int) -> DataFrame:
    data = prepared(spark, sf)
    learner, params = _defaults(data)[position]
    train, rows = data.training_rows(0)
    model = learner.fit(train, params, rows)
    return training.score(folds.split(data.frame, 0)[1], model, learner.name).drop("features")


@query("fit_boosted_a")
def fit_boosted_a(spark, sf):
    return _fitted(spark, sf, 0)


@query("fit_boosted_b")
def fit_boosted_b(spark, sf):
    return _fitted(spark, sf, 1)


@query("cross_validate")
def cross_validate(spark, sf):
    data = prepared(spark, sf)
    return training.cross_validate(data, *_defaults(data)[0])


@query("hpo_search")
def hpo_search(spark, sf):
    data = prepared(spark, sf)
    return training.search(data, data.options.learner_a)


@query("oof_predictions")
def oof_predictions(spark, sf):
    data = prepared(spark, sf)
    return training.out_of_fold(data, _defaults(data))


@query("fit_stacker")
def fit_stacker(spark, sf):
    data = prepared(spark, sf)
    oof = stage(training.out_of_fold(data, _defaults(data)), "oof")
    return training.stacker_report(oof, training.fit_stacker(oof))


def _ensemble(data: training.Prepared):
    oof = stage(training.out_of_fold(data, _defaults(data)), "oof")
    params_a, params_b = (params for _, params in _defaults(data))
    a, b = training.fit_final(data, params_a, params_b)
    return a, b, training.ensemble(a, b, training.fit_stacker(oof))


@query("fit_final")
def fit_final(spark, sf):
    data = prepared(spark, sf)
    params_a, params_b = (params for _, params in _defaults(data))
    a, b = training.fit_final(data, params_a, params_b)
    scored = training.score(training.score(data.frame, a, "a"), b, "b")
    return scored.select("row_key", S.LABEL, "score_a", "score_b")


@query("importance_topk")
def importance_topk(spark, sf):
    data = prepared(spark, sf)
    params_a, params_b = (params for _, params in _defaults(data))
    a, b = training.fit_final(data, params_a, params_b)
    return training.top_importance(
        training.importance(spark, a, data.features, "a"), training.importance(spark, b, data.features, "b")
    )


@query("score_table")
def score_table(spark, sf):
    data = prepared(spark, sf)
    return training.score_table(data.frame, _ensemble(data)[2])


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Rows whose score changes after saving and loading the ensemble: 0."""
    data = prepared(spark, sf)
    model = _ensemble(data)[2]
    path = fresh_path(spark, "model")
    model.write().overwrite().save(path)
    before = training.score_table(data.frame, model).select("row_key", F.col("score").alias("before"))
    after = training.score_table(data.frame, training.PipelineModel.load(path)).select("row_key", "score")
    same = before.join(after, "row_key", "inner")
    changed = F.count_if(F.abs(F.col("before") - F.col("score")) > 1e-12).alias("changed")
    return same.agg(F.count("*").alias("rows"), changed)
