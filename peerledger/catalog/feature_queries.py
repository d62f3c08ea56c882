"""Queries for scans, cleaning, aggregation, peers, enrichment, labels and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger import schemas as S
from peerledger.catalog import views as V
from peerledger.catalog.registry import query, round_sql, rounded
from peerledger.functions import coerce, names
from peerledger.operators import clean, encode, joins, labels, peers, sampling
from peerledger.operators.aggregate import claim_statistics
from peerledger.plans.features import feature_table, provider_features, staged_statistics
from peerledger.session import fresh_path
from peerledger.sources import sinks, tables

SQL = V.with_ctes
DETAIL_COLUMNS = (
    "rndrng_npi, rndrng_prvdr_type, place_of_srvc, hcpcs_cd, tot_srvcs, tot_benes, tot_bene_day_srvcs,"
    " avg_sbmtd_chrg, avg_mdcr_pymt_amt"
)
FLOAT_TO_DOUBLE = "cast(avg_sbmtd_chrg as double) as avg_sbmtd_chrg, cast(avg_mdcr_pymt_amt as double) as avg_mdcr_pymt_amt"
CLEAN_COLUMNS = (
    "rndrng_npi, year, rndrng_prvdr_type, place_of_srvc, hcpcs_cd, tot_srvcs, tot_benes, tot_bene_day_srvcs, "
    + FLOAT_TO_DOUBLE
)
KEYS = list(S.GROUP_KEYS)
KEY_SQL = ", ".join(KEYS)
STAT_DOUBLES = [
    f"{b}_{s}"
    for b, kind in V.KINDS.items()
    for s in S.STATISTICS
    if kind == "double" or s in ("mean", "std")
]
STAT_WHOLE = [f"{b}_{s}" for b in V.KINDS for s in S.STATISTICS if f"{b}_{s}" not in STAT_DOUBLES]
Z_COLUMNS = [f"{m}_zscore" for m in S.PEER_METRICS]
R_COLUMNS = [f"{m}_ratio" for m in S.PEER_METRICS]
RISK_COLUMNS = ["billing_inflation", "service_density"]
SUMMARY_NUMBERS = ["tot_hcpcs_cds", "tot_sbmtd_chrg", "bene_avg_risk_scre"]


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return claim_statistics(V.detail(spark, sf))


def staged_stats(spark: SparkSession, sf: str) -> DataFrame:
    return staged_statistics(V.detail(spark, sf))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_summary(V.summary(spark, sf))


def fraud(spark: SparkSession, sf: str) -> DataFrame:
    return labels.fraud_exclusions(labels.clean_exclusions(V.exclusions(spark, sf)))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Provider-year rows with their label."""
    return labels.flag_providers(summary(spark, sf), fraud(spark, sf))


def floats_out(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.FloatType)}
    )


def dates_out(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    )


# ---- Scans and sinks ------------------------------------------------------------------------------


@query("scan_detail", SQL("detail", "select *  exclude (yr), yr as year from detail"))
def scan_detail(spark, sf):
    path = fresh_path(spark, "detail")
    V.detail(spark, sf).write.partitionBy("year").parquet(path)
    declared = T.StructType(
        [f for f in S.DETAIL.fields if f.name in DETAIL_COLUMNS] + [T.StructField("year", T.IntegerType())]
    )
    return tables.scan(spark, path, declared)


@query("scan_summary", SQL("summary_raw", "select * exclude (yr), yr as year from summary_raw"))
def scan_summary(spark, sf):
    path = fresh_path(spark, "summary")
    V.summary(spark, sf).write.parquet(path)
    return tables.scan(spark, path)


@query("scan_exclusions", SQL("excl_raw", "select npi, excltype, excldate, reindate from excl_raw"))
def scan_exclusions(spark, sf):
    path = fresh_path(spark, "exclusions")
    V.exclusions(spark, sf).write.parquet(path)
    return tables.scan(spark, path, S.EXCLUSIONS)


NUMBERS = ("npi", "excldate", "reindate")


@query(
    "scan_mixed_types",
    SQL("excl_raw", f"select excltype, {', '.join(f'cast({c} as bigint) as {c}' for c in NUMBERS)} from excl_raw"),
)
def scan_mixed_types(spark, sf):
    """One table landed partly as text and partly as numbers under names in capitals, read through one contract."""
    path = fresh_path(spark, "mixed")
    rows = V.exclusions(spark, sf)
    odd = F.col("excldate") % 20000 > 10000
    rows.filter(~odd).write.parquet(f"{path}/text")
    numbers = rows.filter(odd).select("excltype", *[F.col(c).cast("bigint").alias(c.upper()) for c in NUMBERS])
    numbers.write.parquet(f"{path}/numbers")
    read = tables.scan(spark, f"{path}/*", S.EXCLUSIONS)
    return read.select("excltype", *[F.col(c).cast("bigint").alias(c) for c in NUMBERS])


@query("year_from_path", SQL("detail", f"select yr as year, {DETAIL_COLUMNS} from detail"))
def year_from_path(spark, sf):
    root = fresh_path(spark, "yearly")
    lines = V.detail(spark, sf)
    folder = F.concat(F.lit("claims_details_"), F.col("year")).alias("folder")
    lines.select(folder, *[c for c in lines.columns if c != "year"]).write.partitionBy("folder").parquet(root)
    files = tables.scan(spark, f"{root}/folder=claims_details_*/*.parquet")
    return tables.with_path_year(files, "claims_details")


@query(
    "head_sample",
    SQL("labelled", "select * from labelled order by rndrng_npi, year limit 100"),
)
def head_sample(spark, sf):
    return sampling.head_sample(labelled(spark, sf), 100, ["rndrng_npi", "year"])


@query(
    "training_scan",
    SQL("labelled", 'select count(*) as "rows", cast(sum(fraud_label) as bigint) as positives, least(count(*), 1) as sampled from labelled'),
)
def training_scan(spark, sf):
    """What the scan of a training table reports of it: rows counted by the read itself, its positives, and the rows of a sample."""
    path = fresh_path(spark, "training-table")
    labelled(spark, sf).write.parquet(path)
    table, seen = tables.scan_training(spark, path)
    positives = table.agg(F.sum("fraud_label").cast("bigint").alias("positives")).first()["positives"]
    sample, _ = tables.scan_training(spark, path, sample_rows=1, keys=["rndrng_npi", "year"])
    return spark.createDataFrame([(seen.get["rows"], positives, sample.count())], "rows bigint, positives bigint, sampled bigint")


@query(
    "sink_roundtrip",
    SQL("labelled", "select *, cast((select count(*) from labelled) as bigint) as rows_written from labelled"),
)
def sink_roundtrip(spark, sf):
    path = fresh_path(spark, "sink")
    written = sinks.write_table(labelled(spark, sf), path)
    return spark.read.parquet(path).withColumn("rows_written", F.lit(written).cast("bigint"))


# ---- Projections, coercions -----------------------------------------------------------------------


def _shouting(spark, sf) -> DataFrame:
    """Detail as landed: mixed-case names and identity columns."""
    lines = V.detail(spark, sf)
    return lines.select(
        *[F.col(c).alias(c.title()) for c in lines.columns],
        F.concat(F.lit("Name "), F.col("rndrng_npi")).alias("Rndrng_Prvdr_Last_Org_Name"),
        F.lit("Springfield").alias("Rndrng_Prvdr_City"),
        F.col("hcpcs_cd").alias("HCPCS_Desc"),
    )


@query(
    "normalize_names",
    SQL(
        "detail",
        f"""select yr as year, {DETAIL_COLUMNS}, 'Name ' || rndrng_npi as rndrng_prvdr_last_org_name,
 'Springfield' as rndrng_prvdr_city, hcpcs_cd as hcpcs_desc from detail""",
    ),
)
def normalize_names(spark, sf):
    return names.lower_names(_shouting(spark, sf))


@query("drop_pii", SQL("detail", f"select yr as year, {DETAIL_COLUMNS} from detail"))
def drop_pii(spark, sf):
    return names.lower_names(_shouting(spark, sf)).drop(*S.DETAIL_DROPPED)


@query("clean_detail", SQL("clean_copies", f"select {CLEAN_COLUMNS} from clean_copies"))
def clean_detail(spark, sf):
    return floats_out(clean.clean_detail(V.detail_with_copies(spark, sf)))


@query("dedup_rows", SQL("copies", f"select distinct yr as year, {DETAIL_COLUMNS} from copies"))
def dedup_rows(spark, sf):
    return V.detail_with_copies(spark, sf).dropDuplicates()


@query(
    "impute_benes",
    SQL("detail", "select rndrng_npi, yr as year, hcpcs_cd, coalesce(tot_benes, '5') as tot_benes from detail"),
)
def impute_benes(spark, sf):
    filled = clean.impute_missing(F.col("tot_benes"), str(S.MISSING_BENEFICIARIES)).alias("tot_benes")
    return V.detail(spark, sf).select("rndrng_npi", "year", "hcpcs_cd", filled)


@query(
    "currency_clean",
    SQL(
        "detail",
        f"""select rndrng_npi, hcpcs_cd, cast({V._money("avg_sbmtd_chrg")} as double) as charge,
 cast({V._money("avg_mdcr_pymt_amt")} as double) as payment from detail""",
    ),
)
def currency_clean(spark, sf):
    return V.detail(spark, sf).select(
        "rndrng_npi",
        "hcpcs_cd",
        coerce.money(F.col("avg_sbmtd_chrg")).cast("double").alias("charge"),
        coerce.money(F.col("avg_mdcr_pymt_amt")).cast("double").alias("payment"),
    )


@query(
    "currency_decimal",
    SQL(
        "detail",
        """select rndrng_npi, yr as year,
 cast(sum(cast(replace(replace(avg_sbmtd_chrg, '$', ''), ',', '') as decimal(18,2))) as varchar) as charges
from detail group by 1, 2""",
    ),
)
def currency_decimal(spark, sf):
    amount = coerce.money(F.col("avg_sbmtd_chrg"), "decimal(18,2)")
    total = F.sum(amount).cast("string").alias("charges")
    return V.detail(spark, sf).groupBy("rndrng_npi", "year").agg(total)


@query(
    "alias_merge",
    SQL("clean", "select rndrng_prvdr_type, cast(count(*) as bigint) as lines from clean group by 1"),
)
def alias_merge(spark, sf):
    merged = clean.merge_aliases(F.col(S.SPECIALTY))
    distinct = clean.clean_detail(V.detail(spark, sf), aliases={}).withColumn(S.SPECIALTY, merged)
    return distinct.groupBy(S.SPECIALTY).agg(F.count("*").alias("lines"))


@query(
    "safe_int",
    SQL(
        "detail",
        f"""select rndrng_npi, hcpcs_cd, {V._int("tot_srvcs")} as services, {V._int("hcpcs_cd")} as code_number,
 {V._int("avg_mdcr_pymt_amt", "bigint")} as payment_whole from detail""",
    ),
)
def safe_int(spark, sf):
    return V.detail(spark, sf).select(
        "rndrng_npi",
        "hcpcs_cd",
        coerce.to_int(F.col("tot_srvcs")).alias("services"),
        coerce.to_int(F.col("hcpcs_cd")).alias("code_number"),
        coerce.to_int(F.col("avg_mdcr_pymt_amt"), "bigint").alias("payment_whole"),
    )


@query(
    "coerce_numeric",
    SQL(
        "summary_raw",
        f"""select coalesce({V._money("rndrng_npi", "double")}, 0.0) as rndrng_npi, cast(yr as double) as year,
 coalesce({V._money("rndrng_prvdr_ent_cd", "double")}, 0.0) as rndrng_prvdr_ent_cd,
 coalesce({V._money("tot_hcpcs_cds", "double")}, 0.0) as tot_hcpcs_cds,
 coalesce({V._money("tot_sbmtd_chrg", "double")}, 0.0) as tot_sbmtd_chrg,
 coalesce(bene_avg_risk_scre, 0.0) as bene_avg_risk_scre from summary_raw""",
    ),
)
def coerce_numeric(spark, sf):
    return clean.numeric_view(V.summary(spark, sf))


@query("clean_summary", SQL("summary", "select * from summary"))
def clean_summary(spark, sf):
    return summary(spark, sf)


@query(
    "clean_summary_parity",
    SQL("summary", "select * replace (cast(0.0 as double) as rndrng_prvdr_ent_cd) from summary"),
)
def clean_summary_parity(spark, sf):
    return clean.clean_summary(V.summary(spark, sf), mode="parity")


@query(
    "parse_dates",
    SQL(
        "excl",
        """select npi, cast(excldate_parsed as varchar) as excldate_parsed, excl_year,
 cast(reindate_parsed as varchar) as reindate_parsed from excl""",
    ),
)
def parse_dates(spark, sf):
    cleaned = labels.clean_exclusions(V.exclusions(spark, sf))
    return dates_out(cleaned.select("npi", "excldate_parsed", "excl_year", "reindate_parsed"))


@query("norm_codes", SQL("excl_raw", "select npi, lower(trim(excltype)) as excltype from excl_raw"))
def norm_codes(spark, sf):
    return V.exclusions(spark, sf).select("npi", coerce.code(F.col("excltype")).alias("excltype"))



@query(
    "sanitize_names",
    """with v as (select distinct p_type || ' (' || p_brand || ')/' || p_name || ', A&B Co.''s no-1' as value from part)
select value, substr(replace(replace(replace(replace(replace(replace(replace(replace(replace(
 value, ' ', '_'), '/', '_'), '-', '_'), '(', ''), ')', ''), ',', ''), '.', ''), '&', 'and'), '''', ''), 1, 50) as label
from v""",
)
def sanitize_names(spark, sf):
    text = F.concat(
        F.col("p_type"), F.lit(" ("), F.col("p_brand"), F.lit(")/"), F.col("p_name"), F.lit(", A&B Co.'s no-1")
    )
    values = V.table(spark, sf, "part").select(text.alias("value")).distinct()
    return values.select("value", names.label_column(F.col("value")).alias("label"))


# ---- Aggregates, peers, ratios --------------------------------------------------------------------


STATS_SQL = SQL("stats", f"select {KEY_SQL}, {', '.join(STAT_WHOLE)}, {round_sql(STAT_DOUBLES)} from stats")


@query("provider_stats", STATS_SQL)
def provider_stats_query(spark, sf):
    return rounded(stats(spark, sf))


@query("provider_stats_crowded", STATS_SQL)
def provider_stats_crowded(spark, sf):
    """The same statistics with provider-years of more than ten lines taken as crowded."""
    return rounded(claim_statistics(V.detail(spark, sf), crowded_rows=10))


@query("provider_stats_sketch", STATS_SQL)
def provider_stats_sketch(spark, sf):
    """Medians from mergeable sketches; the groups here are small enough for them to be exact."""
    return rounded(claim_statistics(V.detail(spark, sf), median="sketch"))


MOMENT_COLUMNS = [f"{m}_peer_{s}" for m in S.PEER_METRICS for s in ("mean", "std")]
MOMENT_SQL = SQL("moments", f"select rndrng_prvdr_type, {round_sql(MOMENT_COLUMNS, 4)} from moments")


@query("peer_moments", MOMENT_SQL)
def peer_moments(spark, sf):
    return rounded(peers.peer_moments(stats(spark, sf)), 4)


@query("peer_zscore", SQL("features", f"select {KEY_SQL}, {round_sql(Z_COLUMNS)} from features"))
def peer_zscore(spark, sf):
    return rounded(peers.peer_features(staged_stats(spark, sf)).select(*KEYS, *Z_COLUMNS))


@query("peer_ratio", SQL("features", f"select {KEY_SQL}, {round_sql(R_COLUMNS)} from features"))
def peer_ratio(spark, sf):
    return rounded(peers.peer_features(staged_stats(spark, sf)).select(*KEYS, *R_COLUMNS))


@query(
    "peer_join_variant",
    SQL(
        "features moments",
        f"""select {", ".join("f." + k for k in KEYS)}, {round_sql(MOMENT_COLUMNS, 4)}
from features f join moments m on f.rndrng_prvdr_type is not distinct from m.rndrng_prvdr_type""",
    ),
)
def peer_join_variant(spark, sf):
    return rounded(peers.with_peer_moments(staged_stats(spark, sf)).select(*KEYS, *MOMENT_COLUMNS), 4)


@query("risk_ratios", SQL("features", f"select {KEY_SQL}, {round_sql(RISK_COLUMNS)} from features"))
def risk_ratios(spark, sf):
    return rounded(peers.risk_ratios(stats(spark, sf)).select(*KEYS, *RISK_COLUMNS))


@query(
    "provider_features",
    SQL(
        "features",
        f"select {KEY_SQL}, {', '.join(STAT_WHOLE)}, {round_sql([*STAT_DOUBLES, *Z_COLUMNS, *R_COLUMNS, *RISK_COLUMNS])} from features",
    ),
)
def provider_features_query(spark, sf):
    return rounded(provider_features(V.detail(spark, sf)))


# ---- Enrichment and labels ------------------------------------------------------------------------


ENRICHED_DOUBLES = [*STAT_DOUBLES, *SUMMARY_NUMBERS]


@query(
    "enrich_join",
    SQL(
        "enriched",
        f"select {KEY_SQL}, rndrng_prvdr_ent_cd, {', '.join(STAT_WHOLE)}, {round_sql(ENRICHED_DOUBLES)} from enriched",
    ),
)
def enrich_join(spark, sf):
    return rounded(joins.join_summary(stats(spark, sf), clean.clean_summary(V.some_summary(spark, sf))))


@query(
    "summary_key_audit",
    SQL(
        "summary",
        "select rndrng_npi, cast(count(*) as bigint) as copies from summary group by 1 having count(*) > 1",
    ),
)
def summary_key_audit(spark, sf):
    return joins.repeated_keys(summary(spark, sf), ["rndrng_npi"])


@query(
    "valid_npi",
    SQL("excl_raw", f"select npi, excltype from excl_raw where {V._int('trim(npi)', 'bigint')} > 0"),
)
def valid_npi(spark, sf):
    return V.exclusions(spark, sf).filter(labels.valid_npi(F.col("npi"))).select("npi", "excltype")


@query(
    "fraud_codes",
    SQL(
        "excl",
        "select npi, excltype, excldate, reindate from excl where excltype in ('1128a1','1128a2','1128a3','1128a4','1128b4','1128b7')",
    ),
)
def fraud_codes(spark, sf):
    cleaned = labels.clean_exclusions(V.exclusions(spark, sf))
    return cleaned.filter(F.col("excltype").isin(*S.FRAUD_CODES)).select("npi", "excltype", "excldate", "reindate")


@query(
    "fraud_npis",
    SQL("fraud", "select npi, excl_year, cast(reindate_parsed as varchar) as reindate_parsed from fraud"),
)
def fraud_npis(spark, sf):
    return dates_out(fraud(spark, sf))


@query("label_join", SQL("labelled", "select * from labelled"))
def label_join(spark, sf):
    return labelled(spark, sf)


@query(
    "label_as_of",
    SQL(
        "summary fraud",
        """select s.*, case when exists (select 1 from fraud f where f.npi = s.rndrng_npi and s.year >= f.excl_year
  and (f.reindate_parsed is null or s.year < extract(year from f.reindate_parsed))) then 1 else 0 end as fraud_label
from summary s""",
    ),
)
def label_as_of(spark, sf):
    claims = summary(spark, sf)
    years = [r["year"] for r in claims.select("year").distinct().collect()]  # the claim years
    return labels.flag_providers_as_of(claims, fraud(spark, sf), years)


@query(
    "class_distribution",
    SQL(
        "labelled",
        """select cast(count(*) as bigint) as total_count, cast(sum(fraud_label) as bigint) as fraud_count,
 floor(avg(fraud_label) * cast(1e6 as double) + cast(0.5 as double)) / cast(1e6 as double) as fraud_ratio from labelled""",
    ),
)
def class_distribution(spark, sf):
    return rounded(labels.class_distribution(labelled(spark, sf)))


@query(
    "distinct_positive",
    SQL(
        "labelled",
        "select cast(count(distinct rndrng_npi) as bigint) as fraud_providers from labelled where fraud_label = 1",
    ),
)
def distinct_positive(spark, sf):
    return labels.distinct_positive(labelled(spark, sf))


@query(
    "null_audit",
    SQL(
        "clean",
        """select cast(count(*) filter (where rndrng_npi is null) as bigint) as rndrng_npi_nulls,
 cast(count(*) filter (where avg_mdcr_pymt_amt is null) as bigint) as avg_mdcr_pymt_amt_nulls from clean""",
    ),
)
def null_audit(spark, sf):
    return clean.audit_nulls(clean.clean_detail(V.detail(spark, sf)), ["rndrng_npi", "avg_mdcr_pymt_amt"])


@query("provider_labels", SQL("providers", "select rndrng_npi, fraud_label from providers"))
def provider_labels(spark, sf):
    return labels.provider_labels(labelled(spark, sf))


# ---- Encoding -------------------------------------------------------------------------------------

# The categories of the test claims; two spellings share one column.
TYPE_FLAGS = {
    "rndrng_prvdr_type_ohe_Allergy_Immunology": ["Allergy/Immunology"],
    "rndrng_prvdr_type_ohe_Certified_Registered_Nurse_Anesthetist": ["Certified Registered Nurse Anesthetist"],
    "rndrng_prvdr_type_ohe_Hematology_Oncology": ["Hematology-Oncology", "Hematology/Oncology"],
    "rndrng_prvdr_type_ohe_Nurse_Practitioner": ["Nurse Practitioner"],
}
PLACE_FLAGS = {"place_of_srvc_ohe_F": ["F"], "place_of_srvc_ohe_O": ["O"]}


def _flags_sql() -> str:
    def flag(column: str, name: str, members: list[str]) -> str:
        listed = ", ".join(f"'{m}'" for m in members)
        return f"case when {column} in ({listed}) then 1 else 0 end as {name}"

    return ", ".join(
        [flag(S.SPECIALTY, n, m) for n, m in TYPE_FLAGS.items()]
        + [flag("place_of_srvc", n, m) for n, m in PLACE_FLAGS.items()]
    )


ONE_HOT_KEPT = "rndrng_npi, year, hcpcs_cd, tot_srvcs, tot_benes, tot_bene_day_srvcs, " + FLOAT_TO_DOUBLE


def _categories(spark: SparkSession, sf: str) -> DataFrame:
    """The categories of all claim lines. Removing copies changes none of them, and without it only these columns are read and moved."""
    return clean.clean_detail(V.detail(spark, sf), distinct=False).select(*S.CATEGORICAL)


@query("one_hot", SQL("clean", f"select {ONE_HOT_KEPT}, {_flags_sql()} from clean"))
def one_hot(spark, sf):
    values = encode.category_values(_categories(spark, sf))
    return floats_out(encode.one_hot(clean.clean_detail(V.detail(spark, sf)), values=values))


def _index_sql(column: str, i: int) -> str:
    return f"""left join (select {column} as value{i}, row_number() over (order by md5({column} || ':42'), {column}) - 1 as index{i}
  from (select distinct {column} from clean where {column} is not null) v) x{i} on value{i} = {column}"""


INDEXES = ", ".join(f"cast(index{i} as bigint) as {c}_index" for i, c in enumerate(S.CATEGORICAL))
INDEXED = " ".join(_index_sql(c, i) for i, c in enumerate(S.CATEGORICAL))


@query("one_hot_sparse", SQL("clean", f"select {ONE_HOT_KEPT}, {INDEXES} from clean {INDEXED}"))
def one_hot_sparse(spark, sf):
    words = encode.vocabulary(_categories(spark, sf))
    rows = encode.one_hot_sparse(clean.clean_detail(V.detail(spark, sf)), words=words, keep_index=True)
    return floats_out(rows.drop(*[f"{c}_ohe" for c in S.CATEGORICAL]))


@query(
    "fix_dtypes",
    SQL(
        "detail",
        f"""select yr as year, {", ".join(f"coalesce({V._int(c.strip(), 'bigint')}, 0) as {c.strip()}" for c in DETAIL_COLUMNS.split(","))}
from detail""",
    ),
)
def fix_dtypes(spark, sf):
    return encode.fix_types(V.detail(spark, sf))


@query("training_projection", SQL("labelled", "select * from labelled"))
def training_projection(spark, sf):
    rows = labelled(spark, sf)
    mixed = rows.select(S.LABEL, *[c for c in rows.columns if c != S.LABEL])
    return encode.training_projection(mixed)


def whole_table(spark: SparkSession, sf: str) -> DataFrame:
    """The complete feature job over the test tables."""
    return feature_table(V.detail(spark, sf), V.some_summary(spark, sf), V.exclusions(spark, sf))


TABLE_DOUBLES = [*STAT_DOUBLES, *Z_COLUMNS, *R_COLUMNS, *RISK_COLUMNS, *SUMMARY_NUMBERS]


@query(
    "feature_table",
    SQL(
        "enriched fraud",
        f"""select rndrng_npi, year, rndrng_prvdr_ent_cd, {", ".join(STAT_WHOLE)}, {round_sql(TABLE_DOUBLES)}, {_flags_sql()},
 case when rndrng_npi in (select npi from fraud) then 1 else 0 end as fraud_label from enriched""",
    ),
)
def feature_table_query(spark, sf):
    return rounded(whole_table(spark, sf))
