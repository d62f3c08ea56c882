"""The test tables seen as claims, summaries, exclusions, scores and pages.

Each text is run by Spark (placeholders bound to DataFrames) and reused inside the SQL twins
(placeholders replaced by table names).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerledger import schemas as S

DETAIL = """
select cast(o.o_custkey + 1000000000 as varchar(20)) as rndrng_npi,
 cast(extract(year from o.o_orderdate) as int) as yr,
 case c.c_mktsegment when 'MACHINERY' then 'Allergy/ Immunology' when 'FURNITURE' then 'CRNA'
   when 'BUILDING' then 'Hematology-Oncology' when 'HOUSEHOLD' then 'Hematology/Oncology' else 'Nurse Practitioner' end as rndrng_prvdr_type,
 case l.l_linestatus when 'F' then 'F' else 'O' end as place_of_srvc,
 case when l.l_partkey % 5 = 0 then concat('G', lpad(cast(l.l_partkey % 10000 as varchar(20)), 4, '0'))
   else lpad(cast(l.l_partkey % 100000 as varchar(20)), 5, '0') end as hcpcs_cd,
 case when l.l_linenumber % 2 = 0 then concat(cast(cast(l.l_quantity as int) as varchar(20)), '.5')
   else cast(cast(l.l_quantity as int) as varchar(20)) end as tot_srvcs,
 case when l.l_linenumber = 7 then null else cast(l.l_linenumber as varchar(20)) end as tot_benes,
 cast(cast(l.l_quantity as int) + l.l_linenumber as varchar(20)) as tot_bene_day_srvcs,
 concat('$', cast(cast(l.l_extendedprice as decimal(18,2)) as varchar(30))) as avg_sbmtd_chrg,
 case when l.l_discount >= 0.095 then '0' when l.l_tax >= 0.075 then '*'
   else cast(cast(floor(l.l_extendedprice * (1 - l.l_discount)) as int) as varchar(20)) end as avg_mdcr_pymt_amt
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey join {customer} c on o.o_custkey = c.c_custkey
"""

EXCLUSIONS = """
select case when c_custkey % 11 = 0 then '0000000000' else cast(c_custkey + 1000000000 as varchar(20)) end as npi,
 case c_custkey % 4 when 0 then ' 1128A1 ' when 1 then '1128b7' when 2 then '1128a3' else '1128b8' end as excltype,
 concat(cast(1995 + c_custkey % 5 as varchar(4)), '0315') as excldate,
 case when c_custkey % 3 = 0 then '20000101' else '00000000' end as reindate
from {customer} where c_acctbal < 0
"""

SUMMARY = """
select cast(o_custkey + 1000000000 as varchar(20)) as rndrng_npi, cast(extract(year from o_orderdate) as int) as yr,
 case when o_custkey % 2 = 0 then 'I' else 'O' end as rndrng_prvdr_ent_cd,
 case when count(*) < 2 then '*' else cast(count(*) as varchar(20)) end as tot_hcpcs_cds,
 concat('$', cast(cast(max(o_totalprice) as decimal(18,2)) as varchar(30))) as tot_sbmtd_chrg,
 case when o_custkey % 7 = 0 then null else cast(min(o_totalprice) as double) end as bene_avg_risk_scre
from {orders} group by o_custkey, extract(year from o_orderdate)
"""

SCORED = """
select l_orderkey, l_linenumber, cast(l_orderkey % 3 as int) as fold, cast(l_linenumber % 2 as int) as trial,
 case when l_returnflag = 'R' then 1 else 0 end as label, l_quantity * l_discount as score
from {lineitem}
"""

# Every event as a landed record: 2019 and 2020 carry the same content, 2021 has short pages.
PAGE_RECORDS = """
select 2019 as year, event_id, user_id, event_type, value, props, ts from {events}
union all select 2020, event_id, user_id, event_type, value, props, ts from {events}
union all select 2021, event_id, user_id, event_type, value, props, ts from {events} where event_type <> 'error'
"""
PAGE_ROWS = 500
RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
TABLES = ("customer", "orders", "lineitem", "events", "part")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def run(spark: SparkSession, sf: str, text: str) -> DataFrame:
    used = {t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def plain(text: str) -> str:
    """The view text with placeholders replaced by table names."""
    return text.format(**{t: t for t in TABLES})


def detail(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf, DETAIL).withColumnRenamed("yr", "year")


def detail_with_copies(spark: SparkSession, sf: str) -> DataFrame:
    """All claim lines, those of alphanumeric procedures twice."""
    lines = detail(spark, sf)
    times = F.when(F.col("hcpcs_cd").startswith("G"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.select("*", F.explode(times).alias("_copy")).drop("_copy")


def exclusions(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf, EXCLUSIONS)


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf, SUMMARY).withColumnRenamed("yr", "year")


def some_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A summary that lacks a tenth of the providers: the enrichment join has to drop their claims."""
    return summary(spark, sf).filter("cast(rndrng_npi as bigint) % 10 <> 3")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf, SCORED)


def pages(spark: SparkSession, sf: str, rows: int = PAGE_ROWS) -> DataFrame:
    """Pages of `rows` records, as lists and as objects in turn."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    records = run(spark, sf, PAGE_RECORDS).withColumn("ts", text)
    number = F.floor(F.col("event_id") / rows)
    record = F.struct(*[F.col(f.name) for f in RECORD.fields])
    grouped = records.groupBy("year", number.alias("page")).agg(
        F.array_sort(F.collect_list(record)).alias("records")
    )
    total = records.groupBy("year").agg(F.count("*").alias("total"))
    envelope = F.struct(
        F.col("records").alias("data"), F.struct(F.col("total").alias("totalCount")).alias("meta")
    )
    payload = F.when(F.col("page") % 2 == 0, F.to_json("records")).otherwise(F.to_json(envelope))
    # A row per year: a join by shuffle would gather all pages of a year in one task.
    return grouped.join(F.broadcast(total), "year").select(
        "year", (F.col("page") * rows).cast("bigint").alias("offset"), payload.alias("payload")
    )


def damaged_pages(spark: SparkSession, sf: str, rows: int = PAGE_ROWS) -> DataFrame:
    """The pages with faults: in 2019 every third page is cut off, in 2020 every fourth starts one place early, and 2022 has the pages of
    2021, all of them cut off."""
    sound = pages(spark, sf, rows)
    again = sound.filter("year = 2021").withColumn("year", F.lit(2022))
    number = F.floor(F.col("offset") / rows)
    cut = (F.col("year") == 2022) | ((F.col("year") == 2019) & (number % 3 == 1))
    early = F.when((F.col("year") == 2020) & (number % 4 == 2), 1).otherwise(0)
    whole = F.col("payload")
    payload = F.when(cut, F.substring(whole, F.lit(1), F.length(whole) - 5)).otherwise(whole)
    return sound.unionByName(again).select("year", (F.col("offset") - early).alias("offset"), payload.alias("payload"))


# ---- SQL fragments shared by the twins ------------------------------------------------------------


def _int(x: str, kind: str = "int") -> str:
    return f"try_cast(trunc(try_cast({x} as double)) as {kind})"


def _money(x: str, kind: str = "float") -> str:
    return f"try_cast(regexp_replace({x}, '[$,]', '', 'g') as {kind})"


def _stats(column: str, target: str, kind: str) -> str:
    total = "bigint" if kind == "int" else "double"
    return f"""
 cast(min({column}) as {kind}) as {target}_min, cast(max({column}) as {kind}) as {target}_max,
 avg({column}) as {target}_mean, cast(quantile_disc({column}, 0.5) as {kind}) as {target}_median,
 cast(sum(cast({column} as {total})) as {total}) as {target}_sum, coalesce(stddev_samp({column}), 0.0) as {target}_std"""


KINDS = {b: "int" if i < 3 else "double" for i, b in enumerate(S.MEASURES.values())}

CTES = {
    "detail": plain(DETAIL),
    "copies": "select d.* from detail d cross join (values (1), (2)) t(n) where n = 1 or d.hcpcs_cd like 'G%'",
    "excl_raw": plain(EXCLUSIONS),
    "summary_raw": plain(SUMMARY),
    "scored": plain(SCORED),
    "records": plain(PAGE_RECORDS),
}


def _clean(source: str) -> str:
    return f"""
select {_int("trim(rndrng_npi)", "bigint")} as rndrng_npi, yr as year, rndrng_prvdr_type, place_of_srvc, hcpcs_cd,
 {_int("tot_srvcs")} as tot_srvcs, {_int("tot_benes")} as tot_benes, {_int("tot_bene_day_srvcs")} as tot_bene_day_srvcs,
 avg_sbmtd_chrg, avg_mdcr_pymt_amt
from (select distinct rndrng_npi, yr, place_of_srvc, hcpcs_cd, tot_srvcs, coalesce(tot_benes, '5') as tot_benes, tot_bene_day_srvcs,
  case rndrng_prvdr_type when 'Allergy/ Immunology' then 'Allergy/Immunology' when 'CRNA' then 'Certified Registered Nurse Anesthetist'
    else rndrng_prvdr_type end as rndrng_prvdr_type,
  {_money("avg_sbmtd_chrg")} as avg_sbmtd_chrg, {_money("avg_mdcr_pymt_amt")} as avg_mdcr_pymt_amt
 from {source}) d"""


CTES["clean"] = _clean("detail")
CTES["clean_copies"] = _clean("copies")
CTES["stats"] = (
    "select rndrng_npi, year, rndrng_prvdr_type, place_of_srvc,"
    + ",".join(_stats(src, dst, KINDS[dst]) for src, dst in S.MEASURES.items())
    + "\nfrom clean group by all"
)
CTES["moments"] = (
    "select rndrng_prvdr_type, "
    + ", ".join(f"avg({m}_sum) as {m}_peer_mean, stddev_samp({m}_sum) as {m}_peer_std" for m in S.PEER_METRICS)
    + " from stats group by 1"
)
CTES["features"] = (
    "select s.*, "
    + ", ".join(
        f"(s.{m}_sum - p.{m}_peer_mean) / (case when p.{m}_peer_std is null or p.{m}_peer_std = 0 then 0.01"
        f" else p.{m}_peer_std end) as {m}_zscore, case when p.{m}_peer_mean = 0 then 1.0"
        f" else s.{m}_sum / p.{m}_peer_mean end as {m}_ratio"
        for m in S.PEER_METRICS
    )
    + """,
 case when average_medicare_payment_amt_sum is null or average_medicare_payment_amt_sum = 0 then 1.0
   else average_submitted_chrg_amt_sum / average_medicare_payment_amt_sum end as billing_inflation,
 case when bene_unique_cnt_sum is null or bene_unique_cnt_sum = 0 then 1.0
   else cast(line_srvc_cnt_sum as double) / bene_unique_cnt_sum end as service_density
from stats s join moments p on s.rndrng_prvdr_type is not distinct from p.rndrng_prvdr_type"""
)
CTES["summary"] = f"""
select {_int("trim(rndrng_npi)", "bigint")} as rndrng_npi, yr as year, rndrng_prvdr_ent_cd,
 coalesce({_money("tot_hcpcs_cds", "double")}, 0.0) as tot_hcpcs_cds,
 coalesce({_money("tot_sbmtd_chrg", "double")}, 0.0) as tot_sbmtd_chrg,
 coalesce(bene_avg_risk_scre, 0.0) as bene_avg_risk_scre
from summary_raw"""
CTES["excl"] = f"""
select {_int("trim(npi)", "bigint")} as npi, lower(trim(excltype)) as excltype, excldate, reindate,
 cast(try_strptime(excldate, '%Y%m%d') as date) as excldate_parsed,
 cast(extract(year from try_strptime(excldate, '%Y%m%d')) as int) as excl_year,
 cast(try_strptime(reindate, '%Y%m%d') as date) as reindate_parsed
from excl_raw where {_int("trim(npi)", "bigint")} > 0"""
CTES["fraud"] = (
    "select distinct npi, excl_year, reindate_parsed from excl where excltype in ("
    + ", ".join(f"'{c}'" for c in S.FRAUD_CODES)
    + ")"
)
CTES["enriched"] = """
select f.*, s.rndrng_prvdr_ent_cd, s.tot_hcpcs_cds, s.tot_sbmtd_chrg, s.bene_avg_risk_scre
from features f join summary s on f.rndrng_npi = s.rndrng_npi and f.year = s.year and s.rndrng_npi % 10 <> 3"""
CTES["labelled"] = """
select s.*, case when s.rndrng_npi in (select npi from fraud) then 1 else 0 end as fraud_label from summary s"""
CTES["providers"] = "select rndrng_npi, max(fraud_label) as fraud_label from labelled where rndrng_npi is not null group by 1"
CTES["folds"] = """
select rndrng_npi, fraud_label, cast((row_number() over (partition by fraud_label
  order by md5(cast(rndrng_npi as varchar) || ':42'), rndrng_npi) - 1) % 3 as int) as fold from providers"""
CTES["foldrows"] = """
select l.*, f.fold, cast(l.rndrng_npi as varchar) || '|' || cast(l.year as varchar) as row_key
from labelled l join folds f on l.rndrng_npi = f.rndrng_npi"""


def _ties(by: str) -> str:
    key = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
select {key}score, pos, neg, sum(pos) over w as ctp, sum(neg) over w as cfp
from (select {key}score, sum(label) as pos, sum(1 - label) as neg from scored group by {key}score) t
window w as ({part}order by score desc)"""


def _metrics(source: str, by: str, threshold: float) -> str:
    key, group = (f"{by}, ", f"group by {by}") if by else ("", "")

    def div(a: str, b: str) -> str:
        return f"case when ({b}) = 0 then 0.0 else cast({a} as double) / ({b}) end"

    return f"""
select {key}{div("ap", "p")} as aucpr, {div("auc", "p * n")} as auroc,
 {div("5 * tp", "5 * tp + 4 * (p - tp) + fp")} as f2, {div("tp", "p")} as tpr, {div("n - fp", "n")} as tnr,
 {div("tp", "tp + fp")} as "precision", cast({threshold} as double) as threshold,
 cast(p as bigint) as fraud_count, cast(p + n as bigint) as total_count, {div("p", "p + n")} as fraud_ratio,
 cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(n - fp as bigint) as tn, cast(p - tp as bigint) as fn
from (select {key}sum(cast(pos as double) * ctp / (ctp + cfp)) as ap,
  sum(cast(neg as double) * (ctp - pos / 2.0)) as auc, cast(sum(pos) as double) as p, cast(sum(neg) as double) as n,
  cast(sum(case when score >= {threshold} then pos else 0 end) as double) as tp,
  cast(sum(case when score >= {threshold} then neg else 0 end) as double) as fp
 from {source} {group}) t"""


THRESHOLD = 1.0
CTES["ties"] = _ties("")
CTES["ties_fold"] = _ties("fold")
CTES["ties_trial"] = _ties("trial, fold")
CTES["m_all"] = _metrics("ties", "", THRESHOLD)
CTES["m_fold"] = _metrics("ties_fold", "fold", THRESHOLD)
CTES["m_trial"] = _metrics("ties_trial", "trial, fold", THRESHOLD)

NEEDS = {
    "copies": ["detail"],
    "clean": ["detail"],
    "clean_copies": ["copies"],
    "stats": ["clean"],
    "moments": ["stats"],
    "features": ["moments"],
    "summary": ["summary_raw"],
    "excl": ["excl_raw"],
    "fraud": ["excl"],
    "enriched": ["features", "summary"],
    "labelled": ["summary", "fraud"],
    "providers": ["labelled"],
    "folds": ["providers"],
    "foldrows": ["folds"],
    "ties": ["scored"],
    "ties_fold": ["scored"],
    "ties_trial": ["scored"],
    "m_all": ["ties"],
    "m_fold": ["ties_fold"],
    "m_trial": ["ties_trial"],
}


def with_ctes(names: str, body: str) -> str:
    """`body` preceded by the named fragments and everything they build on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    parts = ",\n".join(f"{n} as ({CTES[n].strip()})" for n in order)
    return f"with {parts}\n{body.strip()}" if parts else body.strip()
