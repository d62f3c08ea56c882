import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from peerledger import schemas as S
from peerledger.operators import clean, joins
from peerledger.operators.sampling import digest_cut, undersample
from peerledger.session import shared_folder
from peerledger.sources import tables


def test_files_of_different_types_meet_one_contract(spark, tmp_path):
    kinds = ("npi string, excltype string, excldate string", "NPI bigint, excltype string, EXCLDATE int, extra int", "npi double, excldate date")
    records = (("1000000001", "1128a1", "20200315"), (1000000002, "1128b7", 20200316, 5), (3.0, datetime.date(2020, 3, 17)))
    for i, (kind, record) in enumerate(zip(kinds, records)):
        spark.createDataFrame([record], kind).write.parquet(str(tmp_path / f"batch={i}"))
    got = tables.scan(spark, str(tmp_path / "batch=*"), S.EXCLUSIONS)
    assert got.columns == S.EXCLUSIONS.names
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in S.EXCLUSIONS.fields]
    assert rows(got, "npi", "excltype", "excldate", "reindate") == sorted(
        [("1000000001", "1128a1", "20200315", None), ("1000000002", "1128b7", "20200316", None), ("3.0", None, "20200317", None)], key=repr
    )


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("", "")


def many_files(folder, files):
    """Three schemas in turn, in folders of years."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = [("npi", pa.string()), ("NPI", pa.int64()), ("npi", pa.float64())]
    for i in range(files):
        name, kind = kinds[i % 3]
        (folder / f"year={2018 + i % 4}").mkdir(parents=True, exist_ok=True)
        table = pa.table({name: pa.array([i], pa.int64()).cast(kind), "excltype": pa.array([f"1128a{i}"])})
        pq.write_table(table, folder / f"year={2018 + i % 4}" / f"part-{i:05d}.parquet")


def test_many_files_of_three_schemas(spark, tmp_path):
    few, many = tmp_path / "few table", tmp_path / "many"
    many_files(few, 24)
    many_files(many, 600)
    contract = T.StructType([*S.EXCLUSIONS.fields, T.StructField("year", T.IntegerType())])
    _, fewer = jobs_of(spark, "few", lambda: tables.scan(spark, str(few), contract))
    got, jobs = jobs_of(spark, "many", lambda: tables.scan(spark, str(many), contract))
    assert jobs <= fewer + 4  # listing many files takes jobs of its own; none is per file
    assert sorted(int(float(r.npi)) for r in got.collect()) == list(range(600))
    assert {(r.excltype, r.year) for r in got.select("excltype", "year").collect()} == {(f"1128a{i}", 2018 + i % 4) for i in range(600)}
    pruned = got.filter("year = 2019")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(year") == 3
    assert pruned.count() == 150


def test_files_that_agree_keep_their_partitions(spark, tmp_path):
    frame = spark.range(20).select(F.col("id").cast("string").alias("npi"), (2018 + F.col("id") % 4).cast("int").alias("year"))
    frame.write.partitionBy("year").parquet(str(tmp_path / "t"))
    contract = T.StructType([T.StructField("npi", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("other", T.DoubleType())])
    for path in ("t", "t/year=*", "t/*/*.parquet"):
        got = tables.scan(spark, str(tmp_path / path), contract)
        assert rows(got) == sorted([(str(i), 2018 + i % 4, None) for i in range(20)], key=repr)


def test_footers_of_a_store_that_only_spark_opens(spark, tmp_path, monkeypatch):
    many_files(tmp_path / "t", 6)
    files = sorted(f"file://{p}" for p in (tmp_path / "t").rglob("*.parquet"))

    def unreadable(batches):
        for batch in batches:
            paths = batch.column(0)
            yield pa.RecordBatch.from_arrays([paths, pa.nulls(len(paths), pa.string())], ["path", "shape"])

    expected = [[p.rsplit("/", 1)[1] for p in group] for group in tables.same_schema(spark, files).values()]
    monkeypatch.setattr(tables, "_footers", unreadable)
    got = [[p.rsplit("/", 1)[1] for p in group] for group in tables.same_schema(spark, files).values()]
    assert sorted(map(sorted, got)) == sorted(map(sorted, expected)) and len(got) == 3


def test_a_missing_path_is_named(spark, tmp_path):
    for contract in (None, S.EXCLUSIONS):
        with pytest.raises(FileNotFoundError, match="nowhere"):
            tables.scan(spark, str(tmp_path / "nowhere"), contract)


def test_years_of_files_with_numbers(spark, tmp_path):
    for year, kind, value in ((2019, "bigint", 7), (2020, "string", "8")):
        spark.createDataFrame([(1, value)], f"Rndrng_NPI bigint, Tot_Srvcs {kind}").write.parquet(str(tmp_path / f"claims_details_{year}"))
    got = tables.scan_yearly(spark, str(tmp_path), "claims_details", S.DETAIL)
    assert rows(got, "rndrng_npi", "tot_srvcs", "year") == [("1", "7", 2019), ("1", "8", 2020)]


def test_summary_keeps_text_dates_and_booleans(spark):
    df = spark.createDataFrame(
        [("1", 2020, "$1,5", "Springfield", datetime.date(2020, 1, 2), True, 3, "I")],
        "rndrng_npi string, year int, tot_x string, town string, seen date, flag boolean, n int, rndrng_prvdr_ent_cd string",
    )
    kept = clean.clean_summary(df).first()
    assert tuple(kept) == (1, 2020, 15.0, "Springfield", datetime.date(2020, 1, 2), True, 3.0, "I")
    parity = clean.clean_summary(df, mode="parity").first()
    assert tuple(parity) == (1, 2020, 15.0, 0.0, datetime.date(2020, 1, 2), True, 3.0, 0.0)


def test_ids_that_did_not_parse_may_repeat(spark):
    summary = spark.createDataFrame([("bad", 2020, "1"), ("worse", 2020, "2"), ("5", 2020, "3")], "rndrng_npi string, year int, tot_x string")
    stats = spark.createDataFrame([(5, 2020, 1.0)], "rndrng_npi bigint, year int, v double")
    assert joins.join_summary(stats, clean.clean_summary(summary, mode="parity")).count() == 1


def test_exact_undersample_keeps_the_smallest_hashes_without_a_window(spark):
    df = spark.range(5000).select("id", (F.col("id") % 50 == 0).cast("int").alias("fraud_label"))
    got = undersample(df, ["id"], ratio=7, exact=True)
    assert got.filter("fraud_label = 1").count() == 100 and got.filter("fraud_label = 0").count() == 700
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    digests = sorted(r[0] for r in df.select(F.md5(F.col("id").cast("string").cast("binary")).alias("d")).collect())
    named = spark.createDataFrame([(d,) for d in digests], "digest string")
    for target in (1, 2, 17, 4999, 5000):
        prefix = digest_cut(named, target, step=1)
        assert sum(d[: len(prefix)] <= prefix for d in digests) == target
    assert digest_cut(named, 0) is None and digest_cut(named, 6000) == "g"


def test_scratch_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_too_many_values_of_one_column(spark):
    from peerledger.operators.encode import category_values

    df = spark.createDataFrame([(str(i), "x") for i in range(5)], "a string, b string")
    assert len(category_values(df, ["a", "b"])["a"]) == 5
    with pytest.raises(ValueError, match=r"more than 4 distinct values in \['a'\]"):
        category_values(df, ["a", "b"], max_values=4)
