import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from peerledger import schemas as S
from peerledger.plans import runlog
from peerledger.sources import pages, sinks, tables
from peerledger.streaming.landing import land_page_stream, read_landed, read_progress

FIELDS = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.StringType())])


def records(first, n):
    return [{"id": i, "amount": f"${i},5"} for i in range(first, first + n)]


def page(year, offset, data, wrapped=False, total=None):
    body = {"data": data, "meta": {"totalCount": total}} if wrapped else data
    return (year, offset, json.dumps(body))


def landed(spark, *items):
    return spark.createDataFrame(list(items), S.PAGE)


def test_both_payload_shapes_decode(spark):
    df = landed(
        spark, page(2020, 0, records(0, 2)), page(2020, 2, records(2, 1), True, 3), page(2021, 0, []), page(2021, 0, [], True, 0)
    )
    assert rows(pages.decode_pages(df, FIELDS)) == [(2020, i, f"${i},5") for i in range(3)]


def test_audit_finds_gaps_short_pages_repeats_and_equal_years(spark):
    complete = [page(y, o, records(o, 2 if o < 4 else 1), o == 0, 5) for y in (2019, 2020) for o in (0, 2, 4)]
    hole = [page(2021, 0, records(0, 2)), page(2021, 4, records(4, 2)), page(2021, 4, records(4, 2))]
    short = [page(2022, 2, records(2, 1)), page(2022, 3, records(3, 2))]
    df = landed(spark, *complete, *hole, *short)
    got = {r["year"]: r.asDict() for r in pages.audit_pages(df, FIELDS, 2).collect()}
    assert got[2019] | {"digest": ""} == {
        "year": 2019, "pages": 3, "records": 5, "declared_total": 5, "gaps": 0, "repeated_pages": 0,
        "early_short_pages": 0, "digest": "", "same_content_as": None, "overlaps": 0, "corrupt_pages": 0,
    }
    assert got[2020]["same_content_as"] == 2019
    assert (got[2021]["gaps"], got[2021]["repeated_pages"]) == (1, 1)
    assert (got[2022]["gaps"], got[2022]["early_short_pages"]) == (1, 1)  # does not start at 0


def test_corrupt_pages_are_never_lost(spark):
    cut = page(2020, 4, records(4, 2), True, 6)[2][:-5]  # all records are there, the end is not
    broken = [(2020, 4, cut), (2021, 0, None), (2022, 0, "oops")]
    df = landed(spark, page(2020, 0, records(0, 2)), page(2020, 2, records(2, 2)), *broken, page(2022, 1, records(1, 3)), page(2022, 3, records(3, 2), True, 9))
    with pytest.raises(Exception, match="corrupt page: year 202"):
        pages.decode_pages(df, FIELDS).collect()
    assert len(rows(pages.decode_pages(df, FIELDS, corrupt="reject"))) == 9
    assert {r[:2] for r in rows(pages.rejected_pages(df, FIELDS))} == {(2020, 4), (2021, 0), (2022, 0)}
    got = {r["year"]: r.asDict() for r in pages.audit_pages(df, FIELDS, 2).collect()}
    assert (got[2020]["pages"], got[2020]["gaps"], got[2020]["corrupt_pages"]) == (2, 0, 1)  # a broken last page
    assert (got[2021]["pages"], got[2021]["records"], got[2021]["corrupt_pages"]) == (0, 0, 1)  # nothing but a broken page
    assert (got[2022]["gaps"], got[2022]["overlaps"], got[2022]["declared_total"]) == (1, 1, 9)


def test_batches_have_bounded_files(spark, tmp_path):
    df = spark.range(0, 1000).selectExpr("id", "2019 + cast(id >= 900 as int) as year")
    sinks.land_batches(df, str(tmp_path / "out"), rows_per_file=100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000
    sizes = back.groupBy("_metadata.file_path").count().collect()
    assert max(r["count"] for r in sizes) <= 100
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"year=2019", "year=2020"}


def test_stream_lands_each_page_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("pages", "landed", "state"))
    landed(spark, page(2020, 0, records(0, 3))).write.json(source)
    land_page_stream(spark, source, target, state, FIELDS)
    land_page_stream(spark, source, target, state, FIELDS)
    assert rows(read_landed(spark, target), "id") == [(0,), (1,), (2,)]
    landed(spark, page(2021, 0, records(7, 1))).write.mode("append").json(source)
    land_page_stream(spark, source, target, state, FIELDS)
    assert rows(read_landed(spark, target), "id", "year") == [(0, 2020), (1, 2020), (2, 2020), (7, 2021)]


def test_year_from_path_and_missing_path(spark, tmp_path):
    for year in (2018, 2019):
        spark.range(year, year + 1).write.parquet(str(tmp_path / f"x_details_{year}"))
    spark.range(1).write.parquet(str(tmp_path / "x_details_none"))
    df = tables.scan_yearly(spark, str(tmp_path), "x_details")
    assert rows(df, "id", "year") == [(0, None), (2018, 2018), (2019, 2019)]
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tables.scan(spark, str(tmp_path / "nowhere"))


def test_training_scan_and_sink_count(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_table(spark.range(25), path) == 25
    df, seen = tables.scan_training(spark, path, sample_rows=4, keys=["id"])
    assert rows(df) == [(0,), (1,), (2,), (3,)] and seen.get["rows"] == 4
    assert sinks.write_table(spark.range(3), "saved_rows", as_table=True) == 3
    assert spark.table("saved_rows").count() == 3
    spark.sql("drop table saved_rows")


def test_run_log_appends_numbers_only(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = runlog.record(spark, "r1", "trial", {"depth": 3}, {"aucpr": 0.5, "note": "x", "n": 2}, prefix="cv_")
    runlog.append_runs(first, path)
    runlog.append_runs(runlog.record(spark, "r2", "trial", {}, {"aucpr": 0.6}, parent_id="r1"), path)
    assert rows(runlog.read_metrics(spark, path), "run_id", "metric", "value") == [
        ("r1", "cv_aucpr", 0.5), ("r1", "cv_n", 2.0), ("r2", "aucpr", 0.6),
    ]


def test_breaks_are_a_list_to_fetch_again(spark):
    whole = [page(2019, o, records(o, 2), True, 6) for o in (0, 2, 4)]
    holes = [page(2020, 2, records(2, 2)), page(2020, 6, records(6, 2)), page(2020, 7, records(7, 2), True, 12), page(2020, 7, records(7, 1))]
    far = [page(2021, o, records(o, 2)) for o in (0, 10_000)]
    broken = [(2022, 0, "oops"), (2023, 0, None), page(2023, 2, [], True, 8)]
    df = landed(spark, *whole, *holes, *far, *broken).repartition(3)
    assert rows(pages.page_breaks(df, FIELDS, 2)) == sorted(
        [
            (2020, "gap", 0, 2), (2020, "gap", 4, 6), (2020, "overlap", 7, 8), (2020, "gap", 9, 12),
            (2021, "gap", 2, 10_000), (2022, "gap", 0, None), (2023, "gap", 0, 8),
        ],
        key=repr,
    )
    assert pages.page_breaks(landed(spark, *whole).limit(0), FIELDS).count() == 0


def test_stream_sets_corrupt_pages_aside(spark, tmp_path):
    folders = {n: str(tmp_path / n) for n in ("source", "target", "checkpoint", "rejected", "progress")}
    landed(spark, page(2020, 0, records(0, 2)), (2020, 2, "oops"), page(2020, 4, records(4, 2), True, 6)).coalesce(1).write.json(folders["source"])
    (tmp_path / "source" / "junk.json").write_text("no json at all\n")
    land_page_stream(spark, fields=FIELDS, **folders)
    aside = spark.read.parquet(folders["rejected"])
    assert {(r.year, r.offset, r.payload) for r in aside.collect()} == {(2020, 2, "oops"), (None, None, None)}
    assert {r.file.rsplit("/", 1)[1] == "junk.json" for r in aside.collect() if r.year is None} == {True}
    landed(spark, page(2020, 2, records(2, 2)), page(2021, 0, records(0, 1))).write.mode("append").json(folders["source"])
    land_page_stream(spark, fields=FIELDS, **folders)
    assert rows(read_landed(spark, folders["target"]), "year", "id") == sorted([*((2020, i) for i in range(6)), (2021, 0)])
    expected = [(2020, 3, 6, 1, 6, 6), (2021, 1, 1, 0, 1, None), (None, 0, 0, 1, None, None)]
    assert rows(read_progress(spark, folders["progress"])) == sorted(expected, key=repr)
    land_page_stream(spark, fields=FIELDS, **folders)
    assert rows(read_progress(spark, folders["progress"])) == sorted(expected, key=repr)


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    import shutil

    folders = {n: str(tmp_path / n) for n in ("source", "target", "checkpoint", "rejected", "progress")}
    landed(spark, page(2020, 0, records(0, 2)), (2020, 2, "oops")).write.json(folders["source"])
    land_page_stream(spark, fields=FIELDS, **folders)
    shutil.rmtree(tmp_path / "checkpoint" / "commits")  # as if the run had died before it noted the batch as done
    land_page_stream(spark, fields=FIELDS, **folders)
    assert rows(read_landed(spark, folders["target"]), "id") == [(0,), (1,)]
    assert rows(read_progress(spark, folders["progress"])) == [(2020, 1, 2, 1, 2, None)]
    assert spark.read.parquet(folders["rejected"]).count() == 1


def test_a_failed_overwrite_leaves_the_former_table(spark, tmp_path):
    path = str(tmp_path / "t")
    failing = spark.range(10).select(F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("bigint")).alias("id"))
    sinks.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="stop"):
        sinks.write_table(failing, path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    assert sinks.write_table(spark.read.parquet(path).filter("id > 0"), path) == 2  # read and overwritten by one plan
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.write_table(spark.range(3), "kept_rows", as_table=True)
    with pytest.raises(Exception, match="stop"):
        sinks.write_table(failing, "kept_rows", as_table=True)
    assert spark.table("kept_rows").count() == 3
    assert sinks.write_table(spark.range(8), "kept_rows", as_table=True) == 8
    assert spark.table("kept_rows").count() == 8
    spark.sql("drop table kept_rows")


def test_pages_are_not_gathered_by_year(spark, tmp_path):
    """Events too large for Spark to broadcast their totals unasked: pages still stay where they are grouped."""
    from peerledger.catalog import views

    rows = [(i, i % 3, "click", 1.0, "p") for i in range(1200)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_seconds("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        pages = views.pages(spark, str(tmp_path))
        assert "SortMergeJoin" not in pages._jdf.queryExecution().executedPlan().toString()
        assert pages.count() == 9
    finally:
        spark.conf.set(name, before)


def test_stream_parses_a_page_once(spark, tmp_path, monkeypatch):
    """Rejected pages, progress and landed records come from one parse of each batch."""
    parses = []
    monkeypatch.setattr(pages, "_parsed", lambda *given, parse=pages._parsed: parses.append(given) or parse(*given))
    folders = {n: str(tmp_path / n) for n in ("source", "target", "checkpoint", "rejected", "progress")}
    sound, cut, empty = page(2020, 0, records(0, 3)), page(2020, 3, records(3, 2)), page(2021, 0, [], True, 7)
    cut = (*cut[:-1], cut[-1][:-4])
    none = (2021, 5, None)
    spark.createDataFrame([sound, cut, empty, none], S.PAGE).write.option("ignoreNullFields", False).json(folders["source"])
    land_page_stream(spark, fields=FIELDS, **folders)
    assert len(parses) == 1
    assert sorted(r["id"] for r in read_landed(spark, folders["target"]).collect()) == [0, 1, 2]
    rejected = spark.read.parquet(folders["rejected"])
    assert sorted(map(tuple, rejected.select("year", "offset", "payload").collect())) == [(2020, 3, cut[-1]), (2021, 5, None)]
    progress = {r["year"]: tuple(r)[1:] for r in read_progress(spark, folders["progress"]).collect()}
    assert progress == {2020: (1, 3, 1, 3, None), 2021: (1, 0, 1, 0, 7)}
