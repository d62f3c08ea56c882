import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_cleaning import lines
from peerledger.functions.names import label_column, label_text
from peerledger.operators import encode, joins, labels


def exclusions(spark):
    return spark.createDataFrame(
        [
            ("1", " 1128A1 ", "20180315", "00000000"),
            ("1", "1128a1", "20180315", "00000000"),
            ("2", "1128b7", "20180315", "20200101"),
            ("3", "1128b8", "20180315", "00000000"),
            ("0000000000", "1128a1", "20180315", "0"),
            ("", "1128a1", "20180315", "0"),
            (None, "1128a1", "20180315", "0"),
            ("4", "1128a3", "00000000", "0"),
        ],
        "NPI string, EXCLTYPE string, EXCLDATE string, REINDATE string",
    )


def claims(spark):
    records = [(n, y) for n in (1, 2, 3, 4, 5) for y in (2017, 2018, 2019, 2020)]
    return spark.createDataFrame(records, "rndrng_npi bigint, year int")


def test_exclusion_cleaning(spark):
    cleaned = labels.clean_exclusions(exclusions(spark))
    assert rows(cleaned.select("npi").distinct()) == [(1,), (2,), (3,), (4,)]
    fraud = labels.fraud_exclusions(cleaned)
    assert [(r[0], r[1], r[2] and str(r[2])) for r in rows(fraud)] == [
        (1, 2018, None),
        (2, 2018, "2020-01-01"),
        (4, None, None),
    ]


def test_integer_typed_npis_survive(spark):
    df = spark.createDataFrame([(5, "1128a1", 20200101, 0), (0, "1128a1", 20200101, 0)], "npi int, excltype string, excldate int, reindate int")
    got = labels.clean_exclusions(df).collect()
    assert [(r["npi"], r["excl_year"], r["reindate_parsed"]) for r in got] == [(5, 2020, None)]


@pytest.mark.parametrize("limit", [1000, 0])
def test_flagging(spark, limit):
    fraud = labels.fraud_exclusions(labels.clean_exclusions(exclusions(spark)))
    flagged = labels.flag_providers(claims(spark), fraud, limit)
    assert flagged.count() == 20
    assert {r[0] for r in rows(flagged.filter("fraud_label = 1"), "rndrng_npi")} == {1, 2, 4}
    assert rows(labels.distinct_positive(flagged)) == [(3,)]
    assert rows(labels.class_distribution(flagged)) == [(20, 12, 0.6)]
    dated = labels.flag_providers_as_of(claims(spark), fraud, [2017, 2018, 2019, 2020], limit)
    assert dated.count() == 20
    assert rows(dated.filter("fraud_label = 1"), "rndrng_npi", "year") == [
        (1, 2018), (1, 2019), (1, 2020), (2, 2018), (2, 2019),
    ]


def test_empty_distribution(spark):
    empty = spark.createDataFrame([], "fraud_label int")
    assert rows(labels.class_distribution(empty)) == [(0, 0, 0.0)]


def test_provider_labels_drop_unknown_provider(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1)], "rndrng_npi bigint, fraud_label int")
    assert rows(labels.provider_labels(df)) == [(1, 1), (2, 0)]


AWKWARD = ["A/B", "A-B", "Pain (Acute), Dr. O'Neil & Co", "x" * 70, "plain"]


def test_name_rule_matches_between_plan_and_column(spark):
    df = spark.createDataFrame([(v,) for v in AWKWARD], "v string").select("v", label_column(F.col("v")).alias("l"))
    assert {r["v"]: r["l"] for r in df.collect()} == {v: label_text(v) for v in AWKWARD}
    assert label_text(AWKWARD[2]) == "Pain_Acute_Dr_ONeil_and_Co"
    assert len(label_text("x" * 70)) == 50


def categories(spark):
    return spark.createDataFrame([("A/B", 1), ("A-B", 2), ("C", 3), (None, 4)], "t string, id int")


def test_one_hot_collisions_are_joined(spark):
    got = encode.one_hot(categories(spark), ["t"])
    assert got.columns == ["id", "t_ohe_A_B", "t_ohe_C"]
    assert rows(got) == [(1, 1, 0), (2, 1, 0), (3, 0, 1), (4, 0, 0)]


def test_one_hot_collisions_can_be_numbered(spark):
    got = encode.one_hot(categories(spark), ["t"], on_collision="suffix")
    assert got.columns == ["id", "t_ohe_A_B", "t_ohe_A_B_2", "t_ohe_C"]
    assert rows(got)[:2] == [(1, 0, 1, 0), (2, 1, 0, 0)]


def test_too_many_categories_is_an_error(spark):
    with pytest.raises(ValueError, match="more than 2"):
        encode.category_values(categories(spark), ["t"], max_values=2)


def test_types_projection_and_vector(spark):
    df = spark.createDataFrame([(1, "2020", "x", None, 0), (0, "7.9", "3", 2.5, 1)], "fraud_label int, year string, t string, v double, k int")
    fixed = encode.fix_types(df)
    assert rows(fixed, "year", "t") == [(2020, 0), (7, 3)]  # sorted as text
    assert encode.training_projection(fixed).columns[-1] == "fraud_label"
    built = encode.assemble(fixed, ["year", "t", "v"], missing=-1.0).orderBy("k")
    assert [list(r["features"]) for r in built.collect()] == [[2020.0, 0.0, -1.0], [7.0, 3.0, 2.5]]


def test_sparse_flags_of_a_wide_domain(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id") % 20_000)).alias("kind"), F.lit(None).cast("string").alias("none"))
    with pytest.raises(ValueError, match="more than 5000"):
        encode.category_values(df, ["kind"])
    words = encode.vocabulary(df, ["kind", "none"])
    got = encode.one_hot_sparse(df, ["kind", "none"], words, keep_index=True).cache()
    distinct = df.select("kind").dropna().distinct().count()
    assert words.agg(F.min("index"), F.max("index"), F.countDistinct("index")).first() == (0, distinct - 1, distinct)
    assert got.count() == 30_000 and "kind" not in got.columns
    for r in got.filter("id % 997 < 3").collect():
        assert r.kind_ohe.size == distinct and r.none_ohe.numNonzeros() == 0
        assert r.kind_ohe.indices.tolist() == ([] if r.kind_index is None else [r.kind_index])
    assert got.filter("kind_index is null").count() == df.filter("kind is null").count()
    other = spark.createDataFrame([(1, "v1", None), (2, "unseen", None)], "id bigint, kind string, none string")
    seen = {r.id: r.kind_ohe.numNonzeros() for r in encode.one_hot_sparse(other, ["kind", "none"], words).collect()}
    assert seen == {1: 1, 2: 0}
    got.unpersist()


def test_broadcasts_are_bounded_by_bytes(spark):
    def plan(side):
        return spark.range(10).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()

    wide = spark.range(900).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    assert "strategy=broadcast" in plan(joins.bounded_broadcast(wide))
    assert "strategy=broadcast" not in plan(joins.bounded_broadcast(wide, max_bytes=2**20))
    assert "strategy=broadcast" not in plan(joins.bounded_broadcast(wide.select("id"), max_rows=899))
    joined = spark.range(10).join(joins.bounded_broadcast(wide, max_bytes=2**20), "id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 10
    nested = spark.createDataFrame([(1, [1, 2], None)], "id bigint, a array<int>, t string")
    assert nested.select(joins.row_bytes(nested.schema)).first()[0] > 8 * 4


def test_one_hot_queries_remove_copies_once(spark, monkeypatch):
    """The categories come from two columns of all lines; only the result itself removes copies."""
    from peerledger.catalog import feature_queries

    asked = []
    plain = feature_queries.clean.clean_detail
    monkeypatch.setattr(feature_queries.clean, "clean_detail", lambda df, **more: asked.append(more.get("distinct", True)) or plain(df, **more))
    for query in (feature_queries.one_hot, feature_queries.one_hot_sparse):
        asked.clear()
        monkeypatch.setattr(feature_queries.V, "detail", lambda spark, sf: lines(spark, ("1", "2020", "A", "F", "c", "1", "1", "1", "1", "1", "")))
        assert query(spark, "").count() == 1
        assert sorted(asked) == [False, True]
