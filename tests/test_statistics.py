import math
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from peerledger.operators import joins, peers
from peerledger.operators.aggregate import _bucketed, claim_statistics, medians, provider_stats
from peerledger.operators.ranking import BUCKET, GROUP
from test_cleaning import lines


def raw(spark, repeat=1):
    records = []
    for i in range(60):
        npi = "1" if i % 3 == 0 else str(i % 7 + 2)  # provider 1 holds a third of the lines
        amount = "*" if i % 11 == 0 else f"${i * 3 + 1},0{i % 10}.5"
        record = (npi, "2020", "A" if i % 2 else "B", "F", str(i % 9), f"{i % 5}.5", str(i % 4), "2", amount, str(i), "")
        records += [record] * (repeat if i % 3 == 0 else 1)
    return lines(spark, *records)


def steady(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes])


@pytest.mark.parametrize("layout, crowded", [("spread", 1), ("colocate", 1), ("auto", 1000), ("auto", 10), ("auto", 1)])
def test_layouts_agree(spark, layout, crowded):
    # Summation order shows in the last digits of a deviation, nowhere else.
    expected = rows(steady(claim_statistics(raw(spark), layout="spread")))
    got = claim_statistics(raw(spark, repeat=5), layout=layout, crowded_rows=crowded)
    assert rows(steady(got)) == expected


def test_median_of_a_large_group_is_exact_in_every_layout(spark):
    spread = spark.range(60001).selectExpr(
        "'1' as rndrng_npi", "2020 as year", "'A' as rndrng_prvdr_type", "'F' as place_of_srvc", "cast(id as string) as hcpcs_cd",
        "cast((id * 7919) % 100003 as string) as tot_srvcs", "cast(id % 5 as string) as tot_benes", "cast(id as string) as tot_bene_day_srvcs",
        "concat('$', cast((id * 31) % 60013 as string), '.5') as avg_sbmtd_chrg", "if(id % 2 = 0, '*', cast(id as string)) as avg_mdcr_pymt_amt",
    )
    n = range(60001)
    middle = {
        "line_srvc_cnt_median": sorted((i * 7919) % 100003 for i in n)[30000],
        "bene_unique_cnt_median": 2,
        "bene_day_srvc_cnt_median": 30000,
        "average_submitted_chrg_amt_median": sorted((i * 31) % 60013 + 0.5 for i in n)[30000],
        "average_medicare_payment_amt_median": [i for i in n if i % 2][14999],
    }
    for layout, crowded in (("colocate", 1), ("spread", 1), ("auto", 100), ("auto", 10**6)):
        got = claim_statistics(spread, layout=layout, crowded_rows=crowded).first().asDict()
        assert {k: got[k] for k in middle} == middle


def test_colocated_layout_has_one_exchange(spark):
    df = claim_statistics(raw(spark), layout="colocate")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_statistics_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 2020, "A", "F", v, v, v, float(v), float(v)) for v in (1, 2, 3, 10)] + [(2, 2020, "A", "F", 4, 4, None, 4.0, None)],
        "rndrng_npi bigint, year int, rndrng_prvdr_type string, place_of_srvc string, tot_srvcs int, tot_benes int,"
        " tot_bene_day_srvcs int, avg_sbmtd_chrg float, avg_mdcr_pymt_amt float",
    )
    got = {r["rndrng_npi"]: r.asDict() for r in provider_stats(df).collect()}
    assert len(got[1]) == 34
    many = got[1]
    assert (many["line_srvc_cnt_min"], many["line_srvc_cnt_max"], many["line_srvc_cnt_sum"]) == (1, 10, 16)
    assert many["line_srvc_cnt_median"] == 2  # lower middle element, not interpolated
    assert many["line_srvc_cnt_std"] == pytest.approx(statistics.stdev([1, 2, 3, 10]))
    single = got[2]
    assert single["line_srvc_cnt_std"] == 0.0 and single["average_medicare_payment_amt_std"] == 0.0
    assert single["average_medicare_payment_amt_sum"] is None


def grouped(spark):
    values = [("A", 1.0), ("A", 2.0), ("A", 6.0), ("B", 5.0), ("C", 4.0), ("C", 4.0), ("Z", 0.0), (None, 3.0), (None, 5.0)]
    close = [("D", 1.0), ("D", 1.0 + 1e-4)]
    return spark.createDataFrame(values + close, "rndrng_prvdr_type string, m_sum double")


@pytest.mark.parametrize("plan", ["join", "window"])
def test_peer_features(spark, plan):
    got = rows(peers.peer_features(grouped(spark), ["m", "absent"], plan=plan).na.fill("none", ["rndrng_prvdr_type"]))
    by_group = {}
    for group, value, z, ratio in got:
        by_group.setdefault(group, []).append((value, z, ratio))
    assert by_group["B"] == [(5.0, 0.0, 1.0)]  # one member: deviation missing
    assert by_group["C"] == [(4.0, 0.0, 1.0)] * 2  # deviation zero
    assert by_group["Z"] == [(0.0, 0.0, 1.0)]  # mean zero
    assert [r[2] for r in by_group["none"]] == [0.75, 1.25]  # NULL is a peer group of its own
    spread = statistics.stdev([1.0, 1.0 + 1e-4])
    assert by_group["D"][0][1] == pytest.approx(-5e-5 / spread)  # small deviations are not floored
    z = [r[1] for r in by_group["A"]]
    assert sum(z) == pytest.approx(0) and statistics.stdev(z) == pytest.approx(1)


def test_peer_plans_agree_when_moments_are_too_many_to_broadcast(spark, monkeypatch):
    usual = rows(peers.peer_features(grouped(spark), ["m"]))
    monkeypatch.setattr(peers, "bounded_broadcast", lambda df: joins.bounded_broadcast(df, 0))
    assert rows(peers.peer_features(grouped(spark), ["m"])) == usual


def test_risk_ratios(spark):
    df = spark.createDataFrame(
        [(10.0, 4.0, 6, 3), (10.0, 0.0, 6, 0), (10.0, None, 6, None), (None, 2.0, None, 2)],
        "average_submitted_chrg_amt_sum double, average_medicare_payment_amt_sum double, line_srvc_cnt_sum int, bene_unique_cnt_sum int",
    )
    got = [(r["billing_inflation"], r["service_density"]) for r in peers.risk_ratios(df).collect()]
    assert got == [(2.5, 2.0), (1.0, 1.0), (1.0, 1.0), (None, None)]
    assert peers.risk_ratios(df.select("line_srvc_cnt_sum")).columns == ["line_srvc_cnt_sum"]


def test_summary_join(spark):
    left = spark.createDataFrame([(1, 2020, 5.0), (2, 2020, 6.0)], "rndrng_npi bigint, year int, x double")
    right = spark.createDataFrame([(1, 2020, 9.0, 8.0)], "rndrng_npi bigint, year int, x double, y double")
    assert rows(joins.join_summary(left, right)) == [(1, 2020, 5.0, 8.0)]
    with pytest.raises(ValueError, match="not unique"):
        joins.join_summary(left, right.union(right))
    assert joins.join_summary(left, right.union(right), check_unique=False).count() == 2
    assert math.isclose(right.select(F.avg("y")).first()[0], 8.0)


def test_exact_money(spark):
    as_float = claim_statistics(raw(spark), layout="spread").orderBy("rndrng_npi", "rndrng_prvdr_type")
    as_decimal = claim_statistics(raw(spark), money_type="decimal(18,2)").orderBy("rndrng_npi", "rndrng_prvdr_type")
    assert as_decimal.dtypes == as_float.dtypes
    name = "average_submitted_chrg_amt_sum"
    assert [r[name] for r in as_decimal.collect()] == pytest.approx([r[name] for r in as_float.collect()])


def test_staged_tables_go_to_the_named_folder(spark):
    from peerledger.session import shared_folder, stage_counted

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df, count = stage_counted(spark.range(7), "some")
    assert count == 7 and df.count() == 7
    assert df.inputFiles() and all(shared_folder(spark) + "/some-" in f for f in df.inputFiles())


def middles(values):
    ordered = sorted(values)
    return ordered[(len(ordered) + 1) // 2 - 1]


@pytest.mark.parametrize("sorted_values", [10**6, 50])
def test_medians_of_large_groups(spark, sorted_values):
    """One far outlier, whole numbers above 2**53, repeated values, no values at all."""
    import random

    draw = random.Random(7)
    tall = {
        "outlier": [float(v) for v in range(20000)] + [1e12],
        "large": [2**60 + draw.randrange(3000) for _ in range(9000)],
        "repeated": [5] * 3000 + list(range(1500)),
        "few": [3, 1, 2, 2],
        "none": [None],
    }
    rows = [(g, float(v) if g == "outlier" else None, v if g != "outlier" else None) for g, vs in tall.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, money double, n bigint").repartition(4)
    got = {r[0]["g"]: (r["a_median"], r["b_median"]) for r in medians(df, ["g"], {"money": "a", "n": "b"}, sorted_values).collect()}
    expected = {g: (middles(v), None) if g == "outlier" else (None, None if g == "none" else middles(v)) for g, v in tall.items()}
    assert got == expected


def test_an_outlier_leaves_buckets_even(spark):
    values = spark.range(100_000).select(F.struct(F.lit(1).alias("g")).alias(GROUP), F.when(F.col("id") == 7, 1e12).otherwise(F.col("id") / 1e6).alias("value"))
    sized = values.select("*", F.lit(1).alias("n"), F.lit(100_000).alias("values"), F.lit(50_000).alias("rank"))
    sizes = [r["count"] for r in _bucketed(sized, 0).groupBy(BUCKET).count().collect()]
    assert len(sizes) > 40 and max(sizes) < 100_000 / 8


def test_sketched_medians_are_near_in_rank(spark):
    import random

    draw = random.Random(1)
    values = [draw.paretovariate(0.7) for _ in range(30_000)]
    df = spark.createDataFrame([("x", v) for v in values], "g string, v double").repartition(6)
    found = provider_stats(df, ["g"], {"v": "v"}, median="sketch", accuracy=100).first()["v_median"]
    rank = sum(v <= found for v in values)
    assert found in values and abs(rank - 15_000) <= 30_000 / 100


def test_medians_of_small_groups_need_no_counted_maps(spark):
    """Odd, even and repeated values, NULL, NaN, no value at all, in each kind; the plan holds plain lists."""
    nan = float("nan")
    tall = {"odd": [3, 1, 2], "even": [4, 1, 3, 2], "repeated": [7, 7, 7, 1], "gaps": [None, 5, None, 9], "none": [None, None], "one": [-6]}
    rows = [(g, v, None if v is None else float(v), v) for g, vs in tall.items() for v in vs]
    kinds = "g string, i int, f float, d decimal(18,2)"
    rows = [(g, i, f, None if d is None else Decimal(d)) for g, i, f, d in rows] + [("nan", None, v, None) for v in (nan, 2.0, nan)]
    stats = provider_stats(spark.createDataFrame(rows, kinds).repartition(3), ["g"], {"i": "i", "f": "f", "d": "d"})
    assert "percentile" not in stats._jdf.queryExecution().executedPlan().toString().lower()
    got = {r["g"]: (r["i_median"], r["f_median"], r["d_median"]) for r in stats.collect()}
    assert math.isnan(got.pop("nan")[1])
    found = {g: [v for v in vs if v is not None] for g, vs in tall.items()}
    assert got == {g: (middles(v),) * 3 if v else (None,) * 3 for g, v in found.items()}


def test_only_large_groups_are_narrowed(spark, monkeypatch):
    """Groups of up to `sorted_values` rows take one grouped pass; NULL keys are groups too."""
    from peerledger.operators import aggregate

    sizes = {"a": 300, "b": 7, None: 200, "c": 1}
    df = spark.createDataFrame([(g, i * 37 % n) for g, n in sizes.items() for i in range(n)], "g string, v int").repartition(4)
    seen = []
    monkeypatch.setattr(aggregate, "medians", lambda part, *rest: seen.append({r["g"] for r in part.select("g").distinct().collect()}) or medians(part, *rest))
    for limit, large in ((100, [{"a", None}]), (1000, [])):
        seen.clear()
        got = {r["g"]: (r["v_median"], r["v_sum"]) for r in provider_stats(df, ["g"], {"v": "v"}, crowded=True, sorted_values=limit).collect()}
        assert got == {g: ((n + 1) // 2 - 1, n * (n - 1) // 2) for g, n in sizes.items()}
        assert seen == large


def test_sketches_are_for_crowded_provider_years(spark, monkeypatch):
    from peerledger.operators import aggregate

    made = []
    plain = aggregate.provider_stats
    monkeypatch.setattr(aggregate, "provider_stats", lambda part, **more: made.append(more.get("median", "exact")) or plain(part, **more))
    expected = steady(claim_statistics(raw(spark), layout="colocate"))
    apart = [c for c in expected.columns if not c.endswith("_median")]
    for accuracy, parts, compared in ((10_000, ["exact"], expected.columns), (12, ["exact", "sketch"], apart)):
        made.clear()
        got = steady(claim_statistics(raw(spark), median="sketch", accuracy=accuracy))
        assert made == parts
        assert rows(got, *compared) == rows(expected, *compared)
