import pytest
from pyspark.sql import functions as F

from helpers import rows
from peerledger.functions import coerce, names
from peerledger.operators import clean


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("12", 12),
        ("12.5", 12),
        ("-12.9", -12),
        (" 7 ", 7),
        ("1e3", 1000),
        ("*", None),
        ("", None),
        ("G0008", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_to_int(spark, text, expected):
    assert one(spark, coerce.to_int, text) == expected


def test_npi_needs_64_bits(spark):
    assert one(spark, coerce.npi_key, " 1000000001 ") == 1000000001
    assert one(spark, coerce.npi_key, "9999999999") == 9999999999
    assert one(spark, coerce.npi_key, 1003000126, "bigint") == 1003000126


@pytest.mark.parametrize(
    "text, expected", [("$1,234.5", 1234.5), ("1234.5", 1234.5), ("*", None), ("", None), ("$", None), (None, None)]
)
def test_money(spark, text, expected):
    assert one(spark, coerce.money, text) == expected


@pytest.mark.parametrize(
    "text, expected", [("20200315", "2020-03-15"), ("00000000", None), ("0", None), ("20201341", None), (None, None)]
)
def test_compact_date(spark, text, expected):
    got = one(spark, coerce.compact_date, text)
    assert (None if got is None else str(got)) == expected


def test_lower_names_rejects_case_clash(spark):
    assert names.lower_names(spark.createDataFrame([(1, 2)], "Aa int, bB int")).columns == ["aa", "bb"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="only by case"):
            names.lower_names(spark.createDataFrame([(1, 2)], "Aa int, aA int"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


LINE = (
    "Rndrng_NPI string, year string, Rndrng_Prvdr_Type string, Place_Of_Srvc string, HCPCS_Cd string,"
    " Tot_Srvcs string, Tot_Benes string, Tot_Bene_Day_Srvcs string, Avg_Sbmtd_Chrg string,"
    " Avg_Mdcr_Pymt_Amt string, Rndrng_Prvdr_City string"
)


def lines(spark, *records):
    return spark.createDataFrame(list(records), LINE)


def test_copies_are_found_after_currency_and_alias_but_before_integers(spark):
    df = lines(
        spark,
        ("1", "2020", "CRNA", "F", "G0008", "3", None, "3", "$1,000", "10", "Here"),
        ("1", "2020", "Certified Registered Nurse Anesthetist", "F", "G0008", "3", "5", "3", "1000", "10", "There"),
        ("1", "2020", "CRNA", "F", "G0009", "3", "5", "3", "1000", "10", "Here"),
        ("1", "2020", "CRNA", "F", "G0009", "3.5", "5", "3", "1000", "10", "Here"),
    )
    got = clean.clean_detail(df)
    assert "rndrng_prvdr_city" not in got.columns and "_npi" not in got.columns
    assert rows(got, "hcpcs_cd", "tot_srvcs", "tot_benes") == [("G0008", 3, 5), ("G0009", 3, 5), ("G0009", 3, 5)]
    assert dict(got.dtypes)["rndrng_npi"] == "bigint"


def test_only_absent_beneficiaries_are_imputed(spark):
    df = lines(
        spark,
        ("1", "2020", "A", "F", "1", "1", None, "1", "1", "1", ""),
        ("2", "2020", "A", "F", "1", "1", "*", "1", "1", "1", ""),
    )
    assert rows(clean.clean_detail(df), "rndrng_npi", "tot_benes") == [(1, 5), (2, None)]


def test_summary_modes(spark):
    df = spark.createDataFrame(
        [("7", "2020", "I", "*", "$1,5"), (None, "2020", "O", "3", None)],
        "RNDRNG_NPI string, year string, rndrng_prvdr_ent_cd string, tot_hcpcs_cds string, tot_sbmtd_chrg string",
    )
    typed = clean.clean_summary(df)
    assert rows(typed) == [(7, 2020, "I", 0.0, 15.0), (None, 2020, "O", 3.0, 0.0)]
    assert rows(clean.clean_summary(df, mode="parity")) == [(0, 2020, 0.0, 3.0, 0.0), (7, 2020, 0.0, 0.0, 15.0)]


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows(clean.audit_nulls(df, ["a", "b"])) == [(1, 2)]
    with pytest.raises(ValueError, match="missing"):
        clean.audit_nulls(df, ["a", "z"])
