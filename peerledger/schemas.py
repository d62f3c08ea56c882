"""Input contracts and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values -------------------------------------------------------------------------------

# Exclusion codes that count as fraud.
FRAUD_CODES = ("1128a1", "1128a2", "1128a3", "1128a4", "1128b4", "1128b7")

MONEY_COLUMNS = ("avg_sbmtd_chrg", "avg_mdcr_alowd_amt", "avg_mdcr_pymt_amt", "avg_mdcr_stdzd_amt")

# Provider identity and address.
IDENTITY_COLUMNS = (
    "rndrng_prvdr_last_org_name",
    "rndrng_prvdr_first_name",
    "rndrng_prvdr_mi",
    "rndrng_prvdr_crdntls",
    "rndrng_prvdr_st1",
    "rndrng_prvdr_st2",
    "rndrng_prvdr_city",
    "rndrng_prvdr_state_abrvtn",
    "rndrng_prvdr_state_fips",
    "rndrng_prvdr_zip5",
    "rndrng_prvdr_ruca",
    "rndrng_prvdr_ruca_desc",
    "rndrng_prvdr_cntry",
)
DETAIL_DROPPED = (*IDENTITY_COLUMNS, "hcpcs_desc")
SUMMARY_DROPPED = (
    *IDENTITY_COLUMNS,
    "drug_sprsn_ind",
    "med_sprsn_ind",
    "bene_race_wht_cnt",
    "bene_race_black_cnt",
    "bene_race_api_cnt",
    "bene_race_hspnc_cnt",
    "bene_race_natind_cnt",
    "bene_race_othr_cnt",
)

# Specialties that appear under two spellings.
SPECIALTY_ALIASES = {
    "Allergy/ Immunology": "Allergy/Immunology",
    "CRNA": "Certified Registered Nurse Anesthetist",
}
DETAIL_RENAMES = {"rfrg_crdntls": "rfrg_prvdr_crdntls"}

# How the names of summary columns begin that hold numbers, published as text or not.
SUMMARY_NUMBERS = ("tot_", "drug_", "med_", "bene_")

MISSING_BENEFICIARIES = 5
FLAT_STD = 0.01
DEFAULT_THRESHOLD = 0.0004
LANDING_BATCH_ROWS = 5000  # of one page of the service
LANDING_FILE_ROWS = 1_000_000

COUNT_COLUMNS = ("tot_benes", "tot_srvcs", "tot_bene_day_srvcs")
GROUP_KEYS = ("rndrng_npi", "year", "rndrng_prvdr_type", "place_of_srvc")
MEASURES = {
    "tot_srvcs": "line_srvc_cnt",
    "tot_benes": "bene_unique_cnt",
    "tot_bene_day_srvcs": "bene_day_srvc_cnt",
    "avg_sbmtd_chrg": "average_submitted_chrg_amt",
    "avg_mdcr_pymt_amt": "average_medicare_payment_amt",
}
STATISTICS = ("min", "max", "mean", "median", "sum", "std")
PEER_METRICS = (
    "line_srvc_cnt",
    "average_medicare_payment_amt",
    "bene_unique_cnt",
    "average_submitted_chrg_amt",
)
SPECIALTY = "rndrng_prvdr_type"
PROVIDER = "rndrng_npi"
LABEL = "fraud_label"
CATEGORICAL = ("rndrng_prvdr_type", "place_of_srvc")
SUMMARY_CATEGORIES = ("rndrng_prvdr_ent_cd", "rndrng_prvdr_mdcr_prtcptg_ind")


# ---- Contracts ----------------------------------------------------------------------------------


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Landed files were typed batch by batch, so everything that may drift is declared as text; scans cast each file to it.
DETAIL = T.StructType(
    _strings(
        "rndrng_npi",
        "rndrng_prvdr_type",
        "rndrng_prvdr_ent_cd",
        "rndrng_prvdr_mdcr_prtcptg_ind",
        "hcpcs_cd",
        "hcpcs_drug_ind",
        "place_of_srvc",
        *COUNT_COLUMNS,
        *MONEY_COLUMNS,
    )
)
EXCLUSIONS = T.StructType(_strings("npi", "excltype", "excldate", "reindate"))
PAGE = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)
RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("parent_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)
