"""Turning delivered shapes (nested documents, odd spreadsheets, wide extracts) into flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Nested schemas, declared so that reading needs no inference pass.
STUDY_SCHEMA = """
protocolSection STRUCT<
  identificationModule: STRUCT<nctId: STRING, briefTitle: STRING>,
  statusModule: STRUCT<overallStatus: STRING, startDateStruct: STRUCT<date: STRING>, completionDateStruct: STRUCT<date: STRING>>,
  designModule: STRUCT<phases: ARRAY<STRING>, enrollmentInfo: STRUCT<count: BIGINT>>,
  conditionsModule: STRUCT<conditions: ARRAY<STRING>>,
  sponsorCollaboratorsModule: STRUCT<leadSponsor: STRUCT<name: STRING>>>
"""

REPORT_SCHEMA = """
safetyreportid STRING, receivedate STRING, serious STRING, seriousnessdeath STRING,
primarysource STRUCT<reportercountry: STRING>,
patient STRUCT<patientonsetage: STRING, patientsex: STRING,
  drug: ARRAY<STRUCT<medicinalproduct: STRING>>, reaction: ARRAY<STRUCT<reactionmeddrapt: STRING>>>
"""


def flatten_studies(df: DataFrame) -> DataFrame:
    """One flat row per study; the first list entry stands for the list."""
    p = "protocolSection"
    return df.selectExpr(
        f"{p}.identificationModule.nctId AS nct_id",
        f"{p}.identificationModule.briefTitle AS brief_title",
        f"{p}.statusModule.overallStatus AS overall_status",
        f"CASE WHEN size({p}.designModule.phases) > 0 THEN {p}.designModule.phases[0] ELSE 'NA' END AS phase",
        f"get({p}.conditionsModule.conditions, 0) AS primary_condition",
        f"{p}.sponsorCollaboratorsModule.leadSponsor.name AS lead_sponsor",
        f"{p}.designModule.enrollmentInfo.count AS enrollment_count",
        f"{p}.statusModule.startDateStruct.date AS start_date",
        f"{p}.statusModule.completionDateStruct.date AS completion_date",
    )


def explode_reports(df: DataFrame) -> DataFrame:
    """One row per reaction of a report; a report without reactions yields nothing."""
    return df.select("*", F.explode("patient.reaction").alias("hit")).selectExpr(
        "safetyreportid AS safety_report_id",
        "receivedate AS receive_date",
        "serious",
        "seriousnessdeath AS seriousness_death",
        "patient.patientonsetage AS patient_age",
        "patient.patientsex AS patient_sex",
        "primarysource.reportercountry AS reporter_country",
        "get(patient.drug, 0).medicinalproduct AS drug_name",
        "hit.reactionmeddrapt AS reaction_term",
    )


# Spreadsheet header -> column name (fixed values).
ORDER_SHEET_NAMES = {
    "Invoice": "invoice_no", "StockCode": "stock_code", "Description": "description",
    "Quantity": "quantity", "InvoiceDate": "invoice_date", "Price": "unit_price",
    "Customer ID": "customer_id", "Country": "country",
}


def normalise_orders(*sheets: DataFrame) -> DataFrame:
    """Stack same-shaped sheets; invoice numbers become text and NaN customer ids become NULL longs."""
    stacked = sheets[0]
    for sheet in sheets[1:]:
        stacked = stacked.unionByName(sheet)
    named = stacked.withColumnsRenamed(ORDER_SHEET_NAMES)
    customer = F.col("customer_id").cast("double")
    return named.withColumns({
        "invoice_no": F.col("invoice_no").cast("string"),
        "customer_id": F.when(~F.isnan(customer), customer).cast("bigint"),
    })


CROP_CATEGORIES = ("AREA HARVESTED", "PRODUCTION", "YIELD")


def state_crop_rows(df: DataFrame) -> DataFrame:
    """Census crop rows at state level of the three statistics the trend uses."""
    return df.where(
        (F.col("SOURCE_DESC") == "CENSUS") & (F.col("SECTOR_DESC") == "CROPS")
        & (F.col("AGG_LEVEL_DESC") == "STATE") & F.col("STATISTICCAT_DESC").isin(*CROP_CATEGORIES)
    ).select("COMMODITY_DESC", "STATISTICCAT_DESC", "UNIT_DESC", "STATE_ALPHA", "STATE_NAME", "YEAR", "VALUE")
