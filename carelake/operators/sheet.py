"""Cleaning of hand-kept sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The numeric and date columns of the insurance sheet.
NUMERIC_COLUMNS = [
    "total_bill", "claim_total", "los", "coverage_limit_kes",
    "annual_premium", "claim_frequency", "avg_claim_amount",
    "total_claims_cost", "loss_ratio", "profit_margin",
    "risk_score", "fraud_probability", "churn_probability",
    "county_cost_index", "nhif_usage", "telemedicine_usage",
    "mpesa_usage", "family_size", "deductible_pct",
]
DATE_COLUMNS = ["adm_date", "dis_date", "claim_date", "batch_date"]
DATE_FORMATS = [
    "yyyy/M/d", "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyyMMdd",
    "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy",
]
# Year first, with any ISO time, fraction and zone behind it; the date is the one written.
ISO_DATE = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?$"
# What reads as a number; Java's casts also take a type letter at the end.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case column names with underscores for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def to_number(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    value = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(value), value)


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Unreadable numbers become 0; columns the sheet lacks are skipped."""
    present = [c for c in (columns or NUMERIC_COLUMNS) if c in df.columns]
    return df.withColumns({c: F.coalesce(to_number(c), F.lit(0.0)) for c in present})


def coerce_date(df: DataFrame, columns: list[str] | None = None, formats: list[str] | None = None) -> DataFrame:
    """Readable dates as yyyy-MM-dd text, NULL otherwise."""
    present = [c for c in (columns or DATE_COLUMNS) if c in df.columns]

    def read(c: str) -> Column:
        text = F.trim(F.col(c))
        iso = F.nullif(F.regexp_extract(text, ISO_DATE, 1), F.lit("")).try_cast("date")
        tries = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats or DATE_FORMATS]
        return F.date_format(F.coalesce(iso, *tries), "yyyy-MM-dd")

    return df.withColumns({c: read(c) for c in present})


def coerce_mixed(df: DataFrame, column: str = "age_or_dob") -> DataFrame:
    """Numbers in their number form, other text as it is."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.coalesce(to_number(column).cast("string"), F.col(column)))


def blank_missing(df: DataFrame) -> DataFrame:
    """Missing text, and cells that read 'nan', become ''."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(F.col(c).isNull() | (F.col(c) == "nan"), "").otherwise(F.col(c)) for c in texts}
    )


def decimals_to_double(df: DataFrame) -> DataFrame:
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})
