"""Revenue and daily indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day, month_start, week_start
from ..functions.nulls import count_when, mean, safe_div, sum_when
from ..session import written


def daily_revenue(clean: DataFrame) -> DataFrame:
    status = F.col("validation_status")
    zero = F.lit(0).cast("decimal(38,2)")
    return (
        clean.filter(F.col("event_category") == "FINANCIAL")
        .groupBy(day("event_time").alias("revenue_date"), "facility_id", "event_type", "currency")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").cast("decimal(38,2)").alias("gross_revenue"),
            sum_when(status == "VALID", F.col("amount"), zero).cast("decimal(38,2)").alias("valid_revenue"),
            count_when(status == "MISSING_AMOUNT").alias("missing_amount_count"),
            count_when(status == "INVALID_TIMESTAMP").alias("invalid_timestamp_count"),
        )
    )


def weekly_revenue(daily: DataFrame) -> DataFrame:
    gross = F.sum("gross_revenue").cast("double")
    return daily.groupBy(week_start("revenue_date").alias("week_start"), "facility_id").agg(
        mean("gross_revenue").alias("avg_daily_revenue"),
        F.sum("gross_revenue").cast("decimal(38,2)").alias("weekly_revenue"),
        F.countDistinct("revenue_date").alias("active_days"),
        F.sum("transaction_count").alias("weekly_transactions"),
        (safe_div(F.sum("valid_revenue").cast("double"), gross) * 100).alias("revenue_quality_pct"),
    )


def monthly_revenue(daily: DataFrame) -> DataFrame:
    """Months per facility with the growth over the month before.

    The window runs over one row per facility and month.
    """
    months = daily.groupBy(month_start("revenue_date").alias("month_start"), "facility_id").agg(
        F.sum("gross_revenue").cast("decimal(38,2)").alias("monthly_revenue"),
        F.sum("valid_revenue").cast("decimal(38,2)").alias("monthly_valid_revenue"),
        F.sum("transaction_count").alias("monthly_transactions"),
    )
    w = Window.partitionBy("facility_id").orderBy(F.col("month_start").asc_nulls_last())
    change = (F.col("monthly_revenue") - F.col("prev_month_revenue")).cast("double")
    return months.withColumn("prev_month_revenue", F.lag("monthly_revenue").over(w)).withColumn(
        "mom_growth_pct", safe_div(change, F.col("prev_month_revenue").cast("double")) * 100
    )


def revenue_analytics(clean: DataFrame) -> DataFrame:
    """Daily revenue with its week, month, share of the day and rolling values.

    The daily rows (days x facilities x types x currencies, no longer events) are
    written once, so events are read once for the three levels. "7 day" and "30 day"
    frames count rows, in the order day, type, currency.
    """
    daily = written(daily_revenue(clean), "daily-revenue")
    weekly = weekly_revenue(daily).select(
        "week_start", "facility_id", "avg_daily_revenue", "weekly_revenue", "active_days", "revenue_quality_pct"
    )
    monthly = monthly_revenue(daily).select("month_start", "facility_id", "monthly_revenue", "mom_growth_pct")
    per_day = Window.partitionBy("revenue_date")
    rows = Window.partitionBy("facility_id").orderBy(
        F.col("revenue_date").asc_nulls_last(), F.col("event_type").asc_nulls_last(), F.col("currency").asc_nulls_last()
    )
    gross = F.col("gross_revenue")
    last30 = rows.rowsBetween(-29, 0)
    windowed = daily.select(
        "*",
        safe_div(gross.cast("double"), F.sum(gross).over(per_day).cast("double")).alias("revenue_contribution_pct"),
        F.sum(gross).over(rows.rowsBetween(-6, 0)).cast("decimal(38,2)").alias("rolling_7day_revenue"),
        safe_div(F.sum(gross).over(last30).cast("double"), F.count(gross).over(last30)).alias("rolling_30day_avg_revenue"),
    )
    return (
        windowed.withColumn("week_start", week_start("revenue_date"))
        .withColumn("month_start", month_start("revenue_date"))
        .join(weekly, ["week_start", "facility_id"], "left")
        .join(monthly, ["month_start", "facility_id"], "left")
        .drop("week_start", "month_start")
    )


def daily_kpis(clean: DataFrame) -> DataFrame:
    """Indicators per day and facility, in one pass over the events."""
    category, status = F.col("event_category"), F.col("validation_status")
    financial = category == "FINANCIAL"
    zero = F.lit(0).cast("decimal(38,2)")
    paid = F.when(financial, F.col("amount"))
    return clean.groupBy(day("event_time").alias("date"), "facility_id").agg(
        F.countDistinct("patient_id").alias("unique_patients"),
        F.countDistinct(F.when(financial, F.col("event_id"))).alias("financial_transactions"),
        F.countDistinct(F.when(category == "CLINICAL", F.col("event_id"))).alias("clinical_encounters"),
        sum_when(financial, F.col("amount"), zero).cast("decimal(38,2)").alias("total_revenue"),
        mean(paid).alias("avg_transaction_value"),
        count_when(status == "VALID").alias("valid_records"),
        count_when(status != "VALID").alias("invalid_records"),
        (count_when(status == "VALID").cast("double") / F.count("*") * 100).alias("data_quality_pct"),
    )
