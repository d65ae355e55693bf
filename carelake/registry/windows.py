"""Window functions.

Groups that are sums already (days of a facility) use plain windows; events of a
patient, which may be a third of the table, are counted first and cut into blocks
where they are too many.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.dates import hour_diff
from ..functions.nulls import mean, safe_div
from ..operators.dedup import latest_per_key
from ..plans.clinical import attach, encounter_metrics, median_by
from ..plans.inventory import daily_inventory, inventory_position, stock_windows
from ..plans.mart import next_in_group
from ..plans.patients import patient_acuity, patient_journey, patient_timeline
from ..plans.revenue import daily_revenue, monthly_revenue
from ..session import written
from . import query
from .aggregates import labelled


@query("""
SELECT id, facility_id, type, amount, ingested_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY facility_id, id ORDER BY ingested_at DESC, amount DESC) AS rn FROM fx_raw_events WHERE id IS NOT NULL) WHERE rn = 1
""")
def win_dedup_latest(t):
    raw = t("fx_raw_events").filter(F.col("id").isNotNull()).select("id", "facility_id", "type", "amount", "ingested_at")
    return latest_per_key(raw, ["facility_id", "id"], "ingested_at", ["amount"])


@query("SELECT facility_id, month_start, prev_month_revenue, mom_growth_pct FROM ox_monthly")
def win_mom_growth(t):
    return monthly_revenue(daily_revenue(labelled(t))).select("facility_id", "month_start", "prev_month_revenue", "mom_growth_pct")


_DAILY_KEYS = ["revenue_date", "facility_id", "event_type", "currency"]
_DAILY_SQL = "SELECT revenue_date, facility_id, event_type, currency, "
_FRAME = "PARTITION BY facility_id ORDER BY revenue_date NULLS LAST, event_type NULLS LAST, currency NULLS LAST ROWS BETWEEN {} PRECEDING AND CURRENT ROW"


def _rows():
    return Window.partitionBy("facility_id").orderBy(*[F.col(c).asc_nulls_last() for c in ("revenue_date", "event_type", "currency")])


@query(_DAILY_SQL + """
CAST(gross_revenue AS DOUBLE) / NULLIF(CAST(SUM(gross_revenue) OVER (PARTITION BY revenue_date) AS DOUBLE), 0) AS share FROM ox_daily
""")
def win_ratio_to_report(t):
    total = F.sum("gross_revenue").over(Window.partitionBy("revenue_date"))
    share = safe_div(F.col("gross_revenue").cast("double"), total.cast("double"))
    return daily_revenue(labelled(t)).select(*_DAILY_KEYS, share.alias("share"))


@query(_DAILY_SQL + f"CAST(SUM(gross_revenue) OVER ({_FRAME.format(6)}) AS DECIMAL(38,2)) AS rolling_sum FROM ox_daily")
def win_rolling_sum(t):
    rolling = F.sum("gross_revenue").over(_rows().rowsBetween(-6, 0)).cast("decimal(38,2)")
    return daily_revenue(labelled(t)).select(*_DAILY_KEYS, rolling.alias("rolling_sum"))


@query(_DAILY_SQL + f"""
CAST(SUM(gross_revenue) OVER ({_FRAME.format(29)}) AS DOUBLE) / NULLIF(COUNT(gross_revenue) OVER ({_FRAME.format(29)}), 0) AS rolling_avg FROM ox_daily
""")
def win_rolling_avg(t):
    w = _rows().rowsBetween(-29, 0)
    rolling = safe_div(F.sum("gross_revenue").over(w).cast("double"), F.count("gross_revenue").over(w))
    return daily_revenue(labelled(t)).select(*_DAILY_KEYS, rolling.alias("rolling_avg"))


@query("""
SELECT encounter_id, encounter_type, quantile_cont(CAST(length_of_stay_hours AS DOUBLE), 0.5) OVER (PARTITION BY encounter_type) AS median_los FROM ox_los
""")
def win_median(t):
    rows = t("fx_encounters").select("encounter_id", "encounter_type", hour_diff("admit_ts", "discharge_ts").alias("los"))
    return attach(rows, median_by(rows, "encounter_type", "los", "median_los"), "encounter_type").drop("los")


@query("""
SELECT encounter_id, department_id, CAST(SUM(diagnosis_count) OVER (PARTITION BY department_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY department_id) AS dept_avg
FROM ox_encounter_metrics
""")
def win_partition_avg(t):
    metrics = encounter_metrics(t("fx_encounters"), t("fx_diagnoses"), t("fx_procedures"))
    rows = written(metrics.select("encounter_id", "department_id", "diagnosis_count"), "dept")
    per = rows.groupBy("department_id").agg(mean("diagnosis_count").alias("dept_avg"))
    return attach(rows, per, "department_id").drop("diagnosis_count")


_STOCK_KEYS = ["movement_date", "facility_id", "product_id"]


@query("SELECT movement_date, facility_id, product_id, current_stock FROM ox_position")
def win_running_stock(t):
    return stock_windows(daily_inventory(t("fx_stock_movements"))).select(*_STOCK_KEYS, "current_stock")


@query("""
SELECT movement_date, facility_id, product_id, round(moving_avg_cost, 6) AS moving_avg_cost, monthly_usage_cost, monthly_usage_quantity FROM ox_position
""")
def win_moving_cost(t):
    return inventory_position(t("fx_stock_movements")).select(
        *_STOCK_KEYS, F.round("moving_avg_cost", 6).alias("moving_avg_cost"), "monthly_usage_cost", "monthly_usage_quantity"
    )


@query("SELECT movement_date, facility_id, product_id, last_movement_date FROM ox_position")
def win_last_date(t):
    return stock_windows(daily_inventory(t("fx_stock_movements"))).select(*_STOCK_KEYS, "last_movement_date")


@query("SELECT event_id, next_event_time, next_event_type, prev_event_time, days_since_last_event FROM ox_journey")
def win_lead_lag(t):
    return patient_timeline(labelled(t)).select(
        "event_id", "next_event_time", "next_event_type", "prev_event_time", "days_since_last_event"
    )


@query("SELECT event_id, cumulative_spend, moving_avg_spend FROM ox_journey")
def win_cumulative(t):
    return patient_timeline(labelled(t)).select("event_id", "cumulative_spend", "moving_avg_spend")


@query("SELECT event_id, event_number_in_month FROM ox_journey")
def win_rownum_month(t):
    return patient_timeline(labelled(t)).select("event_id", "event_number_in_month")


@query("SELECT event_id, first_interaction, last_interaction FROM ox_journey")
def win_first_last(t):
    return patient_timeline(labelled(t)).select("event_id", "first_interaction", "last_interaction")


@query("SELECT event_id, journey_step_id FROM ox_journey")
def win_dense_rank_global(t):
    return patient_journey(labelled(t)).select("event_id", "journey_step_id")


@query("""
SELECT patient_id, NTILE(5) OVER (ORDER BY acuity_score DESC NULLS FIRST, patient_id) AS risk_quintile FROM ox_risk
""")
def win_ntile_global(t):
    return patient_acuity(t("fx_encounters"), t("fx_diagnoses"), labelled(t)).select("patient_id", "risk_quintile")


@query("""
SELECT encounter_id, LEAD(admit_ts) OVER (PARTITION BY patient_id ORDER BY admit_ts, encounter_id) AS next_admit FROM fx_encounters
""")
def win_next_admit(t):
    rows = t("fx_encounters").select("encounter_id", "patient_id", "admit_ts")
    return next_in_group(rows, "patient_id", ["admit_ts", "encounter_id"], {"next_admit": "admit_ts"}).select("encounter_id", "next_admit")
