"""Composite datasets, monitors and reports."""

from pyspark.sql import functions as F

from ..fixtures import AS_OF
from ..functions.dates import as_of_column
from ..operators.cards import SITES
from ..plans.clean import clean_source, empty_clean, flat_source, merge_clean, merge_clean_flat
from ..plans.clinical import clinical_metrics
from ..plans.inventory import inventory_analytics
from ..plans.market import market_dna
from ..plans.mart import daily_facility_metrics, dim_patient, fact_encounters, monthly_report, readmission_rates
from ..plans.patients import patient_360, patient_acuity, patient_journey
from ..plans.products import product_snapshot
from ..plans.quality import hourly_load_monitor, latency_alert, quality_checks, write_checked
from ..plans.revenue import daily_kpis, revenue_analytics
from ..plans.sheet import clean_sheet
from ..session import scratch_path, spread, written
from . import query
from .aggregates import labelled
from .documents import shop_page

_LABELS = """
       CASE WHEN type LIKE '%payment%' THEN 'FINANCIAL' WHEN type LIKE '%clinical%' THEN 'CLINICAL'
            WHEN type LIKE '%admin%' THEN 'ADMINISTRATIVE' ELSE 'OTHER' END AS event_category,
       CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' WHEN event_time IS NULL THEN 'INVALID_TIMESTAMP' ELSE 'VALID' END AS validation_status
"""


def _raw(t):
    """RAW rows whose payload is the event as JSON; numbers travel as text."""
    at, form = F.col("event_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS"
    # Every third event was sent with the offset of its place: the same instant in another text.
    ahead = F.concat(F.date_format(at + F.expr("INTERVAL 3 HOURS"), form), F.lit("+03:00"))
    when = F.when(F.crc32(F.encode("id", "UTF-8")) % 3 == 0, ahead).otherwise(F.date_format(at, form))
    line = F.to_json(F.struct("id", "type", F.col("amount").cast("string").alias("amount"), when.alias("event_time")))
    raw = t("fx_raw_events").select(
        "facility_id", F.lit("events").alias("source_table"), "ingested_at", F.parse_json(line).alias("payload"), F.md5(line).alias("row_hash")
    )
    # RAW is a stored table; the queries start from it.
    return written(raw, "raw")


@query(f"""
SELECT id AS event_id, facility_id, event_time, CAST(event_time AS DATE) AS event_date, type AS event_type, amount, 'KES' AS currency, ingested_at,
       TIMESTAMP '{AS_OF}' AS processed_at, '1.0' AS _etl_version, FALSE AS is_duplicate, {_LABELS}
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY facility_id, id ORDER BY ingested_at DESC) AS rn FROM fx_raw_events WHERE id IS NOT NULL) WHERE rn = 1
""")
def ds_clean_events(t):
    raw, now = _raw(t), as_of_column(AS_OF)
    first = clean_source(raw.filter(F.col("ingested_at") < as_of_column("2024-01-16 00:00:00")))
    stored = written(merge_clean(empty_clean(t.spark), first, now), "clean")
    # A late first delivery changes nothing where a newer version is stored.
    return merge_clean(stored, clean_source(raw), now).select(
        "event_id", "facility_id", "event_time", "event_date", "event_type", "amount", "currency", "ingested_at",
        "processed_at", "_etl_version", "is_duplicate", "event_category", "validation_status",
    )


@query("""
SELECT id AS event_id, facility_id, 'events' AS source_table, event_time, type AS event_type, amount, ingested_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY facility_id, id ORDER BY ingested_at DESC) AS rn FROM fx_raw_events WHERE id IS NOT NULL) WHERE rn = 1
""")
def ds_clean_events_flat(t):
    raw = _raw(t)
    text = F.to_json("payload")
    # Every third line holds an array with the record and one without id.
    shape = F.when(F.crc32(F.col("row_hash")) % 3 == 0, F.concat(F.lit("["), text, F.lit(',{"id":" ","type":"x"}]'))).otherwise(text)
    lines = raw.withColumn("payload", F.parse_json(shape))
    # Delivery and stored table are made of these rows; each is read more than once.
    source = written(flat_source(lines), "flat")
    stored = source.filter(F.col("ingested_at") < as_of_column("2024-01-16 00:00:00")).withColumn("event_type", F.lit("old"))
    return merge_clean_flat(stored, source).drop("payload")


@query("""
SELECT p.patient_id, first_name, last_name, first_name || ' ' || last_name AS full_name, date_of_birth AS dob, gender, city, created_date,
       2001 - year(date_of_birth) AS age,
       CASE WHEN 2001 - year(date_of_birth) < 18 THEN 'PEDIATRIC' WHEN 2001 - year(date_of_birth) BETWEEN 18 AND 65 THEN 'ADULT' ELSE 'GERIATRIC' END AS age_group,
       COALESCE(v.total_encounters, 0) AS total_encounters, COALESCE(v.emergency_visits, 0) AS emergency_visits,
       COALESCE(v.admissions, 0) AS admissions, v.avg_los, b.total_billed, COALESCE(b.total_paid, 0) AS total_paid,
       COALESCE(b.total_pending, 0) AS total_pending, COALESCE(b.total_denied, 0) AS total_denied, c.diagnoses, v.last_visit_date,
       date_diff('day', v.last_visit_date, DATE '2001-03-31') AS days_since_last_visit,
       CASE WHEN v.last_visit_date >= DATE '2000-12-31' THEN 'ACTIVE' WHEN v.last_visit_date >= DATE '2000-03-31' THEN 'INACTIVE' ELSE 'LAPSED' END AS patient_status
FROM fx_patients p LEFT JOIN ox_visits v USING (patient_id) LEFT JOIN ox_codes c USING (patient_id)
LEFT JOIN (SELECT patient_id, CAST(SUM(amount) AS DECIMAL(38,2)) AS total_billed,
             CAST(SUM(CASE WHEN payment_status = 'paid' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS total_paid,
             CAST(SUM(CASE WHEN payment_status = 'pending' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS total_pending,
             CAST(SUM(CASE WHEN payment_status = 'denied' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS total_denied
           FROM fx_billing GROUP BY 1) b USING (patient_id)
""")
def ds_patient_360(t):
    return patient_360(t("fx_patients"), t("fx_encounters"), t("fx_diagnoses"), t("fx_billing"), "2001-03-31 00:00:00")


@query("""
SELECT d.*, w.avg_daily_revenue, w.weekly_revenue, w.active_days, w.revenue_quality_pct, m.monthly_revenue, m.mom_growth_pct,
       CAST(gross_revenue AS DOUBLE) / NULLIF(CAST(SUM(gross_revenue) OVER (PARTITION BY revenue_date) AS DOUBLE), 0) AS revenue_contribution_pct,
       CAST(SUM(gross_revenue) OVER (PARTITION BY d.facility_id ORDER BY revenue_date NULLS LAST, event_type NULLS LAST, currency NULLS LAST
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS rolling_7day_revenue,
       CAST(SUM(gross_revenue) OVER r30 AS DOUBLE) / NULLIF(COUNT(gross_revenue) OVER r30, 0) AS rolling_30day_avg_revenue
FROM ox_daily d
LEFT JOIN ox_weekly w ON date_trunc('week', d.revenue_date) = w.week_start AND d.facility_id = w.facility_id
LEFT JOIN ox_monthly m ON date_trunc('month', d.revenue_date) = m.month_start AND d.facility_id = m.facility_id
WINDOW r30 AS (PARTITION BY d.facility_id ORDER BY revenue_date NULLS LAST, event_type NULLS LAST, currency NULLS LAST ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
""")
def ds_revenue(t):
    return revenue_analytics(labelled(t))


@query("""
SELECT m.*, quantile_cont(CAST(length_of_stay_hours AS DOUBLE), 0.5) OVER (PARTITION BY encounter_type) AS median_los_by_type,
       CAST(SUM(diagnosis_count) OVER (PARTITION BY department_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY department_id) AS avg_diagnosis_by_dept,
       CASE WHEN discharge_disposition IN ('expired', 'hospice') THEN 'MORTALITY'
            WHEN discharge_disposition = 'home' AND length_of_stay_hours < 24 THEN 'SHORT_STAY'
            WHEN discharge_disposition = 'home' AND length_of_stay_hours >= 24 THEN 'HOME_DISCHARGE'
            WHEN discharge_disposition IN ('skilled_nursing', 'rehab') THEN 'POST_ACUTE' ELSE 'OTHER' END AS discharge_category
FROM ox_encounter_metrics m
""")
def ds_clinical(t):
    return clinical_metrics(t("fx_encounters"), t("fx_diagnoses"), t("fx_procedures"))


@query(f"""
SELECT movement_date, facility_id, product_id, product_name, product_category, receipts, issues, adjustments, "returns", receipt_cost, issue_cost,
       net_change, unit_cost, current_stock, round(moving_avg_cost, 6) AS moving_avg_cost, monthly_usage_cost, monthly_usage_quantity,
       date_diff('day', last_movement_date, DATE '{AS_OF[:10]}') AS days_since_last_movement,
       CASE WHEN current_stock <= 0 THEN 'OUT_OF_STOCK' WHEN current_stock < monthly_usage_quantity * 0.5 THEN 'LOW_STOCK'
            WHEN current_stock < monthly_usage_quantity * 1.5 THEN 'ADEQUATE' ELSE 'OVERSTOCKED' END AS stock_status,
       CAST(current_stock AS DOUBLE) / NULLIF(CAST(monthly_usage_quantity AS DOUBLE) / 30, 0) AS days_of_supply,
       round(CAST(current_stock AS DOUBLE) * moving_avg_cost, 4) AS inventory_value
FROM ox_position
""")
def ds_inventory(t):
    # Hot keys are counted on the movements before their products' names are joined to them.
    keys = t("lineitem").select(F.col("l_partkey").cast("string").alias("product_id"), F.concat(F.lit("F"), (F.col("l_suppkey") % 5).cast("string")).alias("facility_id"))
    out = inventory_analytics(t("fx_stock_movements"), AS_OF, keys)
    return out.withColumns({"moving_avg_cost": F.round("moving_avg_cost", 6), "inventory_value": F.round("inventory_value", 4)})


@query("""
SELECT CAST(event_time AS DATE) AS date, facility_id, COUNT(DISTINCT patient_id) AS unique_patients,
       COUNT(DISTINCT CASE WHEN event_category = 'FINANCIAL' THEN event_id END) AS financial_transactions,
       COUNT(DISTINCT CASE WHEN event_category = 'CLINICAL' THEN event_id END) AS clinical_encounters,
       CAST(SUM(CASE WHEN event_category = 'FINANCIAL' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS total_revenue,
       CAST(SUM(CASE WHEN event_category = 'FINANCIAL' THEN amount END) AS DOUBLE)
         / NULLIF(COUNT(CASE WHEN event_category = 'FINANCIAL' THEN amount END), 0) AS avg_transaction_value,
       CAST(SUM(CASE WHEN validation_status = 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
       CAST(SUM(CASE WHEN validation_status <> 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_records,
       CAST(SUM(CASE WHEN validation_status = 'VALID' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100 AS data_quality_pct
FROM ox_labelled GROUP BY 1, 2
""")
def ds_daily_kpis(t):
    return daily_kpis(labelled(t))


@query("""
SELECT *, NTILE(5) OVER (ORDER BY acuity_score DESC NULLS FIRST, patient_id) AS risk_quintile FROM ox_risk
""")
def ds_patient_acuity(t):
    return patient_acuity(t("fx_encounters"), t("fx_diagnoses"), labelled(t))


@query("SELECT * FROM ox_journey")
def ds_patient_journey(t):
    return patient_journey(labelled(t))


@query(f"""
SELECT sha256(facility_id || '|' || encounter_id) AS encounter_sk, encounter_id, patient_id, provider_id, facility_id, department_id, encounter_type,
       CAST(admit_ts AS DATE) AS admit_date, strftime(admit_ts, '%H:%M:%S') AS admit_time, CAST(discharge_ts AS DATE) AS discharge_date,
       strftime(discharge_ts, '%H:%M:%S') AS discharge_time, CAST(date_diff('hour', admit_ts, discharge_ts) AS DECIMAL(10,2)) AS length_of_stay_hours,
       d.c AS primary_diagnosis_code, p.c AS primary_procedure_code, CAST(NULL AS VARCHAR) AS drg_code, discharge_disposition, total_charges,
       CASE WHEN payment_status = 'paid' THEN total_charges ELSE 0 END AS total_payments,
       CASE WHEN payment_status = 'denied' THEN total_charges ELSE 0 END AS total_adjustments,
       CASE WHEN payment_status = 'denied' THEN 0 ELSE total_charges END AS net_revenue,
       COALESCE(CAST(next_admit AS DATE) <= CAST(discharge_ts AS DATE) + 30, FALSE) AS readmission_within_30d,
       TIMESTAMP '{AS_OF}' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at, 'batch-1' AS _etl_batch_id
FROM (SELECT *, LEAD(admit_ts) OVER (PARTITION BY patient_id ORDER BY admit_ts, encounter_id) AS next_admit FROM fx_encounters)
LEFT JOIN (SELECT encounter_id, MIN(diagnosis_code) AS c FROM fx_diagnoses GROUP BY 1) d USING (encounter_id)
LEFT JOIN (SELECT encounter_id, MIN(procedure_code) AS c FROM fx_procedures GROUP BY 1) p USING (encounter_id)
""")
def ds_fact_encounters(t):
    return fact_encounters(t("fx_encounters"), t("fx_diagnoses"), t("fx_procedures"), AS_OF, "batch-1")


@query(f"""
SELECT sha256(patient_id) AS patient_sk, patient_id, first_name, last_name, first_name || ' ' || last_name AS full_name, date_of_birth,
       CAST(2024 - year(date_of_birth) AS INTEGER) AS age, gender, created_date, TRUE AS is_active,
       sha256(first_name || '|' || COALESCE(last_name, '') || '|' || CAST(date_of_birth AS VARCHAR) || '|' || gender) AS patient_hash,
       TIMESTAMP '{AS_OF}' AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current FROM fx_patients
""")
def ds_dim_patient(t):
    return dim_patient(t("fx_patients"), AS_OF).select(
        "patient_sk", "patient_id", "first_name", "last_name", "full_name", "date_of_birth", "age", "gender", "created_date",
        "is_active", "patient_hash", "_valid_from", "_valid_to", "_is_current",
    )


@query(f"""
SELECT *, CAST(NULL AS DECIMAL(10,2)) AS avg_los_hours, CAST(NULL AS DECIMAL(38,2)) AS total_revenue, TIMESTAMP '{AS_OF}' AS created_at FROM ox_metrics
""")
def ds_daily_facility(t):
    return daily_facility_metrics(labelled(t), AS_OF).select(
        "metric_date", "facility_id", "total_encounters", "unique_patients", "avg_revenue_per_encounter",
        "avg_los_hours", "total_revenue", "created_at",
    )


_QUALITY = """
SELECT 'row_count' AS check_name, CAST(COUNT(*) AS VARCHAR) AS check_value, CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS check_status
FROM ox_labelled WHERE event_date = DATE '2024-01-30'
UNION ALL SELECT 'duplicate_check', CAST(COUNT(*) AS VARCHAR), CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END
FROM (SELECT event_id FROM ox_labelled GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'null_check', CAST(COUNT(*) AS VARCHAR), CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM ox_labelled WHERE event_id IS NULL
UNION ALL SELECT 'freshness_check', strftime(MAX(event_time), '%Y-%m-%d %H:%M:%S'),
  CASE WHEN MAX(event_time) >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR THEN 'PASS' ELSE 'FAIL' END FROM ox_labelled
"""


@query(_QUALITY)
def ds_quality(t):
    return quality_checks(labelled(t), "2024-01-30 00:00:00")


@query(_QUALITY)
def ds_quality_on_write(t):
    return write_checked(labelled(t), scratch_path(t.spark, "clean"), "2024-01-30 00:00:00")


_POINTS = "(p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y)"


@query(f"""
SELECT branch, CASE WHEN n > 0 THEN CAST(floor(base_pop * power(CAST(1.042 AS DOUBLE), 7)) AS BIGINT) ELSE 0 END AS est_pop,
       lifestyle_drivers, social_drivers, competition, high_pressure_comp,
       (CASE WHEN high_pressure_comp > 3 THEN 'URGENT: Price-match competitors. Channel shift to WhatsApp Delivery.' ELSE 'STABLE: Maintain margins. Focus on loyalty.' END)
       || ' | ' || (CASE WHEN lifestyle_drivers > 10 THEN 'UPSELL: Target Gyms/Salons. Grow Beauty (20% -> 25%) & Body Building (3% -> 8%).'
          WHEN social_drivers > 50 THEN 'NIGHT ECONOMY: High impulse-buy potential. Stock Sexual Health & Recovery.'
          ELSE 'CORE: Protect Chronic care. Stock for regular patient refills.' END) AS actionable_strategy
FROM (SELECT b.branch, any_value(b.base_pop) AS base_pop, COUNT(p.poi_id) AS n,
   CAST(SUM(CASE WHEN regexp_matches(lower(p.name), 'gym|fitness|salon|beauty|spa|barber') THEN 1 ELSE 0 END) AS BIGINT) AS lifestyle_drivers,
   CAST(SUM(CASE WHEN regexp_matches(lower(p.name), 'bar|pub|nightclub|wines|spirits|restaurant|liquor') THEN 1 ELSE 0 END) AS BIGINT) AS social_drivers,
   CAST(SUM(CASE WHEN regexp_matches(lower(p.name), 'pharmacy|chemist|hospital|clinic|dawa') THEN 1 ELSE 0 END) AS BIGINT) AS competition,
   CAST(SUM(CASE WHEN regexp_matches(lower(p.name), 'pharmacy|chemist|hospital|clinic|dawa') AND {_POINTS} <= 90000 THEN 1 ELSE 0 END) AS BIGINT) AS high_pressure_comp
  FROM fx_branches b LEFT JOIN fx_pois p ON {_POINTS} <= 1000000 GROUP BY 1)
""")
def ds_market_dna(t):
    return market_dna(t("fx_branches"), t("fx_pois"))


@query("""
SELECT TIMESTAMP '2024-01-02 08:00:00' AS scrape_date, product_name, current_price, original_price,
       round((original_price - current_price) / original_price * 100, 2) AS discount_percentage, url, product_id, product_sku FROM (
  SELECT *, '7' AS product_id, 's7' AS product_sku, ROW_NUMBER() OVER (PARTITION BY product_name ORDER BY scrape_no) AS rn FROM ox_price) WHERE rn = 1
""")
def ds_product_snapshot(t):
    pages = t("fx_products").select(F.col("scrape_no").alias("page_id"), shop_page("shop_cart").alias("html"))
    return product_snapshot(spread(pages), SITES["shop_cart"], "2024-01-02 08:00:00").select(
        "scrape_date", "product_name", "current_price", "original_price", "discount_percentage", "url", "product_id", "product_sku"
    )


@query("""
SELECT claim_id, COALESCE(TRY_CAST(NULLIF(total_bill, '') AS DOUBLE), 0) AS total_bill,
       COALESCE(strftime(adm_day, '%Y-%m-%d'), '') AS adm_date,
       COALESCE(CAST(TRY_CAST(age_or_dob AS DOUBLE) AS VARCHAR), age_or_dob) AS age_or_dob FROM fx_sheet
""")
def ds_sheet_clean(t):
    return clean_sheet(t("fx_sheet").drop("adm_day").toDF("Claim ID", " Total Bill", "ADM_DATE", "Age or DOB"))


# ---- reports and monitors

@query("""
SELECT facility_id, COUNT(*) AS total_discharges,
       CAST(SUM(CASE WHEN next_admit <= discharge_date + 30 THEN 1 ELSE 0 END) AS BIGINT) AS readmissions,
       CAST(round(SUM(CASE WHEN next_admit <= discharge_date + 30 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS DECIMAL(5,2)) AS readmission_rate
FROM (SELECT facility_id, discharge_date, LEAD(admit_date) OVER (PARTITION BY patient_id ORDER BY admit_date, encounter_id) AS next_admit
      FROM fx_facts WHERE discharge_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') GROUP BY 1
""")
def tvf_readmission_rates(t):
    return readmission_rates(t("fx_facts"), "1996-01-01", "1999-12-31")


_MONTH = "DATE '2024-01-01'"


@query(f"""
WITH days AS (SELECT * FROM ox_metrics WHERE date_trunc('month', metric_date) = {_MONTH}),
procedures AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY facility_id ORDER BY n DESC, code NULLS LAST) AS place FROM (
    SELECT e.facility_id, p.code, COUNT(*) AS n, CAST(SUM(e.total_charges) AS DECIMAL(38,2)) AS charges
    FROM fx_encounters e LEFT JOIN (SELECT encounter_id, MIN(procedure_code) AS code FROM fx_procedures GROUP BY 1) p USING (encounter_id)
    WHERE date_trunc('month', admit_ts + INTERVAL 25 YEAR) = {_MONTH} GROUP BY 1, 2)),
facilities AS (SELECT facility_id FROM days UNION SELECT facility_id FROM procedures),
people AS (SELECT gender, 2024 - year(date_of_birth) AS age FROM fx_patients WHERE date_trunc('month', created_date) = {_MONTH})
SELECT facility_id, 'day' AS part, CAST(metric_date AS VARCHAR) AS item, total_encounters AS n, unique_patients AS patients, avg_revenue_per_encounter AS amount FROM days
UNION ALL SELECT facility_id, 'procedure', code, n, NULL, charges FROM procedures WHERE place <= 10
UNION ALL SELECT facility_id, 'age', age_group, n, NULL, NULL FROM facilities, (
  SELECT CASE WHEN age < 18 THEN 'Pediatric' WHEN age BETWEEN 18 AND 40 THEN 'Young Adult' WHEN age BETWEEN 41 AND 65 THEN 'Middle Age' ELSE 'Geriatric' END AS age_group,
         COUNT(*) AS n FROM people GROUP BY 1)
UNION ALL SELECT facility_id, 'gender', gender, n, NULL, NULL FROM facilities, (SELECT gender, COUNT(*) AS n FROM people WHERE gender IS NOT NULL GROUP BY 1)
""")
def fn_monthly_report(t):
    """The nested record, a row for each of its entries."""
    facts = fact_encounters(t("fx_encounters"), t("fx_diagnoses"), t("fx_procedures"), AS_OF, "batch-1")
    shifted = facts.withColumn("admit_date", F.add_months("admit_date", 12 * 25))
    report = written(monthly_report(daily_facility_metrics(labelled(t), AS_OF), shifted, dim_patient(t("fx_patients"), AS_OF), "2024-01-01"), "report")

    def entries(path: str, part: str, item: str, n: str, patients: str | None = None, amount: str | None = None):
        rows = report.select("facility_id", F.explode(F.try_variant_get("report", path, "array<variant>")).alias("v"))
        value = lambda name, kind: F.try_variant_get("v", f"$.{name}", kind) if name else F.lit(None).cast(kind)
        return rows.select(
            "facility_id", F.lit(part).alias("part"), value(item, "string").alias("item"), value(n, "bigint").alias("n"),
            value(patients, "bigint").alias("patients"), value(amount, "decimal(38,2)").alias("amount"),
        )

    genders = report.select("facility_id", F.explode(F.try_variant_get("report", "$.patient_demographics.gender_split", "map<string,bigint>")).alias("item", "n"))
    return (
        entries("$.facility_metrics", "day", "metric_date", "total_encounters", "unique_patients", "avg_revenue_per_encounter")
        .unionByName(entries("$.top_procedures", "procedure", "primary_procedure_code", "procedure_count", None, "total_charges"))
        .unionByName(entries("$.patient_demographics.age_groups", "age", "age_group", "patient_count"))
        .unionByName(genders.withColumn("part", F.lit("gender")), allowMissingColumns=True)
    )


@query("""
SELECT date_trunc('hour', _loaded_at) AS hour_bucket, facility_id, module_source, source_table, COUNT(*) AS record_count,
       COUNT(DISTINCT row_hash) AS unique_records, CAST(SUM(CASE WHEN validation_status <> 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       MIN(_loaded_at) AS first_load, MAX(_loaded_at) AS last_load, date_diff('minute', MIN(_loaded_at), MAX(_loaded_at)) AS load_duration_minutes
FROM fx_loads WHERE _loaded_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY GROUP BY 1, 2, 3, 4
""")
def str_hourly_monitor(t):
    return hourly_load_monitor(t("fx_loads"), AS_OF)


@query("""
SELECT f.facility_id, h.hour_bucket, CAST(0 AS BIGINT) AS record_count
FROM (SELECT DISTINCT facility_id FROM fx_loads) f
JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-30 00:00:00', TIMESTAMP '2024-01-30 22:00:00', INTERVAL 1 HOUR)) AS hour_bucket) h ON TRUE
LEFT JOIN (SELECT facility_id, CASE WHEN hour(_loaded_at) % 6 = CAST(substr(facility_id, 2) AS INT) THEN _loaded_at - INTERVAL 1 HOUR ELSE _loaded_at END AS at
           FROM fx_loads) l ON l.facility_id = f.facility_id AND date_trunc('hour', l.at) = h.hour_bucket
WHERE l.facility_id IS NULL
""")
def str_latency_alert(t):
    # A facility's loads of every sixth hour came an hour early, which leaves that hour quiet.
    own = F.hour("_loaded_at") % 6 == F.expr("CAST(substr(facility_id, 2) AS INT)")
    early = F.col("_loaded_at") - F.expr("INTERVAL 1 HOUR")
    loads = t("fx_loads").withColumn("_loaded_at", F.when(own, early).otherwise(F.col("_loaded_at")))
    return latency_alert(loads, loads, AS_OF)
