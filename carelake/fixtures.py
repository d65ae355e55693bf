"""Inputs derived from the test tables, one SQL text for Spark and DuckDB alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
AS_OF = "2024-01-31 00:00:00"

FIXTURES = {
    "fx_clean_events": """
SELECT CAST(event_id AS STRING) AS event_id,
       'F' || CAST(user_id % 5 AS STRING) AS facility_id,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS event_time,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS event_date,
       CASE event_type WHEN 'purchase' THEN 'payment' WHEN 'view' THEN 'clinical_visit'
            WHEN 'click' THEN 'appointment' WHEN 'signup' THEN 'encounter' ELSE 'admin_error' END AS event_type,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(value AS DECIMAL(38,2)) END AS amount,
       CASE WHEN user_id % 3 = 0 THEN 'USD' END AS currency,
       CAST(user_id AS STRING) AS patient_id,
       CAST(user_id % 20 AS STRING) AS provider_id,
       CAST(user_id % 7 AS STRING) AS department_id,
       props AS payload,
       ts AS ingested_at
FROM events
""",
    "fx_raw_events": """
SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS id,
       'F' || CAST(user_id % 5 AS STRING) AS facility_id, event_type AS type,
       CAST(value AS DECIMAL(38,2)) AS amount, ts AS event_time, ts AS ingested_at FROM events
UNION ALL
SELECT CAST(event_id AS STRING), 'F' || CAST(user_id % 5 AS STRING), event_type,
       CAST(value AS DECIMAL(38,2)) + 1, ts, ts + INTERVAL 1 DAY FROM events WHERE event_id % 4 = 0
""",
    "fx_encounters": """
SELECT CAST(o_orderkey AS STRING) AS encounter_id, CAST(o_custkey AS STRING) AS patient_id,
       CAST(o_orderkey % 37 AS STRING) AS provider_id, CAST(o_orderkey % 7 AS STRING) AS department_id,
       'F' || CAST(o_custkey % 5 AS STRING) AS facility_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN 'inpatient'
            WHEN '3-MEDIUM' THEN 'outpatient' ELSE 'scheduled' END AS encounter_type,
       o_orderdate AS admit_ts,
       CASE o_orderkey % 4 WHEN 0 THEN o_orderdate + INTERVAL 5 HOUR WHEN 1 THEN o_orderdate + INTERVAL 30 HOUR
            WHEN 2 THEN o_orderdate + INTERVAL 12 DAY ELSE NULL END AS discharge_ts,
       CASE o_orderkey % 6 WHEN 0 THEN 'home' WHEN 1 THEN 'home' WHEN 2 THEN 'rehab' WHEN 3 THEN 'expired'
            WHEN 4 THEN 'skilled_nursing' ELSE 'other' END AS discharge_disposition,
       CAST(o_totalprice AS DECIMAL(38,2)) AS total_charges,
       CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'denied' END AS payment_status
FROM orders
""",
    "fx_diagnoses": """
SELECT CAST(l_orderkey AS STRING) AS encounter_id, 'D' || CAST(l_partkey % 50 AS STRING) AS diagnosis_code,
       CASE WHEN l_returnflag = 'R' THEN 'chronic' ELSE 'acute' END AS diagnosis_type,
       l_linestatus = 'F' AS present_on_admission
FROM lineitem
""",
    "fx_procedures": """
SELECT CAST(l_orderkey AS STRING) AS encounter_id, 'PR' || CAST(l_suppkey % 20 AS STRING) AS procedure_code,
       CAST(l_shipdate AS DATE) AS procedure_date
FROM lineitem
""",
    "fx_stock_movements": """
SELECT CAST(l_partkey AS STRING) AS product_id, p_name AS product_name, p_type AS product_category,
       'F' || CAST(l_suppkey % 5 AS STRING) AS facility_id,
       CASE WHEN l_returnflag = 'R' THEN 'return' WHEN l_returnflag = 'A' THEN 'issue'
            WHEN l_linestatus = 'F' THEN 'adjustment' ELSE 'receipt' END AS movement_type,
       CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS total_cost, CAST(l_shipdate AS DATE) AS movement_date
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
    "fx_patients": """
SELECT CAST(c_custkey AS STRING) AS patient_id, c_mktsegment AS first_name,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS last_name,
       DATE '1930-01-01' + CAST((c_custkey * 37) % 34000 AS INT) AS date_of_birth,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, n_name AS city,
       DATE '2024-01-01' + CAST(c_custkey % 60 AS INT) AS created_date
FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
    "fx_sheet": """
SELECT CAST(o_orderkey AS STRING) AS claim_id,
       CASE o_orderkey % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '45F' WHEN 4 THEN '12d'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS total_bill,
       CASE o_orderkey % 9 WHEN 0 THEN 'unknown' WHEN 1 THEN m || '/' || d || '/' || y WHEN 2 THEN iso || 'T03:04:05'
            WHEN 3 THEN replace(iso, '-', '') WHEN 4 THEN iso || ' 03:04:05.123' WHEN 5 THEN y || '-' || m || '-' || d
            WHEN 6 THEN substr(iso, 9, 2) || '-' || substr(month_name, 1, 3) || '-' || y WHEN 7 THEN month_name || ' ' || d || ', ' || y
            ELSE iso END AS adm_date,
       CASE WHEN o_orderkey % 3 = 0 THEN '1980-02-03' WHEN o_orderkey % 7 = 0 THEN '45F' ELSE CAST(o_orderkey % 90 AS STRING) END AS age_or_dob,
       CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS adm_day
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS iso, CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) AS y,
             CAST(EXTRACT(MONTH FROM o_orderdate) AS STRING) AS m, CAST(EXTRACT(DAY FROM o_orderdate) AS STRING) AS d,
             CASE EXTRACT(MONTH FROM o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April'
                  WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September'
                  WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END AS month_name
      FROM orders)
""",
    "fx_products": """
SELECT p_name || ' ' || CAST(p_partkey AS STRING) AS product_name,
       'KES ' || CAST(CAST(p_retailprice + 0 AS DECIMAL(18,2)) AS STRING) || ' each' AS price_text,
       CASE WHEN p_partkey % 3 = 0 THEN 'KES 2,500.50' END AS original_text,
       'https://maps.example.org/place/Shop+No%20' || CAST(p_partkey AS STRING) || '/x' AS url,
       1 AS scrape_no, TIMESTAMP_NTZ '2024-01-01 08:00:00' AS scrape_date FROM part
UNION ALL
SELECT p_name || ' ' || CAST(p_partkey AS STRING) AS product_name,
       'KES ' || CAST(CAST(p_retailprice + 1 AS DECIMAL(18,2)) AS STRING) || ' each' AS price_text,
       CASE WHEN p_partkey % 3 = 0 THEN 'KES 2,500.50' END AS original_text,
       'https://maps.example.org/place/Shop+No%20' || CAST(p_partkey AS STRING) || '/x' AS url,
       2 AS scrape_no, TIMESTAMP_NTZ '2024-01-01 18:00:00' AS scrape_date FROM part
UNION ALL
SELECT p_name || ' ' || CAST(p_partkey AS STRING) AS product_name,
       'KES ' || CAST(CAST(p_retailprice + 2 AS DECIMAL(18,2)) AS STRING) || ' each' AS price_text,
       CASE WHEN p_partkey % 3 = 0 THEN 'KES 2,500.50' END AS original_text,
       'https://maps.example.org/place/Shop+No%20' || CAST(p_partkey AS STRING) || '/x' AS url,
       3 AS scrape_no, TIMESTAMP_NTZ '2024-01-02 08:00:00' AS scrape_date FROM part
""",
    "fx_pois": """
SELECT CAST(c_custkey AS STRING) AS poi_id, (c_custkey * 7919) % 10000 AS x, (c_custkey * 104729) % 10000 AS y,
       CASE c_custkey % 8 WHEN 0 THEN 'City Gym' WHEN 1 THEN 'Hair SALON' WHEN 2 THEN 'Barber shop'
            WHEN 3 THEN 'Wines and spirits' WHEN 4 THEN 'Chemist' WHEN 5 THEN 'Dawa clinic'
            WHEN 6 THEN 'Restaurant' ELSE 'Bookstore' END AS name
FROM customer
""",
    "fx_branches": """
SELECT n_name AS branch, (n_nationkey * 1237) % 10000 AS x, (n_nationkey * 3571) % 10000 AS y,
       20000 + 1000 * n_nationkey AS base_pop
FROM nation
""",
    # identity columns with every kind of gap
    "fx_ids": """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN '' ELSE CAST(event_id AS STRING) END AS id,
       CASE WHEN event_id % 4 = 0 THEN 'u-' || CAST(event_id AS STRING) END AS uuid
FROM events
""",
    # stored rows and a delivery with changed, new and id-less rows
    "fx_target": """
SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS id,
       'F' || CAST(user_id % 5 AS STRING) AS facility_id, event_type AS type,
       CAST(value AS DECIMAL(38,2)) AS amount, ts AS ingested_at
FROM events WHERE event_id % 5 <> 1
""",
    "fx_delivery": """
SELECT CASE WHEN event_id % 100 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS id,
       'F' || CAST(user_id % 5 AS STRING) AS facility_id, 'again' AS type,
       CAST(value AS DECIMAL(38,2)) + 1 AS amount,
       CASE WHEN event_id % 8 = 0 THEN ts - INTERVAL 1 DAY ELSE ts + INTERVAL 1 DAY END AS ingested_at
FROM events WHERE event_id % 4 = 0 OR event_id % 5 = 1
""",
    "fx_dictionary": """
SELECT p_partkey AS row_no,
       CASE WHEN p_partkey % 13 = 0 THEN ' ' ELSE p_type END AS module,
       CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 2 = 0
            THEN lower(p_type) || '_' || replace(p_name, ' ', '_') ELSE p_name END AS "table"
FROM part
""",
    "fx_facts": """
SELECT encounter_id, patient_id, facility_id, CAST(admit_ts AS DATE) AS admit_date,
       CAST(discharge_ts AS DATE) AS discharge_date
FROM fx_encounters
""",
    "fx_loads": """
SELECT facility_id, ingested_at AS _loaded_at, 'module' || department_id AS module_source,
       event_type AS source_table, payload AS row_hash,
       CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' WHEN event_time IS NULL THEN 'INVALID_TIMESTAMP'
            ELSE 'VALID' END AS validation_status
FROM fx_clean_events
""",
    "fx_billing": """
SELECT patient_id, total_charges AS amount, payment_status FROM fx_encounters
""",
}

# The same labels as plans.clean.label_events, for the DuckDB side only.
ORACLE_VIEWS = {
    "ox_labelled": """
SELECT event_id, facility_id, event_time, event_date, event_type, amount, COALESCE(currency, 'KES') AS currency,
       patient_id, provider_id, department_id, ingested_at,
       CASE WHEN event_type LIKE '%payment%' THEN 'FINANCIAL' WHEN event_type LIKE '%clinical%' THEN 'CLINICAL'
            WHEN event_type LIKE '%admin%' THEN 'ADMINISTRATIVE' ELSE 'OTHER' END AS event_category,
       CASE WHEN amount IS NULL THEN 'MISSING_AMOUNT' WHEN event_time IS NULL THEN 'INVALID_TIMESTAMP'
            ELSE 'VALID' END AS validation_status
FROM fx_clean_events
""",
    "ox_daily": """
SELECT CAST(event_time AS DATE) AS revenue_date, facility_id, event_type, currency, COUNT(*) AS transaction_count,
       CAST(SUM(amount) AS DECIMAL(38,2)) AS gross_revenue,
       CAST(SUM(CASE WHEN validation_status = 'VALID' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS valid_revenue,
       CAST(SUM(CASE WHEN validation_status = 'MISSING_AMOUNT' THEN 1 ELSE 0 END) AS BIGINT) AS missing_amount_count,
       CAST(SUM(CASE WHEN validation_status = 'INVALID_TIMESTAMP' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_timestamp_count
FROM ox_labelled WHERE event_category = 'FINANCIAL' GROUP BY 1, 2, 3, 4
""",
    "ox_weekly": """
SELECT CAST(date_trunc('week', revenue_date) AS DATE) AS week_start, facility_id,
       CAST(SUM(gross_revenue) AS DOUBLE) / COUNT(gross_revenue) AS avg_daily_revenue,
       CAST(SUM(gross_revenue) AS DECIMAL(38,2)) AS weekly_revenue, COUNT(DISTINCT revenue_date) AS active_days,
       CAST(SUM(transaction_count) AS BIGINT) AS weekly_transactions,
       CAST(SUM(valid_revenue) AS DOUBLE) / NULLIF(CAST(SUM(gross_revenue) AS DOUBLE), 0) * 100 AS revenue_quality_pct
FROM ox_daily GROUP BY 1, 2
""",
    "ox_monthly": """
SELECT *, CAST(monthly_revenue - prev_month_revenue AS DOUBLE) / NULLIF(CAST(prev_month_revenue AS DOUBLE), 0) * 100 AS mom_growth_pct
FROM (SELECT *, LAG(monthly_revenue) OVER (PARTITION BY facility_id ORDER BY month_start NULLS LAST) AS prev_month_revenue
      FROM (SELECT CAST(date_trunc('month', revenue_date) AS DATE) AS month_start, facility_id,
                   CAST(SUM(gross_revenue) AS DECIMAL(38,2)) AS monthly_revenue,
                   CAST(SUM(valid_revenue) AS DECIMAL(38,2)) AS monthly_valid_revenue,
                   CAST(SUM(transaction_count) AS BIGINT) AS monthly_transactions
            FROM ox_daily GROUP BY 1, 2))
""",
    "ox_inventory": """
SELECT movement_date, facility_id, product_id, product_name, product_category,
       CAST(SUM(CASE WHEN movement_type = 'receipt' THEN quantity ELSE 0 END) AS DECIMAL(38,2)) AS receipts,
       CAST(SUM(CASE WHEN movement_type = 'issue' THEN quantity ELSE 0 END) AS DECIMAL(38,2)) AS issues,
       CAST(SUM(CASE WHEN movement_type = 'adjustment' THEN quantity ELSE 0 END) AS DECIMAL(38,2)) AS adjustments,
       CAST(SUM(CASE WHEN movement_type = 'return' THEN quantity ELSE 0 END) AS DECIMAL(38,2)) AS "returns",
       CAST(SUM(CASE WHEN movement_type = 'receipt' THEN total_cost ELSE 0 END) AS DECIMAL(38,2)) AS receipt_cost,
       CAST(SUM(CASE WHEN movement_type = 'issue' THEN total_cost ELSE 0 END) AS DECIMAL(38,2)) AS issue_cost,
       CAST(SUM(CASE WHEN movement_type IN ('receipt', 'return') THEN quantity
                     WHEN movement_type IN ('issue', 'adjustment') THEN -quantity ELSE 0 END) AS DECIMAL(38,2)) AS net_change,
       CAST(SUM(unit_cost) AS DOUBLE) / COUNT(unit_cost) AS unit_cost
FROM fx_stock_movements GROUP BY 1, 2, 3, 4, 5
""",
    "ox_position": """
SELECT *,
       CAST(SUM(net_change) OVER (PARTITION BY facility_id, product_id ORDER BY movement_date NULLS LAST
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS current_stock,
       AVG(unit_cost) OVER (PARTITION BY product_id ORDER BY movement_date NULLS LAST, facility_id NULLS LAST, product_name NULLS LAST,
            product_category NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_cost,
       CAST(SUM(issue_cost) OVER (PARTITION BY facility_id, product_id ORDER BY movement_date NULLS LAST, product_name NULLS LAST,
            product_category NULLS LAST ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS monthly_usage_cost,
       CAST(SUM(issues) OVER (PARTITION BY facility_id, product_id ORDER BY movement_date NULLS LAST, product_name NULLS LAST,
            product_category NULLS LAST ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS monthly_usage_quantity,
       MAX(movement_date) OVER (PARTITION BY facility_id, product_id) AS last_movement_date
FROM ox_inventory
""",
    "ox_los": """
SELECT encounter_id, patient_id, provider_id, department_id, encounter_type, admit_ts AS admit_date,
       discharge_ts AS discharge_date, date_diff('hour', admit_ts, discharge_ts) AS length_of_stay_hours, discharge_disposition
FROM fx_encounters
""",
    "ox_encounter_metrics": """
SELECT e.*, COALESCE(d.diagnosis_count, 0) AS diagnosis_count, d.diagnosis_codes,
       COALESCE(p.procedure_count, 0) AS procedure_count, p.procedure_codes,
       CAST(COALESCE(d.poa_diagnosis_count, 0) AS BIGINT) AS poa_diagnosis_count
FROM ox_los e
LEFT JOIN (SELECT encounter_id, COUNT(DISTINCT diagnosis_code) AS diagnosis_count,
                  string_agg(DISTINCT diagnosis_code, ',' ORDER BY diagnosis_code) AS diagnosis_codes,
                  SUM(CASE WHEN present_on_admission THEN 1 ELSE 0 END) AS poa_diagnosis_count
           FROM fx_diagnoses GROUP BY 1) d ON e.encounter_id = d.encounter_id
LEFT JOIN (SELECT encounter_id, COUNT(DISTINCT procedure_code) AS procedure_count,
                  string_agg(DISTINCT procedure_code, ',' ORDER BY procedure_code) AS procedure_codes
           FROM fx_procedures GROUP BY 1) p ON e.encounter_id = p.encounter_id
""",
    "ox_timeline": """
SELECT event_id, patient_id, event_time, event_type, event_category, amount, provider_id, department_id,
       LEAD(event_time) OVER w AS next_event_time, LEAD(event_type) OVER w AS next_event_type,
       LAG(event_time) OVER w AS prev_event_time,
       CAST(SUM(amount) OVER (PARTITION BY patient_id ORDER BY event_time NULLS LAST, event_id
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / NULLIF(COUNT(amount) OVER (PARTITION BY patient_id ORDER BY event_time NULLS LAST, event_id
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS moving_avg_spend,
       CAST(SUM(amount) OVER (PARTITION BY patient_id ORDER BY event_time NULLS LAST, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS cumulative_spend,
       ROW_NUMBER() OVER (PARTITION BY patient_id, date_trunc('month', event_time) ORDER BY event_time NULLS LAST, event_id) AS event_number_in_month,
       FIRST_VALUE(event_time) OVER (PARTITION BY patient_id ORDER BY event_time NULLS LAST, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_interaction,
       LAST_VALUE(event_time) OVER (PARTITION BY patient_id ORDER BY event_time NULLS LAST, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_interaction,
       DENSE_RANK() OVER (ORDER BY patient_id NULLS LAST, event_time NULLS LAST) AS journey_step_id
FROM ox_labelled WINDOW w AS (PARTITION BY patient_id ORDER BY event_time NULLS LAST, event_id)
""",
    "ox_journey": """
SELECT *, date_diff('day', prev_event_time, event_time) AS days_since_last_event,
       CASE WHEN event_type = 'appointment' AND next_event_type = 'encounter' THEN 'COMPLETED'
            WHEN event_type = 'appointment' AND next_event_type IS NULL THEN 'PENDING'
            WHEN event_type = 'appointment' AND next_event_type <> 'encounter' THEN 'NO_SHOW' ELSE 'OTHER' END AS appointment_outcome
FROM ox_timeline
""",
    "ox_visits": """
SELECT patient_id, COUNT(DISTINCT encounter_id) AS total_encounters,
       CAST(SUM(CASE WHEN encounter_type = 'emergency' THEN 1 ELSE 0 END) AS BIGINT) AS emergency_visits,
       CAST(SUM(CASE WHEN encounter_type = 'inpatient' THEN 1 ELSE 0 END) AS BIGINT) AS admissions,
       CAST(SUM(date_diff('day', admit_ts, discharge_ts)) AS DOUBLE) / NULLIF(COUNT(discharge_ts), 0) AS avg_los,
       MAX(CAST(admit_ts AS DATE)) AS last_visit_date
FROM fx_encounters WHERE patient_id IS NOT NULL GROUP BY 1
""",
    "ox_codes": """
SELECT patient_id, COUNT(DISTINCT diagnosis_code) AS condition_count,
       string_agg(DISTINCT diagnosis_code, ', ' ORDER BY diagnosis_code) AS diagnoses,
       MAX(CASE WHEN diagnosis_type = 'chronic' THEN 1 ELSE 0 END) AS has_chronic_condition
FROM fx_diagnoses JOIN fx_encounters USING (encounter_id) GROUP BY 1
""",
    "ox_risk": """
SELECT patient_id, COALESCE(condition_count, 0) AS condition_count, COALESCE(has_chronic_condition, 0) AS has_chronic_condition,
       total_encounters AS encounter_count, emergency_visits, avg_los, total_charges, last_interaction,
       COALESCE(condition_count, 0) * CAST(0.3 AS DOUBLE) + COALESCE(has_chronic_condition, 0) * CAST(0.2 AS DOUBLE)
         + emergency_visits * CAST(0.2 AS DOUBLE) + (avg_los / 10) * CAST(0.15 AS DOUBLE)
         + (CAST(total_charges AS DOUBLE) / 10000) * CAST(0.15 AS DOUBLE) AS acuity_score
FROM ox_visits LEFT JOIN ox_codes USING (patient_id)
LEFT JOIN (SELECT patient_id, CAST(SUM(amount) AS DECIMAL(38,2)) AS total_charges, MAX(event_time) AS last_interaction
           FROM ox_labelled GROUP BY 1) USING (patient_id)
""",
    "ox_price": """
SELECT product_name, url, scrape_no, scrape_date,
       CAST(replace(regexp_extract(price_text, '[\\d,]+\\.?\\d*'), ',', '') AS DOUBLE) AS current_price,
       CASE WHEN original_text IS NOT NULL THEN CAST(2500.5 AS DOUBLE) END AS original_price
FROM fx_products
""",
    "ox_metrics": """
SELECT CAST(event_time AS DATE) AS metric_date, facility_id, COUNT(DISTINCT event_id) AS total_encounters,
       COUNT(DISTINCT patient_id) AS unique_patients,
       CAST(((2 * CAST(SUM(amount) * 100 AS HUGEINT) + COUNT(amount)) // (2 * COUNT(amount))) / 100.0 AS DECIMAL(38,2)) AS avg_revenue_per_encounter
FROM ox_labelled WHERE event_time IS NOT NULL GROUP BY 1, 2
""",
}

_NAME = re.compile(r"\b(?:fx|ox)_\w+")
_TABLE = re.compile(r"\b(" + "|".join(TABLES) + r")\b")


class Inputs:
    """The test tables of a folder and what is derived from them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        sql = FIXTURES[name]
        for used in sorted(set(_NAME.findall(sql))):
            self(used).createOrReplaceTempView(used)
        for table in sorted(set(_TABLE.findall(sql)) & set(TABLES)):
            self(table).createOrReplaceTempView(table)
        return self.spark.sql(sql.replace('"', "`"))


def oracle(sql: str) -> str:
    """The DuckDB statement with the derived inputs it names put in front."""
    views = {**FIXTURES, **ORACLE_VIEWS}
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in _NAME.findall(text):
            if name in views and name not in needed:
                add(views[name])
                needed[name] = views[name].strip()

    add(sql)
    body = sql.strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({text})" for n, text in needed.items()).replace("TIMESTAMP_NTZ '", "TIMESTAMP '")
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
