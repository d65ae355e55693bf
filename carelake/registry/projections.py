"""Projections, predicates, derived columns and joins."""

from pyspark.sql import functions as F

from ..fixtures import AS_OF
from ..functions.clinical import (
    appointment_outcome, days_of_supply, discharge_category, event_category, patient_age_group,
    recency_status, report_age_band, stock_status, validation_status,
)
from ..functions.dates import as_of_column, hour_diff, week_start, year_diff
from ..functions.geo import strategy
from ..functions.text import model_namespace, safe_filename, safe_token
from ..operators.dedup import has_id
from ..operators.dictionary import dictionary_models
from ..operators.sheet import coerce_date, coerce_mixed, coerce_numeric, decimals_to_double, normalize_headers
from ..operators.spatial import join_radius as radius_pairs
from ..operators.variant import source_slice, variant_project, with_ingest_meta
from ..plans.clean import label_events
from ..plans.inventory import daily_inventory
from ..plans.mart import next_in_group
from ..plans.revenue import daily_revenue, weekly_revenue
from . import query


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS nested,
       CAST(NULL AS VARCHAR) AS absent FROM events
""")
def prj_variant_path(t):
    body = F.concat(
        F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","a":{"b":"'), "event_type",
        F.lit('"},"props":'), "props", F.lit("}"),
    )
    spec = {
        "event_id": ("id", "string"), "k": ("props.k", "bigint"),
        "nested": ("a.b", "string"), "absent": ("a.c", "string"),
    }
    return variant_project(t("events").select(F.parse_json(body).alias("payload")), spec)


@query("SELECT event_id, event_type, event_category FROM ox_labelled")
def prj_event_category(t):
    return t("fx_clean_events").select("event_id", "event_type", event_category("event_type").alias("event_category"))


@query("SELECT event_id, validation_status FROM ox_labelled")
def prj_validation(t):
    return t("fx_clean_events").select("event_id", validation_status("amount", "event_time").alias("validation_status"))


@query("""
SELECT i.event_id, COALESCE(i.id, i.uuid) AS id, COALESCE(c.currency, 'KES') AS currency
FROM fx_ids i JOIN fx_clean_events c ON CAST(i.event_id AS VARCHAR) = c.event_id
""")
def prj_default(t):
    ids = t("fx_ids").select("event_id", F.coalesce("id", "uuid").alias("id"))
    clean = t("fx_clean_events").select(F.col("event_id").alias("_e"), F.coalesce("currency", F.lit("KES")).alias("currency"))
    return ids.join(clean, ids.event_id.cast("string") == clean._e).drop("_e")


@query("""
SELECT 'either' AS mode, event_id, id, uuid FROM fx_ids WHERE id IS NOT NULL OR uuid IS NOT NULL
UNION ALL SELECT 'non_blank', event_id, id, uuid FROM fx_ids WHERE NULLIF(TRIM(id), '') IS NOT NULL
""")
def prj_id_filter(t):
    ids = t("fx_ids")
    parts = [has_id(ids, m).select(F.lit(m).alias("mode"), "event_id", "id", "uuid") for m in ("either", "non_blank")]
    return parts[0].unionByName(parts[1])


@query("SELECT event_id, event_type AS source_table FROM events WHERE event_type IN ('view', 'signup')")
def prj_split_source(t):
    raw = t("events").select("event_id", F.col("event_type").alias("source_table"))
    return source_slice(raw, "view", "signup")


@query(f"""
SELECT 'between' AS kind, event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'
UNION ALL SELECT 'last_24h', event_id FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
UNION ALL SELECT 'last_day', event_id FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY
UNION ALL SELECT 'month', event_id FROM events WHERE date_trunc('month', ts) = DATE '2024-01-01'
""")
def prj_time_range(t):
    now, ts, events = as_of_column(AS_OF), F.col("ts"), t("events")
    first, last = as_of_column("2024-01-10 00:00:00"), as_of_column("2024-01-12 12:00:00")
    month = F.lit("2024-01-01").cast("date")
    kinds = {
        "between": ts.between(first, last),
        "last_24h": ts >= now - F.expr("INTERVAL 24 HOURS"),
        "last_day": ts >= now - F.expr("INTERVAL 1 DAY"),
        # A range keeps the filter pushable where month(ts) = … would not be.
        "month": (ts >= month) & (ts < F.add_months(month, 1)),
    }
    parts = [events.filter(c).select(F.lit(k).alias("kind"), "event_id") for k, c in kinds.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("""
SELECT patient_id, age, CASE WHEN age < 18 THEN 'PEDIATRIC' WHEN age BETWEEN 18 AND 65 THEN 'ADULT' ELSE 'GERIATRIC' END AS age_group
FROM (SELECT patient_id, 2024 - year(dob) AS age FROM (
  SELECT patient_id, CASE WHEN CAST(patient_id AS BIGINT) % 13 = 0 THEN NULL ELSE date_of_birth END AS dob FROM fx_patients))
""")
def prj_age_group(t):
    dob = F.when(F.col("patient_id").cast("bigint") % 13 != 0, F.col("date_of_birth"))
    return t("fx_patients").select(
        "patient_id", year_diff(dob, as_of_column(AS_OF)).alias("age"), patient_age_group(dob, AS_OF).alias("age_group")
    )


@query("""
SELECT patient_id, CASE WHEN age < 18 THEN 'Pediatric' WHEN age BETWEEN 18 AND 40 THEN 'Young Adult'
  WHEN age BETWEEN 41 AND 65 THEN 'Middle Age' ELSE 'Geriatric' END AS age_group
FROM (SELECT patient_id, 2024 - year(date_of_birth) AS age FROM fx_patients)
""")
def prj_age_band_report(t):
    return t("fx_patients").select(
        "patient_id", report_age_band(year_diff("date_of_birth", as_of_column(AS_OF))).alias("age_group")
    )


@query("""
SELECT encounter_id, CASE WHEN discharge_disposition IN ('expired', 'hospice') THEN 'MORTALITY'
  WHEN discharge_disposition = 'home' AND length_of_stay_hours < 24 THEN 'SHORT_STAY'
  WHEN discharge_disposition = 'home' AND length_of_stay_hours >= 24 THEN 'HOME_DISCHARGE'
  WHEN discharge_disposition IN ('skilled_nursing', 'rehab') THEN 'POST_ACUTE' ELSE 'OTHER' END AS discharge_category
FROM ox_los
""")
def prj_discharge_cat(t):
    los = hour_diff("admit_ts", "discharge_ts")
    return t("fx_encounters").select(
        "encounter_id", discharge_category("discharge_disposition", los).alias("discharge_category")
    )


@query("SELECT event_id, appointment_outcome FROM ox_journey")
def prj_appt_outcome(t):
    events = t("fx_clean_events").select("event_id", "patient_id", "event_time", "event_type")
    rows = next_in_group(events, "patient_id", ["event_time", "event_id"], {"next_type": "event_type"})
    return rows.select("event_id", appointment_outcome("event_type", "next_type").alias("appointment_outcome"))


@query("""
SELECT patient_id, CASE WHEN seen >= DATE '2001-03-31' - INTERVAL 3 MONTH THEN 'ACTIVE'
  WHEN seen >= DATE '2001-03-31' - INTERVAL 12 MONTH THEN 'INACTIVE' ELSE 'LAPSED' END AS patient_status
FROM (SELECT patient_id, MAX(CAST(admit_ts AS DATE)) AS seen FROM fx_encounters GROUP BY 1)
""")
def prj_recency_status(t):
    seen = t("fx_encounters").groupBy("patient_id").agg(F.max(F.col("admit_ts").cast("date")).alias("seen"))
    return seen.select("patient_id", recency_status("seen", "2001-03-31 00:00:00").alias("patient_status"))


@query("""
SELECT movement_date, facility_id, product_id, CASE WHEN net_change <= 0 THEN 'OUT_OF_STOCK'
  WHEN net_change < issues * 0.5 THEN 'LOW_STOCK' WHEN net_change < issues * 1.5 THEN 'ADEQUATE' ELSE 'OVERSTOCKED' END AS stock_status,
  CAST(net_change AS DOUBLE) / NULLIF(CAST(issues AS DOUBLE) / 30, 0) AS days_of_supply,
  CAST(net_change AS DOUBLE) * unit_cost AS inventory_value
FROM ox_inventory
""")
def prj_stock_status(t):
    stock, usage = F.col("net_change"), F.col("issues")
    return daily_inventory(t("fx_stock_movements")).select(
        "movement_date", "facility_id", "product_id",
        stock_status(stock, usage).alias("stock_status"),
        days_of_supply(stock, usage).alias("days_of_supply"),
        (stock.cast("double") * F.col("unit_cost")).alias("inventory_value"),
    )


@query("""
SELECT event_id, (CASE WHEN event_id % 7 > 3 THEN 'URGENT: Price-match competitors. Channel shift to WhatsApp Delivery.'
   ELSE 'STABLE: Maintain margins. Focus on loyalty.' END) || ' | ' ||
  (CASE WHEN event_id % 20 > 10 THEN 'UPSELL: Target Gyms/Salons. Grow Beauty (20% -> 25%) & Body Building (3% -> 8%).'
   WHEN event_id % 90 > 50 THEN 'NIGHT ECONOMY: High impulse-buy potential. Stock Sexual Health & Recovery.'
   ELSE 'CORE: Protect Chronic care. Stock for regular patient refills.' END) AS strategy FROM events
""")
def prj_strategy(t):
    e = F.col("event_id")
    return t("events").select("event_id", strategy(e % 7, e % 20, e % 90).alias("strategy"))


@query("SELECT r_regionkey AS region_key, r_name AS region_name FROM region")
def prj_headers(t):
    return normalize_headers(t("region").toDF(" Region KEY ", "Region Name"))


@query("SELECT claim_id, COALESCE(TRY_CAST(NULLIF(total_bill, '') AS DOUBLE), 0) AS total_bill FROM fx_sheet")
def prj_coerce_numeric(t):
    return coerce_numeric(t("fx_sheet").select("claim_id", "total_bill"))


@query("SELECT claim_id, strftime(adm_day, '%Y-%m-%d') AS adm_date FROM fx_sheet")
def prj_coerce_date(t):
    return coerce_date(t("fx_sheet").select("claim_id", "adm_date"))


@query("SELECT claim_id, COALESCE(CAST(TRY_CAST(age_or_dob AS DOUBLE) AS VARCHAR), age_or_dob) AS age_or_dob FROM fx_sheet")
def prj_coerce_mixed(t):
    return coerce_mixed(t("fx_sheet").select("claim_id", "age_or_dob"))


@query("SELECT encounter_id, CAST(total_charges AS DOUBLE) AS total_charges FROM fx_encounters")
def prj_decimal_to_double(t):
    return decimals_to_double(t("fx_encounters").select("encounter_id", "total_charges"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, 'run-1' AS run_id, ts AS ingested_at, 'F' || CAST(user_id % 5 AS VARCHAR) AS facility,
       'core' AS module, event_type AS "table", 'Ignite\\Core\\Entities\\' || upper(event_type[1]) || event_type[2:] AS namespace,
       md5('{"id":"' || event_id || '","type":"' || event_type || '"}') AS row_hash
FROM events
""")
def prj_enrich_meta(t):
    body = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("event_id").cast("string").alias("id")))
    rows = t("events").withColumn("payload", F.parse_json(body))
    stamped = with_ingest_meta(
        rows, "run-1", F.col("ts"), F.concat(F.lit("F"), (F.col("user_id") % 5).cast("string")),
        F.lit("core"), F.col("event_type"), model_namespace(F.lit("core"), "event_type"),
    )
    return stamped.select(F.try_variant_get("payload", "$.id", "string").alias("id"), "_airflow_meta.*")


_PASCAL = "list_aggregate(list_transform(list_filter(regexp_split_to_array({0}, '[_\\s]+'), lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"
_NAMESPACE = f"""'Ignite\\' || {_PASCAL.format('module')} || '\\Entities\\' || {_PASCAL.format(
    'CASE WHEN starts_with("table", lower(module) || chr(95)) THEN "table"[length(module) + 2:] ELSE "table" END')}"""


@query(f"""
SELECT row_no, {_NAMESPACE} AS namespace FROM fx_dictionary WHERE TRIM(module) <> '' AND TRIM("table") <> ''
""")
def prj_namespace(t):
    rows = t("fx_dictionary").filter((F.trim("module") != "") & (F.trim("table") != ""))
    return rows.select("row_no", model_namespace("module", "table").alias("namespace"))


@query(f"""
SELECT row_no, module, "table", {_NAMESPACE} AS namespace FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lower(module), lower("table") ORDER BY row_no) AS rn FROM (
    SELECT row_no, TRIM(module) AS module, TRIM("table") AS "table" FROM fx_dictionary)
  WHERE module <> '' AND "table" <> '') WHERE rn = 1
""")
def prj_dictionary_models(t):
    return dictionary_models(t("fx_dictionary"), "row_no")


@query("""
SELECT page_id, regexp_replace(TRIM(url), '[^a-zA-Z0-9_\\-=.+]+', '_', 'g') AS token, translate(url, '/\\', '__') AS filename FROM pages
""")
def prj_safe_token(t):
    return t("pages").select("page_id", safe_token("url").alias("token"), safe_filename("url").alias("filename"))


# ---- joins

@query("""
SELECT e.encounter_id, e.patient_id, d.diagnosis_code FROM fx_encounters e LEFT JOIN fx_diagnoses d ON e.encounter_id = d.encounter_id
""")
def join_left_equi(t):
    encounters = t("fx_encounters").select("encounter_id", "patient_id")
    return encounters.join(t("fx_diagnoses").select("encounter_id", "diagnosis_code"), "encounter_id", "left")


@query("""
SELECT d.revenue_date, d.facility_id, d.event_type, d.currency, d.gross_revenue, w.weekly_revenue, w.active_days, w.weekly_transactions
FROM ox_daily d LEFT JOIN ox_weekly w ON date_trunc('week', d.revenue_date) = w.week_start AND d.facility_id = w.facility_id
""")
def join_left_multi(t):
    daily = daily_revenue(label_events(t("fx_clean_events")))
    weekly = weekly_revenue(daily).select(
        F.col("facility_id").alias("_f"), "week_start", "weekly_revenue", "active_days", "weekly_transactions"
    )
    on = (week_start("revenue_date") == F.col("week_start")) & (F.col("facility_id") == F.col("_f"))
    return daily.join(weekly, on, "left").select(
        "revenue_date", "facility_id", "event_type", "currency", "gross_revenue",
        "weekly_revenue", "active_days", "weekly_transactions",
    )


def _raw(t):
    """One RAW table with patients and encounters as payloads."""
    patients = t("fx_patients").select(
        F.lit("patients").alias("source_table"), F.to_json(F.struct("patient_id", "last_name")).alias("line")
    )
    encounters = t("fx_encounters").select(
        F.lit("encounters").alias("source_table"),
        F.to_json(F.struct("patient_id", "encounter_id", "encounter_type")).alias("line"),
    )
    return patients.unionByName(encounters).select("source_table", F.parse_json("line").alias("payload"))


@query("""
SELECT p.patient_id, p.last_name, e.encounter_id FROM fx_patients p
LEFT JOIN fx_encounters e ON e.patient_id = p.patient_id AND e.encounter_type = 'emergency'
""")
def join_self_slices(t):
    raw = _raw(t)
    patients = variant_project(
        source_slice(raw, "patients"), {"patient_id": ("patient_id", "string"), "last_name": ("last_name", "string")}
    )
    spec = {"_p": ("patient_id", "string"), "encounter_id": ("encounter_id", "string"), "_type": ("encounter_type", "string")}
    encounters = variant_project(source_slice(raw, "encounters"), spec)
    on = (F.col("_p") == F.col("patient_id")) & (F.col("_type") == "emergency")
    return patients.join(encounters, on, "left").select("patient_id", "last_name", "encounter_id")


@query("""
SELECT p.patient_id, f.n_events, f.total FROM fx_patients p
LEFT JOIN (SELECT patient_id, COUNT(*) AS n_events, CAST(SUM(amount) AS DECIMAL(38,2)) AS total FROM fx_clean_events GROUP BY 1) f
  ON f.patient_id = p.patient_id
""")
def join_raw_clean(t):
    key = F.try_variant_get("payload", "$.patient_id", "string")
    patients = source_slice(_raw(t), "patients").select(key.alias("patient_id"))
    billed = t("fx_clean_events").groupBy("patient_id").agg(
        F.count("*").alias("n_events"), F.sum("amount").cast("decimal(38,2)").alias("total")
    )
    return patients.join(billed, "patient_id", "left")


@query("""
SELECT b.branch, p.poi_id, sqrt(CAST((p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) AS DOUBLE)) AS distance,
       (p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) <= 90000 AS within_300
FROM fx_branches b JOIN fx_pois p ON (p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) <= 1000000
""")
def join_radius(t):
    branches = t("fx_branches").select("branch", "x", "y")
    pairs = radius_pairs(branches, t("fx_pois").select("poi_id", "x", "y"), 1000.0)
    return pairs.select("branch", "poi_id", "distance", (F.col("distance") <= 300).alias("within_300"))


@query("""
SELECT o_orderkey AS map_index, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS found FROM orders
""")
def join_index_semi(t):
    wanted = t("orders").select(F.col("o_orderkey").alias("map_index"))
    # Each index once, reduced in the tasks that read it: what is shuffled and sorted is indices, not log lines.
    logs = t("lineitem").select(F.col("l_orderkey").alias("map_index")).distinct().withColumn("found", F.lit(True))
    return wanted.join(logs, "map_index", "left").select("map_index", F.coalesce("found", F.lit(False)).alias("found"))
