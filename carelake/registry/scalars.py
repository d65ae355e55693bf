"""Scalar functions and the SQL functions."""

from pyspark.sql import functions as F

from ..fixtures import AS_OF
from ..functions import dates as d
from ..functions.clinical import register_sql_functions
from ..functions.geo import projected_population, utm37s
from ..functions.nulls import blank_to_null, safe_div, strict_greatest, strict_least
from ..functions.prices import discount_pct, price_digits, price_first, price_kes, price_swap
from ..functions.text import file_stem, phone_suffix, place_name
from ..operators.variant import row_hash
from . import query


@query("""
SELECT encounter_id, year(discharge_ts) - year(admit_ts) AS years, date_diff('day', admit_ts, discharge_ts) AS days,
       date_diff('hour', admit_ts + INTERVAL 59 MINUTE, discharge_ts) AS hours,
       date_diff('minute', admit_ts + INTERVAL 59 SECOND, discharge_ts) AS minutes FROM fx_encounters
""")
def fn_datediff(t):
    late_hour, late_minute = F.col("admit_ts") + F.expr("INTERVAL 59 MINUTES"), F.col("admit_ts") + F.expr("INTERVAL 59 SECONDS")
    return t("fx_encounters").select(
        "encounter_id",
        d.year_diff("admit_ts", "discharge_ts").alias("years"),
        d.day_diff("admit_ts", "discharge_ts").alias("days"),
        d.hour_diff(late_hour, "discharge_ts").alias("hours"),
        d.minute_diff(late_minute, "discharge_ts").alias("minutes"),
    )


@query("""
SELECT encounter_id, CAST(admit_ts AS DATE) + 30 AS plus_days, CAST(CAST(admit_ts AS DATE) - INTERVAL 3 MONTH AS DATE) AS minus_months,
       admit_ts - INTERVAL 24 HOUR AS minus_hours FROM fx_encounters
""")
def fn_dateadd(t):
    return t("fx_encounters").select(
        "encounter_id",
        d.add_days("admit_ts", 30).alias("plus_days"),
        d.add_months("admit_ts", -3).alias("minus_months"),
        d.add_hours("admit_ts", -24).alias("minus_hours"),
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week,
       CAST(date_trunc('month', ts) AS DATE) AS month, date_trunc('hour', ts) AS hour FROM events
""")
def fn_date_trunc(t):
    return t("events").select(
        "event_id", d.day("ts").alias("day"), d.week_start("ts").alias("week"),
        d.month_start("ts").alias("month"), d.hour_start("ts").alias("hour"),
    )


@query("SELECT patient_id, first_name || ' ' || last_name AS full_name FROM fx_patients")
def fn_concat_null(t):
    return t("fx_patients").select("patient_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"))


@query("SELECT event_id, CAST(event_id AS DOUBLE) / NULLIF(user_id % 7, 0) AS ratio FROM events")
def fn_null_safe_div(t):
    return t("events").select("event_id", safe_div(F.col("event_id").cast("double"), F.col("user_id") % 7).alias("ratio"))


@query("""
SELECT event_id, CASE WHEN amount IS NOT NULL THEN least(CAST(100 AS DECIMAL(38,2)), greatest(CAST(20 AS DECIMAL(38,2)), amount)) END AS clamped
FROM fx_clean_events
""")
def fn_greatest_least(t):
    low, high = (F.lit(v).cast("decimal(38,2)") for v in (20, 100))
    return t("fx_clean_events").select("event_id", strict_least(high, strict_greatest(low, "amount")).alias("clamped"))


@query("""
SELECT patient_id, CASE WHEN gender = 'M' THEN 5 ELSE 3 END AS points, power(CAST(patient_id AS DOUBLE) / 100, 2) AS squared FROM fx_patients
""")
def fn_iff_power(t):
    return t("fx_patients").select(
        "patient_id",
        F.when(F.col("gender") == "M", 5).otherwise(3).alias("points"),
        F.pow(F.col("patient_id").cast("double") / 100, F.lit(2)).alias("squared"),
    )


@query("SELECT event_id, NULLIF(TRIM(id), '') AS id FROM fx_ids")
def fn_trim_nullif(t):
    return t("fx_ids").select("event_id", blank_to_null("id").alias("id"))


@query("""
SELECT event_id, md5('{"a":{"x":"' || event_type || '","y":"1"},"id":"' || event_id || '"}') AS row_hash FROM events
""")
def fn_md5_row(t):
    body = F.concat(
        F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('", "a": {"y":"1","x":"'), "event_type", F.lit('"}}')
    )
    return t("events").select("event_id", row_hash(F.parse_json(body)).alias("row_hash"))


@query("""
SELECT product_name, scrape_no, TRY_CAST(replace(regexp_extract(price_text, '[\\d,]+\\.?\\d*'), ',', '') AS DOUBLE) AS price,
       TRY_CAST(replace(regexp_extract(original_text, '[\\d,]+\\.?\\d*'), ',', '') AS DOUBLE) AS original FROM fx_products
""")
def fn_price_first(t):
    return t("fx_products").select(
        "product_name", "scrape_no", price_first("price_text").alias("price"), price_first("original_text").alias("original")
    )


@query("""
SELECT product_name, scrape_no, TRY_CAST(replace(COALESCE(NULLIF(regexp_extract(x, '(?i)KES\\s*([\\d,]+\\.?\\d*)', 1), ''),
       regexp_extract(x, '[\\d,]+\\.?\\d*')), ',', '') AS DOUBLE) AS price
FROM (SELECT product_name, scrape_no, '3 for ' || CASE WHEN scrape_no = 2 THEN lower(price_text) WHEN scrape_no = 3 THEN 'cash' ELSE price_text END AS x FROM fx_products)
""")
def fn_price_kes(t):
    n = F.col("scrape_no")
    text = F.concat(
        F.lit("3 for "), F.when(n == 2, F.lower("price_text")).when(n == 3, "cash").otherwise(F.col("price_text"))
    )
    return t("fx_products").select("product_name", "scrape_no", price_kes(text).alias("price"))


@query("""
SELECT product_name, scrape_no, TRY_CAST(regexp_extract(regexp_replace(x, '[^0-9.]', '', 'g'), '^(?:\\d+\\.?\\d*|\\.\\d+)') AS DOUBLE) AS price
FROM (SELECT product_name, scrape_no, CASE WHEN scrape_no = 3 THEN 'v.1.' || price_text WHEN scrape_no = 2 THEN price_text || ' 1.2' ELSE price_text END AS x FROM fx_products)
""")
def fn_price_digits(t):
    n, p = F.col("scrape_no"), F.col("price_text")
    text = F.when(n == 3, F.concat(F.lit("v.1."), p)).when(n == 2, F.concat(p, F.lit(" 1.2"))).otherwise(p)
    return t("fx_products").select("product_name", "scrape_no", price_digits(text).alias("price"))


@query("""
SELECT product_name, scrape_no, CASE WHEN current_price <> 0 AND original_price <> 0
  THEN round((original_price - current_price) / original_price * 100, 2) END AS discount FROM ox_price
""")
def fn_discount_pct(t):
    return t("fx_products").select(
        "product_name", "scrape_no", discount_pct(price_first("price_text"), price_first("original_text")).alias("discount")
    )


@query("""
SELECT product_name, scrape_no, CASE WHEN scrape_no = 2 THEN original_price ELSE current_price END AS current_price,
       CASE WHEN scrape_no = 2 THEN NULL ELSE original_price END AS original_price FROM ox_price
""")
def fn_price_swap(t):
    shown = F.when(F.col("scrape_no") != 2, price_first("price_text"))
    current, original = price_swap(shown, price_first("original_text"))
    return t("fx_products").select("product_name", "scrape_no", current.alias("current_price"), original.alias("original_price"))


@query("""
SELECT product_name, scrape_no, replace(url_decode(regexp_extract(CASE WHEN scrape_no = 2 THEN 'https://maps.example.org/x' ELSE url END, '/place/([^/]+)', 1)), '+', ' ') AS business_name
FROM fx_products
""")
def fn_place_name(t):
    url = F.when(F.col("scrape_no") == 2, "https://maps.example.org/x").otherwise(F.col("url"))
    return t("fx_products").select("product_name", "scrape_no", place_name(url).alias("business_name"))


@query("SELECT event_id, CAST(event_id * 7919 AS VARCHAR) AS number FROM events")
def fn_phone_suffix(t):
    item = F.concat(F.lit("phone:tel:"), (F.col("event_id") * 7919).cast("string"))
    return t("events").select("event_id", phone_suffix(item).alias("number"))


@query("SELECT event_id, date_trunc('second', ts) + INTERVAL 3 HOUR AS from_seconds, date_trunc('millisecond', ts) + INTERVAL 3 HOUR AS from_millis FROM events")
def fn_epoch_local(t):
    instant = F.col("ts").cast("timestamp")
    return t("events").select(
        "event_id",
        d.epoch_local(F.unix_seconds(instant)).alias("from_seconds"),
        d.epoch_local(F.unix_millis(instant)).alias("from_millis"),
    )


@query("""
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') || '_' || CASE WHEN event_id % 3 = 0 THEN 'job_' || event_id ELSE 'a_b_' || event_type || '.pdf' END AS stem FROM events
""")
def fn_file_stem(t):
    name = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("a/b\\"), "event_type", F.lit(".pdf")))
    return t("events").select("event_id", file_stem("ts", name, F.col("event_id").cast("string")).alias("stem"))


@query("""
SELECT branch, CAST(floor(base_pop * power(CAST(1.042 AS DOUBLE), 7)) AS BIGINT) AS projected,
       CASE WHEN base_pop % 3 = 0 THEN 0 ELSE CAST(floor(base_pop * power(CAST(1.042 AS DOUBLE), 7)) AS BIGINT) END AS with_pois FROM fx_branches
""")
def fn_pop_projection(t):
    return t("fx_branches").select(
        "branch",
        projected_population("base_pop").alias("projected"),
        projected_population("base_pop", F.col("base_pop") % 3).alias("with_pois"),
    )


@query("""
WITH c AS (SELECT 6378137.0::DOUBLE AS a, (1 / 298.257223563)::DOUBLE / (2 - (1 / 298.257223563)::DOUBLE) AS n),
p AS (SELECT c_custkey, radians(-4.0 + (c_custkey % 800) / 100.0) AS phi, radians(34.0 + (c_custkey % 700) / 100.0 - 39.0) AS lam FROM customer),
q AS (SELECT *, sinh(atanh(sin(phi)) - 2 * sqrt(n) / (1 + n) * atanh(2 * sqrt(n) / (1 + n) * sin(phi))) AS tt FROM p, c),
r AS (SELECT *, atan2(tt, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + tt * tt)) AS eta,
        a / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) * 0.9996 AS k,
        n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1, 13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3 FROM q)
SELECT c_custkey,
  round(500000 + k * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)), 2) AS easting,
  round(10000000 + k * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta)), 2) AS northing
FROM r
""")
def fn_utm37s(t):
    k = F.col("c_custkey")
    lon, lat = (k % 700) / 100.0 + 34.0, (k % 800) / 100.0 - 4.0
    east, north = utm37s(lon, lat)
    return t("customer").select("c_custkey", F.round(east, 2).alias("easting"), F.round(north, 2).alias("northing"))


# ---- SQL functions

def _call(t, source: str, sql: str):
    register_sql_functions(t.spark)
    t(source).createOrReplaceTempView("udf_input")
    return t.spark.sql(f"{sql} FROM udf_input")


_BODY = "CAST(40 + c_custkey % 80 AS DOUBLE) AS w, CAST(CASE WHEN c_custkey % 19 = 0 THEN 0 ELSE 140 + c_custkey % 60 END AS DOUBLE) AS h"


@query(f"SELECT c_custkey, w / NULLIF(power(h / 100, 2), 0) AS bmi FROM (SELECT c_custkey, {_BODY} FROM customer)")
def udf_bmi(t):
    return _call(t, "customer", """
        SELECT c_custkey, fn_calculate_bmi(40 + c_custkey % 80, CASE WHEN c_custkey % 19 = 0 THEN 0 ELSE 140 + c_custkey % 60 END) AS bmi""")


@query("""
SELECT c_custkey, CASE WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi BETWEEN 18.5 AND 24.9 THEN 'Normal'
  WHEN bmi BETWEEN 25 AND 29.9 THEN 'Overweight' WHEN bmi BETWEEN 30 AND 34.9 THEN 'Obese Class I'
  WHEN bmi BETWEEN 35 AND 39.9 THEN 'Obese Class II' WHEN bmi >= 40 THEN 'Obese Class III' ELSE 'Unknown' END AS bmi_class
FROM (SELECT c_custkey, CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 15 + (c_custkey % 600) / CAST(20 AS DOUBLE) END AS bmi FROM customer)
""")
def udf_classify_bmi(t):
    return _call(t, "customer", """
        SELECT c_custkey, fn_classify_bmi(CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 15 + (c_custkey % 600) / 20D END) AS bmi_class""")


@query("""
SELECT patient_id, CASE WHEN dob IS NULL THEN 'Unknown' WHEN age < 1 THEN 'Infant' WHEN age < 5 THEN 'Toddler' WHEN age < 13 THEN 'Child'
  WHEN age < 18 THEN 'Adolescent' WHEN age < 40 THEN 'Young Adult' WHEN age < 65 THEN 'Middle Age' ELSE 'Senior' END AS age_group
FROM (SELECT patient_id, dob, 2024 - year(dob) AS age FROM (
  SELECT patient_id, CASE WHEN CAST(patient_id AS BIGINT) % 13 = 0 THEN NULL ELSE date_of_birth END AS dob FROM fx_patients))
""")
def udf_age_group(t):
    return _call(t, "fx_patients", f"""
        SELECT patient_id, fn_extract_age_group(CASE WHEN CAST(patient_id AS BIGINT) % 13 = 0 THEN NULL ELSE date_of_birth END,
               DATE '{AS_OF[:10]}') AS age_group""")


@query("""
SELECT encounter_id, CASE WHEN n IS NULL THEN 'Unknown' WHEN n = 0 THEN 'Same Day' WHEN n = 1 THEN '1 Day' WHEN n BETWEEN 2 AND 3 THEN '2-3 Days'
  WHEN n BETWEEN 4 AND 7 THEN '4-7 Days' WHEN n BETWEEN 8 AND 14 THEN '1-2 Weeks' WHEN n BETWEEN 15 AND 30 THEN '2-4 Weeks' ELSE '> 4 Weeks' END AS los_band
FROM (SELECT encounter_id, date_diff('day', CAST(admit_ts AS DATE), CAST(discharge_ts AS DATE) + CAST(CAST(encounter_id AS BIGINT) % 40 AS INT) - 3) AS n FROM fx_encounters)
""")
def udf_los_band(t):
    return _call(t, "fx_encounters", """
        SELECT encounter_id, fn_calculate_los_band(CAST(admit_ts AS DATE),
               date_add(CAST(discharge_ts AS DATE), CAST(CAST(encounter_id AS BIGINT) % 40 AS INT) - 3)) AS los_band""")


@query("""
SELECT patient_id, CASE WHEN s IS NOT NULL THEN least(CAST(100 AS DOUBLE), greatest(CAST(0 AS DOUBLE), s)) END AS risk
FROM (SELECT patient_id, (2024 - year(date_of_birth)) * CAST(0.5 AS DOUBLE) + CASE WHEN gender = 'M' THEN 5 ELSE 3 END + (k % 4) * 10
        + (k % 3) * 15 + CASE WHEN k % 29 = 0 THEN NULL ELSE k % 9 END * 2 + (CAST(k % 50000 AS DOUBLE) / 10000) * 5 AS s
      FROM (SELECT *, CAST(patient_id AS BIGINT) AS k FROM fx_patients))
""")
def udf_readmission_risk(t):
    k = "CAST(patient_id AS BIGINT)"
    return _call(t, "fx_patients", f"""
        SELECT patient_id, fn_calculate_readmission_risk({AS_OF[:4]} - year(date_of_birth), gender, {k} % 4, {k} % 3,
               CASE WHEN {k} % 29 = 0 THEN NULL ELSE {k} % 9 END, {k} % 50000) AS risk""")
