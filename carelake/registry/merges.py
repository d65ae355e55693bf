"""Upserts."""

from pyspark.sql import functions as F

from ..functions.prices import discount_pct, price_first
from ..operators.dedup import latest_per_key
from ..operators.merge import merge_upsert
from ..plans.mart import daily_facility_metrics, daily_metrics_source, provider_history, refresh_daily_metrics
from ..plans.products import merge_daily
from ..sources.sync import merge_by_primary_key, stage
from . import query
from .aggregates import labelled

_COLUMNS = ["id", "facility_id", "type", "amount", "ingested_at"]


def _merge_sql(on: str, guard: str) -> str:
    def pick(c: str) -> str:
        return f"CASE WHEN t.ingested_at IS NULL THEN s.{c} WHEN s.ingested_at IS NOT NULL AND {guard} THEN s.{c} ELSE t.{c} END AS {c}"

    return f"SELECT {', '.join(pick(c) for c in _COLUMNS)} FROM fx_target t FULL JOIN fx_delivery s ON {on}"


@query(_merge_sql("t.id = s.id", "TRUE"))
def dml_merge(t):
    # Rows with an id come in an older version as well; the latest of each is merged.
    delivery = t("fx_delivery")
    older = delivery.filter("id IS NOT NULL").withColumns({"type": F.lit("older"), "ingested_at": F.expr("ingested_at - INTERVAL 2 DAYS")})
    latest = latest_per_key(delivery.filter("id IS NOT NULL").unionByName(older), ["id"], "ingested_at", ["type"])
    # One row an id by now; null ids match nothing.
    return merge_upsert(t("fx_target"), latest.unionByName(delivery.filter("id IS NULL")), ["id"], update_cols=_COLUMNS, check_unique=False)


@query(_merge_sql("t.id = s.id AND t.facility_id = s.facility_id", "t.ingested_at < s.ingested_at"))
def dml_merge_guarded(t):
    newer = lambda old, new: old("ingested_at") < new("ingested_at")
    return merge_upsert(t("fx_target"), t("fx_delivery"), ["id", "facility_id"], update_cols=_COLUMNS, when=newer)


@query("""
SELECT COALESCE(t.product_name, s.product_name) AS product_name, COALESCE(t.scrape_date, s.scrape_date) AS scrape_date,
       COALESCE(t.url, s.url) AS url, COALESCE(s.current_price, t.current_price) AS current_price,
       CASE WHEN s.product_name IS NOT NULL THEN s.discount ELSE t.discount END AS discount_percentage
FROM (SELECT *, round((original_price - current_price) / original_price * 100, 2) AS discount FROM ox_price WHERE scrape_no = 1) t
FULL JOIN (SELECT *, round((original_price - current_price) / original_price * 100, 2) AS discount FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY product_name, CAST(scrape_date AS DATE) ORDER BY scrape_date DESC) AS rn FROM ox_price) WHERE rn = 1) s
ON t.product_name = s.product_name AND CAST(t.scrape_date AS DATE) = CAST(s.scrape_date AS DATE)
""")
def dml_merge_daily(t):
    price, original = price_first("price_text"), price_first("original_text")
    scrapes = t("fx_products").select(
        "product_name", "scrape_no", "scrape_date", "url", price.alias("current_price"),
        discount_pct(price, original).alias("discount_percentage"),
    )
    stored = scrapes.filter("scrape_no = 1").drop("scrape_no")
    return merge_daily(stored, scrapes.drop("scrape_no"), ["current_price", "discount_percentage"])


SUPPLIER_ROWS = [
    {"table": "supplier", "field": "s_suppkey", "type": "bigint(20)", "null": "NO", "key": "PRI"},
    {"table": "supplier", "field": "s_name", "type": "varchar(50)", "null": "YES", "key": ""},
    {"table": "supplier", "field": "s_nationkey", "type": "int(11)", "null": "YES", "key": ""},
    {"table": "supplier", "field": "s_acctbal", "type": "decimal(12,2)", "null": "YES", "key": ""},
]


@query("""
SELECT CAST(s_suppkey AS DECIMAL(38,0)) AS s_suppkey, s_name, CAST(s_nationkey AS DECIMAL(38,0)) AS s_nationkey,
       CAST(s_acctbal + CASE WHEN s_suppkey % 4 <> 1 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS s_acctbal,
       CASE WHEN s_suppkey % 4 <> 1 THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS _ingested_at
FROM supplier WHERE s_suppkey % 4 <> 1 OR s_suppkey % 2 = 1
""")
def dml_merge_pk(t):
    supplier = t("supplier")
    old, new = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01 00:00:00", "2024-01-31 00:00:00"))
    stored = stage(supplier.filter("s_suppkey % 2 = 1"), SUPPLIER_ROWS, old)
    changed = supplier.filter("s_suppkey % 4 <> 1").withColumn("s_acctbal", F.col("s_acctbal") + 1)
    # The delivery holds every row twice.
    return merge_by_primary_key(stored, stage(changed.unionByName(changed), SUPPLIER_ROWS, new), ["s_suppkey"])


@query("""
WITH old AS (SELECT CAST(event_time AS DATE) AS metric_date, facility_id, COUNT(DISTINCT event_id) AS n, COUNT(DISTINCT patient_id) AS p,
               CAST(((2 * CAST(SUM(amount) * 100 AS HUGEINT) + COUNT(amount)) // (2 * COUNT(amount))) / 100.0 AS DECIMAL(38,2)) AS a
             FROM fx_clean_events WHERE event_time < TIMESTAMP '2024-01-30 12:00:00' GROUP BY 1, 2),
fresh AS (SELECT CAST(event_time AS DATE) AS metric_date, facility_id, COUNT(DISTINCT event_id) AS n, COUNT(DISTINCT patient_id) AS p,
               CAST(((2 * CAST(SUM(amount) * 100 AS HUGEINT) + COUNT(amount)) // (2 * COUNT(amount))) / 100.0 AS DECIMAL(38,2)) AS a
             FROM fx_clean_events WHERE event_time >= TIMESTAMP '2024-01-29 00:00:00' GROUP BY 1, 2)
SELECT COALESCE(o.metric_date, f.metric_date) AS metric_date, COALESCE(o.facility_id, f.facility_id) AS facility_id,
       COALESCE(f.n, o.n) AS total_encounters, COALESCE(f.p, o.p) AS unique_patients, CASE WHEN f.n IS NOT NULL THEN f.a ELSE o.a END AS avg_revenue_per_encounter,
       CASE WHEN o.n IS NOT NULL AND f.n IS NOT NULL THEN TIMESTAMP '2024-01-30 18:00:00' END AS updated_at
FROM old o FULL JOIN fresh f ON o.metric_date = f.metric_date AND o.facility_id = f.facility_id
""")
def dml_agg_refresh(t):
    clean = labelled(t)
    stored = daily_facility_metrics(clean.filter(F.col("event_time") < F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")), "2024-01-30 12:00:00")
    now = "2024-01-30 18:00:00"
    merged = refresh_daily_metrics(stored, daily_metrics_source(clean, now, 24), now)
    return merged.select("metric_date", "facility_id", "total_encounters", "unique_patients", "avg_revenue_per_encounter", "updated_at")


@query("""
SELECT md5(CAST(s_suppkey AS VARCHAR) || '|2020-01-01') AS provider_sk, CAST(s_suppkey AS VARCHAR) AS provider_id, s_name AS provider_name,
       'D' || s_nationkey AS department, DATE '2020-01-01' AS effective_date,
       CASE WHEN s_suppkey % 6 = 0 THEN DATE '2024-01-31' END AS end_date, s_suppkey % 6 <> 0 AS is_current
FROM supplier WHERE s_suppkey % 5 <> 4
UNION ALL
SELECT md5(CAST(s_suppkey AS VARCHAR) || '|2024-01-31'), CAST(s_suppkey AS VARCHAR), s_name, CASE WHEN s_suppkey % 6 = 0 THEN 'moved' ELSE 'D' || s_nationkey END,
       DATE '2024-01-31', NULL, TRUE
FROM supplier WHERE s_suppkey % 6 = 0 OR s_suppkey % 5 = 4
""")
def dml_scd2(t):
    k = F.col("s_suppkey")
    rows = t("supplier").select(
        "s_suppkey", k.cast("string").alias("provider_id"), F.col("s_name").alias("provider_name"),
        F.concat(F.lit("D"), F.col("s_nationkey").cast("string")).alias("department"),
    )
    # All suppliers but every fifth are there; of the delivery some are new, some moved, some the same.
    stored = provider_history(None, rows.filter(k % 5 != 4).drop("s_suppkey"), "2020-01-01")
    moved = F.when(k % 6 == 0, F.lit("moved")).otherwise(F.col("department"))
    delivery = rows.filter((k % 3 == 0) | (k % 5 == 4)).withColumn("department", moved).drop("s_suppkey")
    history = provider_history(stored, delivery, "2024-01-31")
    return history.select("provider_sk", "provider_id", "provider_name", "department", "effective_date", "end_date", "is_current")


@query("""
SELECT provider_id, department, effective_date, end_date, end_date IS NULL AS is_current, md5(provider_id || '|' || effective_date) AS provider_sk FROM (
    SELECT CAST(s_suppkey AS VARCHAR) AS provider_id, 'D' || s_nationkey AS department, DATE '2020-01-01' AS effective_date,
           CASE WHEN s_suppkey % 2 = 0 THEN DATE '2022-06-01' END AS end_date FROM supplier WHERE s_suppkey % 5 <> 4
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'back', DATE '2022-06-01', CASE WHEN s_suppkey % 6 = 0 OR s_suppkey % 5 = 4 THEN DATE '2024-01-31' END
    FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 6 = 0 THEN 'moved' ELSE 'D' || s_nationkey END, DATE '2024-01-31', NULL
    FROM supplier WHERE s_suppkey % 6 = 0 OR s_suppkey % 5 = 4
)
""")
def dml_scd2_backdated(t):
    k = F.col("s_suppkey")
    rows = t("supplier").select(
        "s_suppkey", k.cast("string").alias("provider_id"), F.col("s_name").alias("provider_name"),
        F.concat(F.lit("D"), F.col("s_nationkey").cast("string")).alias("department"),
    )
    # The last delivery is older than what the one before it wrote.
    history = provider_history(None, rows.filter(k % 5 != 4).drop("s_suppkey"), "2020-01-01")
    moved = rows.filter((k % 6 == 0) | (k % 5 == 4)).withColumn("department", F.when(k % 6 == 0, "moved").otherwise(F.col("department")))
    history = provider_history(history, moved.drop("s_suppkey"), "2024-01-31")
    history = provider_history(history, rows.filter(k % 2 == 0).withColumn("department", F.lit("back")).drop("s_suppkey"), "2022-06-01")
    return history.select("provider_id", "department", "effective_date", "end_date", "is_current", "provider_sk")
