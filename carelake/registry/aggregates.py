"""Aggregations, sorts and set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import TABLES
from ..functions.dates import epoch_local
from ..functions.nulls import count_when, mean, sum_when
from ..operators.bitmaps import DistinctStore, distinct_counts
from ..operators.dedup import duplicate_keys, first_per_key
from ..operators.documents import first_failures, run_summary
from ..plans.clean import label_events
from ..plans.clinical import encounter_metrics
from ..plans.inventory import signed_quantity
from ..plans.market import all_text, keyword_counts
from ..plans.mart import top_procedures
from ..plans.quality import load_span
from ..plans.revenue import daily_revenue, monthly_revenue, weekly_revenue
from ..session import scratch_path
from ..sources.bucketed import write_bucketed
from . import query


def labelled(t):
    return label_events(t("fx_clean_events").drop("payload"))


@query("SELECT * FROM ox_daily")
def agg_daily_revenue(t):
    return daily_revenue(labelled(t))


@query("SELECT * FROM ox_weekly")
def agg_weekly(t):
    return weekly_revenue(daily_revenue(labelled(t)))


@query("SELECT * FROM ox_monthly")
def agg_monthly(t):
    return monthly_revenue(daily_revenue(labelled(t)))


@query("""
SELECT facility_id, COUNT(DISTINCT patient_id) AS patients, COUNT(DISTINCT event_type) AS types, COUNT(DISTINCT currency) AS currencies
FROM fx_clean_events GROUP BY 1
""")
def agg_distinct(t):
    return t("fx_clean_events").groupBy("facility_id").agg(
        F.countDistinct("patient_id").alias("patients"),
        F.countDistinct("event_type").alias("types"),
        F.countDistinct("currency").alias("currencies"),
    )


@query("""
SELECT level, start, facility_id, patients FROM (
    SELECT 'day' AS level, CAST(event_time AS DATE) AS start, facility_id, COUNT(DISTINCT patient_id) AS patients FROM fx_clean_events GROUP BY ALL
    UNION ALL SELECT 'week', CAST(date_trunc('week', event_time) AS DATE), facility_id, COUNT(DISTINCT patient_id) FROM fx_clean_events GROUP BY ALL
    UNION ALL SELECT 'month', CAST(date_trunc('month', event_time) AS DATE), facility_id, COUNT(DISTINCT patient_id) FROM fx_clean_events GROUP BY ALL
) WHERE patients > 0
""")
def agg_distinct_merged(t):
    # Two loads that share some rows; the counts read the stored bitmaps alone.
    rows = t("fx_clean_events").select(F.col("event_time").cast("date").alias("day"), "facility_id", "patient_id", "ingested_at")
    first, late = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    store = DistinctStore(["day", "facility_id"], "patient_id")
    store.load(rows.filter(F.col("ingested_at") < first))
    stored = store.load(rows.filter(~(F.col("ingested_at") < late)))
    parts = [
        distinct_counts(stored, [start.cast("date").alias("start"), "facility_id"], "patients").select(F.lit(level).alias("level"), "start", "facility_id", "patients")
        for level, start in (("day", F.col("day")), ("week", F.trunc("day", "week")), ("month", F.trunc("day", "month")))
    ]
    return reduce(DataFrame.unionByName, parts)


@query("""
SELECT facility_id, COUNT(DISTINCT CASE WHEN event_category = 'FINANCIAL' THEN event_id END) AS financial,
       COUNT(DISTINCT CASE WHEN event_category = 'CLINICAL' THEN event_id END) AS clinical FROM ox_labelled GROUP BY 1
""")
def agg_distinct_cond(t):
    category = F.col("event_category")
    return labelled(t).groupBy("facility_id").agg(
        F.countDistinct(F.when(category == "FINANCIAL", F.col("event_id"))).alias("financial"),
        F.countDistinct(F.when(category == "CLINICAL", F.col("event_id"))).alias("clinical"),
    )


@query("""
SELECT facility_id, CAST(SUM(CASE WHEN event_category = 'FINANCIAL' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS revenue,
       CAST(SUM(CASE WHEN validation_status = 'VALID' THEN 1 ELSE 0 END) AS BIGINT) AS valid,
       CAST(SUM(CASE WHEN event_category = 'FINANCIAL' THEN amount END) AS DOUBLE) / COUNT(CASE WHEN event_category = 'FINANCIAL' THEN amount END) AS avg_paid,
       CAST(SUM(CASE WHEN event_category = 'FINANCIAL' THEN amount ELSE 0 END) AS DOUBLE) / COUNT(CASE WHEN event_category = 'FINANCIAL' THEN amount ELSE 0 END) AS avg_all
FROM ox_labelled GROUP BY 1
""")
def agg_cond_sum(t):
    financial = F.col("event_category") == "FINANCIAL"
    zero = F.lit(0).cast("decimal(38,2)")
    return labelled(t).groupBy("facility_id").agg(
        sum_when(financial, F.col("amount"), zero).cast("decimal(38,2)").alias("revenue"),
        count_when(F.col("validation_status") == "VALID").alias("valid"),
        mean(F.when(financial, F.col("amount"))).alias("avg_paid"),
        mean(F.when(financial, F.col("amount")).otherwise(zero)).alias("avg_all"),
    )


@query("SELECT encounter_id, string_agg(DISTINCT diagnosis_code, ', ' ORDER BY diagnosis_code) AS codes FROM fx_diagnoses GROUP BY 1")
def agg_listagg(t):
    codes = F.array_join(F.array_sort(F.collect_set("diagnosis_code")), ", ")
    return t("fx_diagnoses").groupBy("encounter_id").agg(codes.alias("codes"))


@query("""
SELECT product_id, facility_id, CAST(SUM(CASE WHEN movement_type IN ('receipt', 'return') THEN quantity
  WHEN movement_type IN ('issue', 'adjustment') THEN -quantity ELSE 0 END) AS DECIMAL(38,2)) AS net_change FROM fx_stock_movements GROUP BY 1, 2
""")
def agg_signed_net(t):
    return t("fx_stock_movements").groupBy("product_id", "facility_id").agg(
        F.sum(signed_quantity()).cast("decimal(38,2)").alias("net_change")
    )


@query("SELECT * FROM ox_encounter_metrics")
def agg_encounter(t):
    return encounter_metrics(t("fx_encounters"), t("fx_diagnoses"), t("fx_procedures"))


@query("SELECT * FROM ox_encounter_metrics")
def agg_encounter_bucketed(t):
    # Stored in buckets of the encounter: the sums and both joins move no rows.
    names = ("fx_encounters", "fx_diagnoses", "fx_procedures")
    tables = [write_bucketed(t(n), f"bucketed_{n}", "encounter_id", 8, scratch_path(t.spark, n)) for n in names]
    return encounter_metrics(*tables)


@query("SELECT id, COUNT(*) AS n_rows FROM fx_raw_events GROUP BY 1 HAVING COUNT(*) > 1")
def agg_having(t):
    return duplicate_keys(t("fx_raw_events"), ["id"])


@query("""
SELECT facility_id, MIN(_loaded_at) AS first_load, MAX(_loaded_at) AS last_load,
       date_diff('minute', MIN(_loaded_at), MAX(_loaded_at)) AS load_duration_minutes FROM fx_loads GROUP BY 1
""")
def agg_min_max_span(t):
    return load_span(t("fx_loads"), ["facility_id"])


@query("""
SELECT city, '[' || string_agg('{' || COALESCE('"segment":"' || first_name || '",', '') || '"gender":"' || gender || '","n":' || n || '}', ',' ORDER BY first_name, gender) || ']' AS items,
       '{' || string_agg('"' || first_name || ' ' || gender || '":' || n, ',' ORDER BY first_name, gender) || '}' AS per_group
FROM (SELECT city, first_name, gender, COUNT(*) AS n FROM fx_patients GROUP BY 1, 2, 3) GROUP BY 1
""")
def agg_array_object(t):
    # Rows are summed up first: a list holds segments x genders, however many patients.
    counts = t("fx_patients").groupBy("city", F.col("first_name").alias("segment"), "gender").agg(F.count("*").alias("n"))
    entry = F.struct(F.concat("segment", F.lit(" "), "gender").alias("key"), "n")
    lists = counts.groupBy("city").agg(
        F.array_sort(F.collect_list(F.struct("segment", "gender", "n"))).alias("_rows"),
        F.array_sort(F.collect_list(entry)).alias("_entries"),
    )
    return lists.select("city", F.to_json("_rows").alias("items"), F.to_json(F.map_from_entries("_entries")).alias("per_group"))


@query("""
SELECT x // 1000 AS strip, COUNT(*) AS poi_count,
  CAST(SUM(CASE WHEN regexp_matches(lower(txt), 'gym|fitness|salon|beauty|spa|barber') THEN 1 ELSE 0 END) AS BIGINT) AS lifestyle_drivers,
  CAST(SUM(CASE WHEN regexp_matches(lower(txt), 'bar|pub|nightclub|wines|spirits|restaurant|liquor') THEN 1 ELSE 0 END) AS BIGINT) AS social_drivers,
  CAST(SUM(CASE WHEN regexp_matches(lower(txt), 'pharmacy|chemist|hospital|clinic|dawa') THEN 1 ELSE 0 END) AS BIGINT) AS competition
FROM (SELECT x, poi_id || ' ' || x || ' ' || y || ' ' || name AS txt FROM fx_pois) GROUP BY 1
""")
def agg_keyword_count(t):
    pois = t("fx_pois")
    return keyword_counts(pois, [F.floor(F.col("x") / 1000).alias("strip")], all_text(pois))


def _results(t):
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    short = F.col("n_chars") < 200
    return t("documents").select(
        (~short).alias("ok"), name.alias("filename"), F.when(short, F.concat(F.lit("too short: "), F.col("n_chars"))).alias("error")
    )


@query("""
SELECT COUNT(*) AS total, CAST(SUM(CASE WHEN n_chars >= 200 THEN 1 ELSE 0 END) AS BIGINT) AS ok,
       CAST(SUM(CASE WHEN n_chars < 200 THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM documents
""")
def agg_run_summary(t):
    return run_summary(_results(t))


@query("""
SELECT source || '/' || doc_id AS filename, 'too short: ' || n_chars AS error FROM documents WHERE n_chars < 200 ORDER BY 1, 2 LIMIT 10
""")
def agg_first_failures(t):
    return first_failures(_results(t))


# ---- sort, top-k, sets

@query("""
SELECT primary_procedure_code, COUNT(*) AS procedure_count, CAST(SUM(total_charges) AS DECIMAL(38,2)) AS total_charges
FROM (SELECT e.*, p.primary_procedure_code FROM fx_encounters e LEFT JOIN
      (SELECT encounter_id, MIN(procedure_code) AS primary_procedure_code FROM fx_procedures GROUP BY 1) p USING (encounter_id))
WHERE date_trunc('month', admit_ts) = DATE '1998-03-01' GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10
""")
def sort_topk(t):
    codes = t("fx_procedures").groupBy("encounter_id").agg(F.min("procedure_code").alias("primary_procedure_code"))
    facts = t("fx_encounters").join(codes, "encounter_id", "left").withColumn("admit_date", F.col("admit_ts").cast("date"))
    return top_procedures(facts, "1998-03-01")


@query("SELECT event_id AS job_id, date_trunc('second', ts) + INTERVAL 3 HOUR AS received FROM events ORDER BY 2, 1")
def sort_by_time(t):
    jobs = t("events").select(
        F.col("event_id").alias("job_id"), epoch_local(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("received")
    )
    return jobs.orderBy("received", "job_id")


@query("""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate) AS rn FROM lineitem) WHERE rn = 1
""")
def set_distinct_first(t):
    order = [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")]
    rows = t("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return first_per_key(rows, ["l_partkey"], order).drop("l_shipdate")


@query("SELECT DISTINCT facility_id, event_type, currency, event_date FROM fx_clean_events")
def set_distinct_rows(t):
    return t("fx_clean_events").select("facility_id", "event_type", "currency", "event_date").distinct()


@query(" UNION ALL ".join(
    f"SELECT 'rows_{n}' AS check_name, CAST(COUNT(*) AS VARCHAR) AS check_value, "
    f"CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS check_status FROM {n}" for n in TABLES
))
def set_union_checks(t):
    checks = [
        t(n).agg(F.count("*").alias("_n")).select(
            F.lit(f"rows_{n}").alias("check_name"),
            F.col("_n").cast("string").alias("check_value"),
            F.when(F.col("_n") > 0, "PASS").otherwise("FAIL").alias("check_status"),
        )
        for n in TABLES
    ]
    return reduce(DataFrame.unionByName, checks)
