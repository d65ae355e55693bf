"""Sinks and sources: test tables written in a form, read back and compared."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dictionary import group_tables, schema_from_dictionary
from ..operators.documents import extract_documents
from ..session import scratch_path, spread
from ..sources import files, landing
from ..sources.geojson_blocks import feature_files
from ..sources.sync import load_all_tables
from ..sources.tables import Table
from . import query
from .merges import SUPPLIER_ROWS

# Every eleventh line is no JSON, every seventh an array of two records.
_BAD, _PAIR = "event_id % 11 = 0", "event_id % 7 = 0"


def landing_lines(events):
    """Events as landed lines; some facilities and tables have names that look like numbers."""
    def record(key):
        return F.to_json(F.struct(key.alias("id"), F.col("event_type").alias("type")))

    key = F.col("event_id").cast("string")
    pair = F.concat(F.lit("["), record(key), F.lit(","), record(F.concat(F.lit("x"), key)), F.lit("]"))
    line = F.when(F.expr(_BAD), F.lit("{broken")).when(F.expr(_PAIR), pair).otherwise(record(key))
    place = F.col("user_id") % 5
    return events.select(
        F.when(place == 0, "007").otherwise(F.concat(F.lit("F/"), place.cast("string"))).alias("facility_id"),
        F.lit("core").alias("module"),
        F.when(F.expr("event_id % 13 = 0"), "1e3").otherwise(F.col("event_type")).alias("table"),
        F.lit("Ignite\\Core\\Entities\\Event").alias("namespace"),
        F.trunc(F.col("ts").cast("date"), "month").alias("dt"),
        line.alias("line"),
    )


def landed(t, *runs: str) -> str:
    root = scratch_path(t.spark, "landing")
    for run in runs:
        landing.write_raw_landing(landing_lines(t("events")), root, run)
    return root


_PLACE = "CASE user_id % 5 WHEN 0 THEN '007' ELSE 'F_' || (user_id % 5) END AS facility_id"
_TABLE = "CASE WHEN event_id % 13 = 0 THEN '1e3' ELSE event_type END"
_RAW_SQL = f"""
SELECT id, {_PLACE}, 'core' AS module_source, {_TABLE} AS source_table,
       'Ignite_Core_Entities_Event' AS namespace, CAST(date_trunc('month', ts) AS DATE) AS execution_date,
       md5('{{"id":"' || id || '","type":"' || event_type || '"}}') AS row_hash
FROM (SELECT *, CAST(event_id AS VARCHAR) AS id FROM events UNION ALL SELECT *, 'x' || event_id FROM events WHERE {_PAIR}) WHERE NOT ({_BAD})
"""
_RAW_COLUMNS = ["facility_id", "module_source", "source_table", "namespace", "execution_date", "row_hash"]


@query(_RAW_SQL)
def src_raw_jsonl(t):
    raw = landing.read_raw_landing(t.spark, landed(t, "run-1"))
    return raw.select(F.try_variant_get("payload", "$.id", "string").alias("id"), *_RAW_COLUMNS)


@query(_RAW_SQL)
def src_external(t):
    landing.register_external(t.spark, landed(t, "run-1"), "external_events")
    return t.spark.sql(f"SELECT try_variant_get(payload, '$.id', 'string') AS id, {', '.join(_RAW_COLUMNS)} FROM external_events")


@query(f"""
SELECT facility_id, "table", r.run_id, COUNT(*) AS lines
FROM (SELECT {_PLACE}, {_TABLE} AS "table" FROM events), (SELECT 'run_1' AS run_id UNION ALL SELECT 'run_2') r GROUP BY 1, 2, 3
""")
def src_raw_sink(t):
    # The first run is written twice: the second time replaces the first.
    root = landed(t, "run 1", "run 2", "run 1")
    with landing.keys_as_text(t.spark):
        lines = t.spark.read.text(root)
    return lines.groupBy("facility_id", "table", "run_id").agg(F.count("*").alias("lines"))


@query("""
SELECT n_nationkey AS key, n_name AS name, CAST(n_regionkey AS DOUBLE) AS balance, NULL AS note FROM nation
UNION SELECT s_suppkey, NULL, s_acctbal, 'line 1' || chr(10) || 'line "2", ' || s_name FROM supplier
UNION SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_name END, c_acctbal, NULL FROM customer
""")
def src_csv_union(t):
    root = scratch_path(t.spark, "csv")
    note = F.concat(F.lit('line 1\nline "2", '), F.col("s_name"))
    name = F.when(F.col("c_custkey") % 4 == 0, "N/A").otherwise(F.col("c_name"))
    parts = [
        t("nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("balance")),
        t("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), note.alias("note")),
        t("customer").select(name.alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("key")),
    ]
    for part in [*parts, parts[0]]:
        part.write.mode("append").options(header="true", quote='"', escape='"').csv(root)
    return files.union_csv_folder(t.spark, root).select("key", "name", "balance", "note")


@query("""
SELECT CAST(claim_id AS BIGINT) AS claim_id, TRY_CAST(total_bill AS DECIMAL(18,2)) AS total_bill, 'on' || chr(10) || adm_date AS adm_date
FROM fx_sheet WHERE total_bill IS NULL OR total_bill NOT IN ('N/A', '45F', '12d')
""")
def src_csv_typed(t):
    root = scratch_path(t.spark, "sheet")
    cells = t("fx_sheet").select(
        F.col("claim_id"), F.coalesce("total_bill", F.lit("NaN")).alias("total_bill"), F.concat(F.lit("on\n"), "adm_date").alias("adm_date")
    )
    cells.write.options(header="true", quote='"', escape='"').csv(root)
    schema = T.StructType.fromDDL("claim_id bigint, total_bill decimal(18,2), adm_date string")
    return files.read_csv_typed(t.spark, root, schema)


@query("SELECT 'parquet' AS form, o_orderkey, o_orderpriority, o_totalprice FROM orders UNION ALL SELECT 'csv', o_orderkey, o_orderpriority, o_totalprice FROM orders")
def src_snapshot_sink(t):
    orders = t("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = files.write_snapshot(orders, scratch_path(t.spark, "snapshots"), "1700000000", csv_copy=True)
    parquet = t.spark.read.schema(orders.schema).parquet(path)
    csv = t.spark.read.schema(orders.schema).options(header="true", escape='"').csv(path.replace(".parquet", ".csv"))
    return parquet.select(F.lit("parquet").alias("form"), "*").unionByName(csv.select(F.lit("csv").alias("form"), "*"))


@query("SELECT event_id, user_id, event_type FROM events")
def src_json_batches(t):
    events = t("events").select("event_id", "user_id", "event_type")
    path = scratch_path(t.spark, "batches")
    files.write_json_batches(events, path)
    return files.read_json_batches(t.spark, path, events.schema)


def document_files(documents, root: str, own_folder: bool = True) -> None:
    """One file per document: its text and a line break, in a folder of its own or named by the document. Either are gathered in 256 folders."""
    near = F.pmod(F.xxhash64("doc_id"), F.lit(256)).cast("string")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    folder = F.concat(F.lit("near="), near, F.lit("/doc_id="), name)
    files.write_text_files(spread(documents.select("doc_id", "text")).select(folder.alias("folder"), "text"), root, own_folder=own_folder)


@query("SELECT 'doc_id=' || doc_id AS folder, strlen(text) + 1 AS length, TRUE AS dated FROM documents")
def src_file_list(t):
    root = scratch_path(t.spark, "tree")
    document_files(t("documents"), root)
    listed = files.list_files(t.spark, root, ".txt")
    recent = F.col("modificationTime") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return listed.select(F.element_at(F.split("path", "/"), -2).alias("folder"), "length", recent.alias("dated"))


@query("SELECT doc_id, text || chr(10) AS text FROM documents")
def src_text_docs(t):
    root = scratch_path(t.spark, "texts")
    document_files(t("documents"), root, own_folder=False)
    number = F.regexp_extract("filename", r"^doc_id=(\d+)-", 1).cast("bigint")
    return files.read_text_docs(t.spark, root, ".txt").select(number.alias("doc_id"), "text")


@query("""
SELECT source || '/' || doc_id AS patient_name, '{' || chr(10) || '  "lang": "' || lang || '", "n": ' || n_chars || chr(10) || '}' AS json_record
FROM documents WHERE n_chars >= 200
""")
def src_extract_csv(t):
    # An extractor may return indented JSON.
    record = F.concat(F.lit('{\n  "lang": "'), "lang", F.lit('", "n": '), F.col("n_chars").cast("string"), F.lit("\n}"))
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    results = t("documents").select((F.col("n_chars") >= 200).alias("ok"), name.alias("filename"), record.alias("extracted_json"))
    path = scratch_path(t.spark, "extractions")
    files.write_extractions(results, path, as_name="patient_name", as_record="json_record")
    return files.read_extractions(t.spark, path, "patient_name", "json_record")


@query("""
SELECT CAST(1000000 - map_index AS INT) AS list_order, CAST(map_index AS INT) AS map_index, map_index % 4 <> 0 AS found,
       CASE WHEN map_index % 4 <> 0 THEN lines || chr(10) ELSE '[MISSING LOG FILE]' END AS content
FROM (SELECT doc_id // 20 AS map_index, string_agg(text, chr(10) ORDER BY doc_id) AS lines FROM documents GROUP BY 1)
""")
def src_failed_logs(t):
    root = scratch_path(t.spark, "logs")
    # A log holds twenty documents; every fourth log is missing, and there is another attempt of each.
    index = F.expr("CAST(doc_id DIV 20 AS INT)").alias("map_index")
    documents = t("documents").groupBy(index).agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("all"))
    lines = documents.select("map_index", F.array_join(F.transform("all", lambda d: d["text"]), "\n").alias("text"))
    attempts = F.explode(F.array(F.lit("0.log"), F.lit("1.log"))).alias("attempt")
    written_logs = lines.filter("map_index % 4 <> 0").select("map_index", attempts, "text")
    folder = F.format_string("map_index=%d/attempt=%s", "map_index", "attempt").alias("folder")
    files.write_text_files(written_logs.select(folder, "text"), f"{root}/dag_id=d/run_id=manual_1/task_id=t")
    indices = lines.select((1_000_000 - F.col("map_index")).alias("list_order"), "map_index")
    return files.collect_failed_logs(t.spark, root, "d", "manual_1", "t", indices).select("list_order", "map_index", "found", "content")


@query("SELECT 36 + (c_custkey % 512) / 256 AS lon, -(c_custkey % 128) / 64 AS lat, c_name AS name FROM customer")
def src_geojson(t):
    root = scratch_path(t.spark, "places")
    lon, lat = 36 + (F.col("c_custkey") % 512) / 256, -(F.col("c_custkey") % 128) / 64
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct(F.col("c_name").alias("name")).alias("properties"),
    )
    # Files of one nation each and a bounded number of features, however many customers it has.
    feature_files(t("customer"), ["c_nationkey"], feature).write.option("maxRecordsPerFile", 1).text(root)
    return files.read_geojson_points(t.spark, root, ["name"])


def _count_characters(name: str, content: bytes) -> dict:
    text = content.decode("utf-8")
    if not text.strip():
        raise ValueError("empty document")
    return {"chars": len(text)}


@query("""
SELECT doc_id % 5 <> 0 AND NOT blank AS ok, doc_id || CASE WHEN doc_id % 5 = 0 THEN '.txt' ELSE '.pdf' END AS filename,
       CASE WHEN doc_id % 5 <> 0 AND NOT blank THEN '{"chars": ' || length(text) || '}' END AS extracted_json,
       CASE WHEN doc_id % 5 = 0 THEN 'unsupported file type: ' || doc_id || '.txt' WHEN blank THEN 'empty document' END AS error
FROM (SELECT *, NOT regexp_matches(text, '\\S') AS blank FROM documents)
""")
def doc_extract_dist(t):
    suffix = F.when(F.col("doc_id") % 5 == 0, ".txt").otherwise(".pdf")
    documents = spread(t("documents").select("doc_id", "text"))
    source = documents.select(
        F.concat(F.lit("file:/docs/"), F.col("doc_id").cast("string"), suffix).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return extract_documents(source, _count_characters)


# ---- whole tables

REGION_ROWS = [
    {"table": "region", "field": "r_regionkey", "type": "int(11)", "null": "YES", "key": ""},
    {"table": "region", "field": "r_name", "type": "varchar(20)", "null": "YES", "key": ""},
]


@query("SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey + 100, r_name FROM region")
def dml_replace(t):
    region = t("region").select("r_regionkey", "r_name")
    table = Table(t.spark, scratch_path(t.spark, "table"), region.schema).ensure()
    table.replace(region.withColumn("r_name", F.lit("old")))
    shifted = region.select((F.col("r_regionkey") + 100).alias("r_regionkey"), "r_name")
    return table.replace(region.unionByName(shifted)).read()


@query("""
SELECT CAST(s_suppkey AS DECIMAL(38,0)) AS s_suppkey, s_name, CAST(s_nationkey AS DECIMAL(38,0)) AS s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal,
       'decimal(38,0) string decimal(38,0) decimal(12,2) timestamp_ntz' AS types, CAST(0 AS BIGINT) AS rows_before FROM supplier
""")
def dml_create_typed(t):
    schema = schema_from_dictionary(SUPPLIER_ROWS)
    table = Table(t.spark, scratch_path(t.spark, "typed"), schema).ensure()
    before = table.read().agg(F.count("*").alias("rows_before"))
    stamp = F.lit("2024-01-01").cast("timestamp_ntz").alias("_ingested_at")
    filled = table.replace(t("supplier").select(*schema.names[:-1], stamp)).read()
    types = F.concat_ws(" ", *[F.typeof(F.col(f.name)) for f in filled.schema.fields])
    # The one-row side is what the table held when it was created.
    return filled.select(*schema.names[:-1], types.alias("types"), F.lit("x").alias("k")).join(before.withColumn("k", F.lit("x")), "k").drop("k")


@query("""
SELECT 'supplier' AS "table", CAST(s_suppkey AS DECIMAL(38,0)) AS key, s_name AS name FROM supplier
UNION ALL SELECT 'region', CAST(r_regionkey AS DECIMAL(38,0)), r_name FROM region
""")
def dml_load_all(t):
    root = scratch_path(t.spark, "sync")
    dictionary = SUPPLIER_ROWS + REGION_ROWS
    # Twice: the keyed table is merged onto itself, the other one replaced.
    # The keyed table's delivery holds every row twice.
    reader = lambda name: t(name).unionByName(t(name)) if name == "supplier" else t(name)
    for at in ("2024-01-01", "2024-01-02"):
        load_all_tables(t.spark, dictionary, reader, root, F.lit(at).cast("timestamp_ntz"))
    schemas = {name: schema_from_dictionary(rows) for name, rows in group_tables(dictionary).items()}
    supplier = Table(t.spark, f"{root}/supplier", schemas["supplier"]).read()
    region = Table(t.spark, f"{root}/region", schemas["region"]).read()
    return supplier.select(F.lit("supplier").alias("table"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).unionByName(
        region.select(F.lit("region").alias("table"), F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    )
