"""Readers and writers over files in a temporary folder."""

import datetime as dt
import gzip
import json
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.dictionary import dictionary_models, group_tables, primary_key, schema_from_dictionary, spark_type
from carelake.operators.sheet import normalize_headers
from carelake.operators.variant import flatten_api_pages, source_slice, variant_project
from carelake.plans.clean import clean_source, empty_clean, merge_clean
from carelake.plans.market import project
from carelake.schemas import RAW_EVENTS, struct
from carelake.session import scratch_dir
from carelake.sources import files, geojson_blocks, jdbc, landing
from carelake.sources.sync import TablesFailed, load_all_tables
from carelake.sources.tables import Table, open_table
from conftest import rows


def test_scratch_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark) == configured.rstrip("/") if configured else scratch_dir(spark)


def landed(spark, root, run="run:1", table="a b"):
    df = spark.createDataFrame(
        [("f1", "Core", table, r"Ignite\Core\Entities\A", "2024-01-02", '{"id":"1"}'), ("f2", "", table, "N", "2024-01-03", "[1"),
         ("f1", "Core", table, r"Ignite\Core\Entities\A", "2024-01-02", '{"id":"2","_airflow_meta":{"facility":"meta","row_hash":"h","ingested_at":"2024-01-02T03:04:05Z"}}')],
        "facility_id string, module string, table string, namespace string, dt string, line string",
    )
    landing.write_raw_landing(df, root, run)


def test_landing_round_trip(spark, tmp_path):
    root = str(tmp_path / "raw")
    landed(spark, root)
    landed(spark, root)
    folders = {p.relative_to(root).parts for p in (tmp_path / "raw").rglob("run_id=*")}
    assert ("facility_id=f1", "module=Core", "table=a_b", "namespace=Ignite_Core_Entities_A", "dt=2024-01-02", "run_id=run_1") in folders
    assert any("module=unknown" in f for f in folders)
    (first, *_) = (tmp_path / "raw").rglob("*.gz")
    gzip.open(first).read()
    raw = landing.read_raw_landing(spark, root)
    got = {r.facility_id: r for r in raw.collect()}
    assert set(got) == {"f1", "meta"} and raw.count() == 2
    assert got["f1"].execution_date == dt.date(2024, 1, 2) and got["f1"]._file_name.endswith(".gz")
    assert got["meta"].row_hash == "h" and got["meta"].ingested_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    bad = landing.read_raw_landing(spark, root, "quarantine").collect()
    assert [(r.value, r.reason) for r in bad] == [("[1", "not_json")]
    with pytest.raises(Exception, match="not_json"):
        landing.read_raw_landing(spark, root, "abort").collect()
    landed(spark, root, "run:2")
    assert landing.read_raw_landing(spark, root).count() == 4
    assert source_slice(raw, "a_b").count() == 2


def test_landing_prunes_folders(spark, tmp_path):
    root = str(tmp_path / "raw")
    landed(spark, root)
    plan = spark.read.text(root).filter("dt = '2024-01-03' and facility_id = 'f2'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_external_and_archive(spark, tmp_path):
    root = tmp_path / "ext"
    landed(spark, str(root / "archive"))
    landing.register_external(spark, str(root), "archived_events", archive=True)
    assert spark.sql("select count(*) from archived_events").head()[0] == 2


def test_api_pages(spark):
    pages = ['{"data":[{"id":1},{"id":2}]}', '{"success":{"data":[{"id":3}]}}', '{"data":{"data":[{"id":4}]}}', '{"data":null,"success":{"data":{"data":[{"id":5}]}}}',
             '{"data":"x"}', '{"success":"no"}', "{}", '{"data":{"rows":[]}}', '{"data":[]}']
    df = spark.createDataFrame([(p,) for p in pages], "p string").select(F.parse_json("p").alias("page"))
    assert [r[0] for r in rows(flatten_api_pages(df).select(F.to_json("payload")))] == [f'{{"id":{i}}}' for i in range(1, 6)]


def test_csv_union(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,a\n1,a\n2,b\n")
    (tmp_path / "b.csv").write_text('y,z\n"b, c",3\n')
    (tmp_path / "c.csv").write_text("x,y\n1,a\nq,c\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("x\n9\n")
    out = files.union_csv_folder(spark, str(tmp_path))
    assert sorted(out.columns) == ["x", "y", "z"]
    assert rows(out, "x", "y", "z") == sorted([("1", "a", None), ("2", "b", None), (None, "b, c", 3), ("q", "c", None)], key=repr)
    assert dict(out.dtypes) == {"x": "string", "y": "string", "z": "bigint"}
    with pytest.raises(FileNotFoundError):
        files.union_csv_folder(spark, str(tmp_path / "none") if (tmp_path / "none").mkdir() is None else "")


def test_csv_typed(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,on\n1,"a, b",2024-01-02\nNULL,nan,\nx,c,2024-01-02\n2,d\n3,NaN,2024-01-03\n')
    schema = T.StructType.fromDDL("id int, name string, on date")
    got = rows(files.read_csv_typed(spark, str(path), schema))
    assert got == sorted([(1, "a, b", dt.date(2024, 1, 2)), (None, None, None), (3, None, dt.date(2024, 1, 3))], key=repr)
    with pytest.raises(Exception, match="unreadable CSV row"):
        files.read_csv_typed(spark, str(path), schema, on_error="abort").collect()
    path.write_text("id,name,on\n1,a,2024-01-02\n")
    assert files.read_csv_typed(spark, str(path), schema, on_error="abort").count() == 1


def test_snapshots_and_extractions(spark, tmp_path):
    df = spark.createDataFrame([(1, "2.5"), (2, None)], "id int, price string")
    files.write_snapshot(df, str(tmp_path), "1700000000", csv_copy=True)
    files.write_snapshot(df, str(tmp_path), "1700000001")
    read = files.read_parquet_snapshots(spark, f"{tmp_path}/snapshot_*.parquet", {"id": "bigint", "price": "double"})
    assert read.count() == 4 and dict(read.dtypes) == {"id": "bigint", "price": "double"}
    assert (tmp_path / "snapshot_1700000000.csv").exists()
    results = spark.createDataFrame([(True, "a", '{"k":"v, \\"w\\""}'), (False, "b", None)], "ok boolean, filename string, extracted_json string")
    files.write_extractions(results, str(tmp_path / "out"), as_name="patient_name", as_record="json_record")
    back = spark.read.options(header=True, escape='"').csv(str(tmp_path / "out"))
    assert rows(back, "patient_name", "json_record") == [("a", '{"k":"v, \\"w\\""}')]


def test_json_batches(spark, tmp_path):
    out = tmp_path / "batches"
    files.write_json_batches(spark.range(250).coalesce(1), str(out))
    assert len(list(out.glob("*.json"))) == 3
    assert files.read_json_batches(spark, str(out), "id bigint").count() == 250
    (tmp_path / "all.json").write_text(json.dumps([{"id": 1}, {"id": 2}], indent=2))
    assert files.read_json_batches(spark, str(tmp_path / "all.json"), "id bigint", array_files=True).count() == 2


def test_file_lists_and_texts(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name, text in [("a.doc", "1"), ("~$a.doc", "x"), ("deep/b.doc", "22"), ("c.txt", "line 1\nline 2\n")]:
        (tmp_path / name).write_text(text)
    listed = files.list_files(spark, str(tmp_path), ".doc")
    assert sorted(r.path.rsplit("/", 1)[1] for r in listed.collect()) == ["a.doc", "b.doc"]
    assert "content" not in listed.columns
    assert rows(files.read_text_docs(spark, str(tmp_path), ".txt"), "filename", "text") == [("c.txt", "line 1\nline 2\n")]


def test_failed_logs(spark, tmp_path):
    task = tmp_path / "dag_id=d" / "run_id=manual:1" / "task_id=t"
    for index, attempt in [(3, 1), (10, 1), (10, 2)]:
        folder = task / f"map_index={index}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"attempt={attempt}.log").write_text(f"log {index}/{attempt}\nmore")
    wanted = spark.createDataFrame([(0, 10), (1, 7), (2, 3)], "list_order int, map_index int")
    got = files.collect_failed_logs(spark, str(tmp_path), "d", "manual\uf03a1", "t", wanted).orderBy("list_order").collect()
    assert [(r.map_index, r.found, r.content) for r in got] == [
        (10, True, "log 10/1\nmore"), (7, False, "[MISSING LOG FILE]"), (3, True, "log 3/1\nmore")]
    assert got[0].path.endswith("run_id=manual:1/task_id=t/map_index=10/attempt=1.log")
    none = files.collect_failed_logs(spark, str(tmp_path), "d", "other", "t", wanted).collect()
    assert len(none) == 3 and not any(r.found for r in none)


def test_geojson(spark, tmp_path):
    feature = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [36.8, -1.29]}, "properties": {"name": "Gym", "n": 1}}
    line = {"type": "Feature", "geometry": None, "properties": {}}
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, line]}, indent=1))
    points = files.read_geojson_points(spark, str(tmp_path / "p.geojson"), ["name"], others="skip")
    assert rows(points) == [(36.8, -1.29, "Gym")]
    assert project(points).filter("x between 200000 and 300000 and y between 9800000 and 9900000").count() == 1


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split", ["128m", "1500"])
def test_large_geojson_is_read_by_several_tasks(spark, tmp_path, indent, split):
    names = ["plain", 'a "quoted" {', "}", "\\\\", '\\"}{"', "{[]}", "\n}", "é", ""]
    features = [
        {"type": "Feature", "properties": {"name": names[i % len(names)] + str(i), "inner": {"a": {"b": i}}}, "geometry": {"type": "Point", "coordinates": [i / 8, -i / 4]}}
        for i in range(600)
    ]
    head = {"type": "FeatureCollection", "name": "x{\"}", "crs": {"type": "name", "properties": {"name": "urn}"}}}
    texts = {"a": json.dumps(head | {"features": features}, indent=indent), "b": json.dumps({"features": features[:3], **head}, indent=indent), "none": json.dumps({"features": []})}
    for name, text in texts.items():
        (tmp_path / f"{name}.geojson").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pieces = geojson_blocks.pieces(spark, str(tmp_path))
        if split == "1500":
            assert pieces.rdd.getNumPartitions() > 20
        points = files.read_geojson_points(spark, str(tmp_path), ["name", "inner"])
        want = [(f["geometry"]["coordinates"][0], f["geometry"]["coordinates"][1], f["properties"]["name"], json.dumps(f["properties"]["inner"])) for f in features + features[:3]]
        assert sorted((r.lon, r.lat, r.name, json.dumps(json.loads(r.inner))) for r in points.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_feature_files_are_bounded(spark):
    places = spark.range(5000).selectExpr("if(id % 3 = 0, 0, id % 7) as nation", "id")
    files_of = geojson_blocks.feature_files(places, ["nation"], F.struct(F.lit("Feature").alias("type"), "id"), per_file=100)
    sizes = files_of.select(F.size(F.from_json("value", "features array<struct<id:bigint>>").getField("features")).alias("n")).collect()
    assert sum(r.n for r in sizes) == 5000 and max(r.n for r in sizes) < 200 and len(sizes) > 40


def test_jdbc_options():
    # No database may run here, not even inside this process: the options are what is checked.
    plain = jdbc.jdbc_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "50000"}
    split = jdbc.jdbc_options("jdbc:x", "t", "id", (0, 100), 8, user="u")
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"], split["user"]) == ("id", "0", "100", "8", "u")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "id")


def test_incremental_filter_is_pushed(spark, inputs):
    df = files.incremental_filter(inputs("events"), "ts", "2024-01-31 00:00:00").select("event_id")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-30T00:00)]" in df._jdf.queryExecution().toString()


# ---- dictionary

DICTIONARY = [
    {" Module ": "core", "TABLE": "people", "field": "id", "type": "bigint(20)", "null": "NO", "key": "PRI"},
    {" Module ": "core", "TABLE": "people", "field": "name", "type": "varchar(9)", "null": "YES", "key": None},
    {" Module ": "core", "TABLE": "people", "field": "born", "type": "date", "null": "YES", "key": ""},
    {" Module ": "core", "TABLE": "visits", "field": "at", "type": "datetime", "null": "YES", "key": ""},
    {" Module ": "core", "TABLE": "broken", "field": "x", "type": "int", "null": "YES", "key": ""},
]


@pytest.mark.parametrize(
    "mysql, spark_name",
    [("tinyint(1)", "decimal(38,0)"), ("point", "decimal(38,0)"), ("char(3)", "string"), ("decimal(10,2)", "decimal(10,2)"),
     ("double", "double"), ("timestamp", "timestamp_ntz"), ("date", "date"), ("boolean", "boolean"), ("longtext", "string"), ("json", "string")],
)
def test_type_map(mysql, spark_name):
    assert spark_type(mysql).simpleString() == spark_name


def test_strict_numbers():
    assert spark_type("decimal(10,2)", strict_numbers=True).simpleString() == "decimal(38,0)"


def test_dictionary_schema():
    tables = group_tables(DICTIONARY)
    assert list(tables) == ["broken", "people", "visits"] and primary_key(tables["people"]) == ["id"]
    schema = schema_from_dictionary(tables["people"])
    assert schema.simpleString() == "struct<id:decimal(38,0),name:string,born:date,_ingested_at:timestamp_ntz>"
    assert [f.nullable for f in schema.fields] == [False, True, True, True]


def test_dictionary_models(spark):
    df = spark.createDataFrame([(1, "Core", "core_a"), (2, " core ", "CORE_A"), (3, "", "x"), (4, "m", " ")], "n int, module string, table string")
    assert rows(dictionary_models(df, "n"), "n", "namespace") == [(1, r"Ignite\Core\Entities\A")]


def test_load_all_tables(spark, tmp_path):
    people = {"now": [(1, "a", "2000-01-01"), (2, "b", "bad date")]}

    def reader(name):
        if name == "people":
            return spark.createDataFrame(people["now"], "ID int, NAME string, BORN string")
        if name == "visits":
            return spark.createDataFrame([("2024-01-01 00:00:00",)], "at string")
        raise IOError("source is gone")

    def load(at):
        with pytest.raises(TablesFailed, match="broken") as failure:
            load_all_tables(spark, DICTIONARY, reader, str(tmp_path), F.lit(at).cast("timestamp_ntz"))
        assert list(failure.value.failed) == ["broken"]

    load("2024-01-01")
    people["now"] = [(2, "B", "2000-01-02"), (3, "c", None)]
    load("2024-01-02")
    table = Table(spark, f"{tmp_path}/people", schema_from_dictionary(group_tables(DICTIONARY)["people"]))
    assert [(int(r[0]), r[1], r[2], r[3].day) for r in rows(table.read())] == [
        (1, "a", dt.date(2000, 1, 1), 1), (2, "B", dt.date(2000, 1, 2), 2), (3, "c", None, 2)]
    visits = Table(spark, f"{tmp_path}/visits", schema_from_dictionary(group_tables(DICTIONARY)["visits"]))
    assert visits.read().count() == 1


def test_table_versions(spark, tmp_path):
    schema = T.StructType.fromDDL("k string, v int")
    table = Table(spark, str(tmp_path / "t"), schema, sort_by=["v"])
    assert table.read().count() == 0 and table.versions() == []
    table.ensure()
    for i in range(4):
        table.merge(spark.createDataFrame([("a", i), (f"b{i}", i)], schema), ["k"], ["v"])
    assert table.versions() == [4, 5] and table.read().columns == ["k", "v"]
    assert rows(table.read()) == [("a", 3), ("b0", 0), ("b1", 1), ("b2", 2), ("b3", 3)]
    # A write without its commit marker does not count.
    (tmp_path / "t" / "__version=00000009").mkdir()
    assert table.versions() == [4, 5] and table.read().count() == 5


def test_lake_tables_keep_layout_and_variants(spark, tmp_path):
    root = str(tmp_path / "raw")
    landed(spark, root)
    rows_now = landing.raw_events(landing.read_raw_landing(spark, root), "tests", "2024-01-05 00:00:00")
    table = open_table(spark, str(tmp_path / "lake"), "raw_events").replace(rows_now)
    back = table.read()
    assert back.schema == struct(RAW_EVENTS) and back.count() == 2
    assert {r[0] for r in back.select(F.try_variant_get("payload", "$.id", "string")).collect()} == {"1", "2"}
    assert back.select("event_id").distinct().count() == 2
    assert list((tmp_path / "lake" / "raw_events").glob("facility_id=f1/execution_date=2024-01-02/*.parquet"))
    clean = merge_clean(empty_clean(spark), clean_source(back.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))), F.lit("2024-01-06").cast("timestamp_ntz"))
    assert open_table(spark, str(tmp_path / "lake"), "clean_events").replace(clean).read().count() == 2


def test_headers(spark):
    assert normalize_headers(spark.range(1).toDF(" Total Bill ")).columns == ["total_bill"]


def test_landed_names_stay_text(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([("007", "m", "1e3", "n", "2024-01-02", '[{"id":"1"},{"id":"2"}]'), ("7", "m", "0", "n", "2024-01-02", ' [] ')],
                               "facility_id string, module string, table string, namespace string, dt string, line string")
    landing.write_raw_landing(df, root, "08")
    raw = landing.read_raw_landing(spark, root)
    assert rows(raw, "facility_id", "source_table", F.try_variant_get("payload", "$.id", "string")) == [("007", "1e3", "1"), ("007", "1e3", "2")]
    assert raw.schema["facility_id"].dataType == T.StringType()


def test_large_landed_lines_are_kept_or_named(spark, tmp_path):
    root = tmp_path / "raw" / "facility_id=f" / "module=m" / "table=t" / "namespace=n" / "dt=2024-01-02" / "run_id=1"
    root.mkdir(parents=True)
    record = '{"id":"%d","x":"' + "y" * 1_000_000 + '"}'
    (root / "array.txt").write_text("[" + ",".join(record % i for i in range(140)) + ']\n{"id":"small"}\n')
    raw = landing.read_raw_landing(spark, str(tmp_path / "raw"))
    assert raw.select(F.try_variant_get("payload", "$.id", "string").alias("id")).distinct().count() == 141
    (root / "one.txt").write_text('{"x":"' + "y" * 140_000_000 + '"}\n')
    bad = landing.read_raw_landing(spark, str(tmp_path / "raw"), "quarantine").select("reason", F.length("value")).collect()
    assert [tuple(r) for r in bad] == [("too_large", 140_000_008)]
    with pytest.raises(Exception, match="too_large"):
        landing.read_raw_landing(spark, str(tmp_path / "raw")).count()


def test_csv_types_breaks_and_missing_words(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t,b\n1,"line 1\nline ""2""",true\n2,N/A,False\n')
    (tmp_path / "b.csv").write_text("b,n,big\nTRUE,1.0,99999999999999999999\n,2.5,NA\n,NULL,None\n")
    out = files.union_csv_folder(spark, str(tmp_path))
    assert dict(out.dtypes) == {"n": "double", "t": "string", "b": "boolean", "big": "decimal(38,0)"}
    assert rows(out, "n", "t", "b", "big") == sorted(
        [(1.0, 'line 1\nline "2"', True, None), (2.0, None, False, None), (1.0, None, True, Decimal(99999999999999999999)), (2.5, None, None, None), (None, None, None, None)], key=repr
    )
    schema = T.StructType.fromDDL("n int, t string, b boolean")
    assert rows(files.read_csv_typed(spark, str(tmp_path / "a.csv"), schema, files.MISSING_WORDS)) == sorted([(1, 'line 1\nline "2"', True), (2, None, False)], key=repr)


def test_csv_long_whole_numbers_keep_their_digits(spark, tmp_path):
    ids = [1234567890123456781, 1234567890123456782]
    rows_of = [f"{i},{i}0,{i}{'0' * 25},x" for i in ids]
    (tmp_path / "a.csv").write_text("\n".join(["id,longer,longest,same", *rows_of, rows_of[0]]) + "\n")
    out = files.union_csv_folder(spark, str(tmp_path))
    assert dict(out.dtypes) == {"id": "bigint", "longer": "decimal(38,0)", "longest": "string", "same": "string"}
    assert [(r.id, int(r.longer), r.longest) for r in out.orderBy("id").collect()] == [(i, i * 10, f"{i}{'0' * 25}") for i in ids]


def test_extractions_keep_line_breaks(spark, tmp_path):
    record = json.dumps({"a": [1, 2], "b": 'x, "y"'}, indent=2)
    results = spark.createDataFrame([(True, "a\nb.pdf", record)], "ok boolean, filename string, extracted_json string")
    files.write_extractions(results, str(tmp_path / "out"))
    assert rows(files.read_extractions(spark, str(tmp_path / "out"))) == [("a\nb.pdf", record)]


def test_partition_merge_writes_touched_partitions_only(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, v string, day date, place string")
    table = Table(spark, str(tmp_path / "t"), schema, ["place", "day"], ["id"])
    day = lambda d: dt.date(2024, 1, d)
    table.replace(spark.createDataFrame([(1, "a", day(1), "x"), (2, "b", day(1), "x"), (3, "c", day(2), "y/z"), (4, "d", None, None)], schema))
    files_of = lambda: {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    before = files_of()
    # One row stays in its partition, one moves to another day, one is new; the rest is not touched.
    source = spark.createDataFrame([(1, "A", day(1), "x"), (2, "B", day(5), "x"), (9, "N", day(6), "w")], schema)
    table.merge(source, ["id"], ["v", "day"])
    want = [(1, "A", day(1), "x"), (2, "B", day(5), "x"), (3, "c", day(2), "y/z"), (4, "d", None, None), (9, "N", day(6), "w")]
    assert rows(table.read()) == sorted(want, key=repr)
    after = files_of()
    assert all(after[p] == t for p, t in before.items() if "place=x" not in str(p))
    assert {p.parts[1] + "/" + p.parts[2] for p in set(after) - set(before)} == {"place=x/day=2024-01-01", "place=x/day=2024-01-05", "place=w/day=2024-01-06"}
    for n in range(3):
        table.merge(spark.createDataFrame([(1, f"A{n}", day(1), "x")], schema), ["id"], ["v"])
    left = files_of()
    assert {p for p in left if "day=2024-01-02" in str(p)} == {p for p in before if "day=2024-01-02" in str(p)}
    assert rows(table.read()) == sorted([(1, "A2", day(1), "x"), *want[1:]], key=repr)
    # A merge that moves the last row of a partition leaves the partition out.
    table.merge(spark.createDataFrame([(9, "N", day(5), "x")], schema), ["id"], ["day", "place"])
    assert table.read().filter("place = 'w'").count() == 0 and table.read().count() == 5
    assert table.replace(table.read().limit(0)).read().count() == 0


def test_scratch_goes_with_its_block_and_the_session(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(__import__('conftest').ROOT)!r})
from pathlib import Path
from carelake.session import get_session, scratch, written
spark = get_session("s", "local[2]", **({{"spark__checkpoint__dir": "file:{tmp_path}/shared"}}))
shared = Path("{tmp_path}/shared")
with scratch(spark):
    kept = written(written(spark.range(3), "inner"), "outer", outer=True)
    assert len(list(shared.glob("carelake-*"))) == 2
assert len(list(shared.glob("carelake-*"))) == 1 and kept.count() == 3
written(spark.range(5), "loose")
assert len(list(shared.glob("carelake-*"))) == 2
"""
    import subprocess
    import sys

    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert not list((tmp_path / "shared").glob("carelake-*"))


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from carelake import session

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master, applicationId = "yarn", "app"

    with pytest.raises(ValueError, match="shared|share"):
        session.scratch_dir(Cluster)


def test_stored_payloads_are_shredded_and_paths_read_alone(spark, tmp_path):
    line = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit("pay").alias("type"), F.sha2(F.col("id").cast("string"), 512).alias("blob")))
    spark.range(20_000).select("id", F.parse_json(line).alias("payload")).coalesce(1).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    typed = variant_project(raw, {"key": ("id", "string"), "kind": ("type", "string")})
    # The scan gives two fields of the payload, never the whole value.
    assert "ReadSchema: struct<payload:struct<0:string,1:string>>" in typed._jdf.queryExecution().executedPlan().toString()
    assert rows(typed.limit(1)) == [("0", "pay")]
    (part,) = (tmp_path / "raw").glob("part-*.parquet")
    group = pq.ParquetFile(part).metadata.row_group(0)
    size = {group.column(i).path_in_schema: group.column(i).total_compressed_size for i in range(group.num_columns)}
    read = sum(n for name, n in size.items() if name.startswith(("payload.typed_value.id.", "payload.typed_value.type.")))
    assert 0 < 10 * read < sum(n for name, n in size.items() if name.startswith("payload"))


def test_document_files_are_gathered_in_a_bounded_number_of_folders(spark, tmp_path):
    from carelake.registry.files import document_files
    from carelake.sources.files import list_files, read_text_docs

    docs = spark.createDataFrame([(i, f"ü{i}\nb") for i in range(300)] + [(7, None)], "doc_id long, text string").coalesce(1)
    document_files(docs, str(tmp_path / "tree"))
    tops = [p for p in (tmp_path / "tree").iterdir()]
    assert 1 < len(tops) <= 256 and all(p.is_dir() for p in tops)
    assert all(p.suffix == ".txt" for p in (tmp_path / "tree").rglob("*") if p.is_file())
    texts = {}
    for r in read_text_docs(spark, str(tmp_path / "tree")).collect():
        texts.setdefault(r.path.split("/")[-2], []).append(r.text)
    assert {k: "".join(sorted(v)) for k, v in texts.items() if k != "doc_id=7"} == {f"doc_id={i}": f"ü{i}\nb\n" for i in range(300) if i != 7}
    assert sorted("".join(texts["doc_id=7"])) == sorted("ü7\nb\n\n")
    assert sum(r.length for r in list_files(spark, str(tmp_path / "tree"), ".txt").collect()) == sum(len(f"ü{i}\nb\n".encode()) for i in range(300)) + 1


def test_text_files_of_no_rows_and_of_special_folders(spark, tmp_path):
    from carelake.sources.files import read_text_docs, write_text_files

    write_text_files(spark.createDataFrame([], "folder string, text string"), str(tmp_path / "none"))
    assert read_text_docs(spark, str(tmp_path / "none")).count() == 0
    root = tmp_path / "a b%20c"
    write_text_files(spark.createDataFrame([("x/y", "1"), ("x/y", "2")], "folder string, text string").coalesce(1), str(root))
    assert [p.read_text() for p in root.rglob("*.txt")] == ["1\n2\n"]


def test_json_batches_are_written_in_place(spark, tmp_path):
    from carelake.sources.files import read_json_batches, write_json_batches

    rows = spark.createDataFrame([(i, None if i % 3 else "é\n", float(i)) for i in range(25)], "id long, `a.b` string, x double").coalesce(1)
    path = tmp_path / "batches"
    for _ in range(2):  # the second write replaces the first
        write_json_batches(rows, str(path), 10)
    found = sorted(path.iterdir())
    assert [p.suffix for p in found] == [".json"] * 3  # nothing left by a commit
    assert [len(p.read_text().splitlines()) for p in found] == [10, 10, 5]
    assert sorted(map(tuple, read_json_batches(spark, str(path), rows.schema).collect())) == sorted(map(tuple, rows.collect()))
    write_json_batches(rows.limit(0), str(path))
    assert read_json_batches(spark, str(path), rows.schema).count() == 0


def test_index_semi_reads_the_logs_once(spark):
    from carelake import registry
    from conftest import SF_DIR

    plan = registry.queries()["join_index_semi"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Join ") == 1 and plan.count("Relation") == 2


def odd_tree(root):
    """A tree of files with names that a listing may get wrong; returns how many of its .txt files are read."""
    seen = [f"t{i}/u{j}/v{k}.txt" for i in range(9) for j in range(3) for k in range(4)]
    seen += ["a b%20#é.txt", 'q"[x]{y}|^`\\.txt', "nl\n  .txt", "_x=1/_y=2.txt", "_metadata/z.txt"]
    for name in [*seen, ".dot.txt", "_hidden.txt", "_d/f.txt", ".h/f.txt", "x._COPYING_/f.txt", "g.txt._COPYING_", "other.html", "CASE.TXT"]:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"\xef\xbb\xbf\xffa\r\n" + name.encode())
    (root / "empty.txt").write_text("")
    (root / "none").mkdir()
    (root / "to_file.txt").symlink_to(root / "other.html")
    (root / "to_folder").symlink_to(root / "t0")
    (root / "to_nothing.txt").symlink_to(root / "missing")
    (root / "packed.txt.gz").write_bytes(gzip.compress(b"unpacked"))
    return len(seen) + 1 + 12


@pytest.fixture(params=[None, 2])
def most_listed(request, monkeypatch):
    """The ordinary sizes, and some at which each task passes on nearly every folder."""
    if request.param:
        monkeypatch.setattr(files, "LISTED_AT_ONCE", (request.param, 1))
        monkeypatch.setattr(files, "LISTED_ALONE", (1, 0))


def test_texts_are_listed_and_read_by_tasks(spark, tmp_path, most_listed):
    root = tmp_path / "r t%41"
    number = odd_tree(root)
    texts = files.read_text_docs(spark, str(root), ".txt")
    # Neither a list of the documents in the driver nor a task for every few of them.
    assert not any(f.endswith(".txt") for f in texts.inputFiles()) and texts.rdd.getNumPartitions() <= 16

    def by_spark(path, suffix):
        found = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").text(path, wholetext=True)
        return rows(found, F.col("_metadata.file_path"), F.col("_metadata.file_name"), F.hex("value"))

    assert rows(texts, "path", "filename", F.hex("text")) == by_spark(str(root), ".txt") and texts.count() == number
    for path, suffix in [("t[1-3]", ".txt"), ("*.txt", ".txt"), ("_d", ".txt"), ("none", ".txt"), ("other.html", ".txt"), (".", ".txt.gz"), ("t1", "{0,1}.txt")]:
        assert rows(files.read_text_docs(spark, f"{tmp_path}/r*/{path}", suffix), "path", "filename", F.hex("text")) == by_spark(f"{tmp_path}/r*/{path}", suffix)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_text_docs(spark, str(tmp_path / "missing"))


def test_files_are_listed_by_tasks(spark, tmp_path, most_listed):
    root = tmp_path / "r t%41"
    number = odd_tree(root)
    (root / "t1" / "~$a.txt").write_text("x")
    listed = files.list_files(spark, str(root), ".txt")
    # The driver holds no list of the files.
    assert not any(f.endswith(".txt") for f in listed.inputFiles())

    def by_spark(path, suffix):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path).where("path not like '%~$%'")
        return rows(found, "path", "length", "modificationTime")

    assert rows(listed, "path", "length", "modificationTime") == by_spark(str(root), ".txt") and listed.count() == number
    assert dict(listed.dtypes) == {"path": "string", "length": "bigint", "modificationTime": "timestamp"}
    for path, suffix in [("t[1-3]", ".txt"), ("*.txt", ".txt"), ("_d", ".txt"), ("none", ".txt"), ("other.html", ".txt"), (".", ".{html,gz}"), (".", "")]:
        assert rows(files.list_files(spark, f"{tmp_path}/r*/{path}", suffix), "path", "length", "modificationTime") == by_spark(f"{tmp_path}/r*/{path}", suffix)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.list_files(spark, str(tmp_path / "missing"), ".txt")


def test_texts_of_a_store_that_only_spark_reads(spark, tmp_path):
    number = odd_tree(tmp_path / "in")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.texts.link./in", f"file://{tmp_path}/in")
    assert files.read_text_docs(spark, "viewfs://texts/in").count() == files.list_files(spark, "viewfs://texts/in", ".txt").count() == number


def test_documents_named_by_their_files(spark, tmp_path):
    from carelake.registry.files import document_files

    docs = spark.createDataFrame([(7, "a"), (7, None), (8, "ü\nb"), (None, "c")], "doc_id long, text string").repartition(3)
    document_files(docs, str(tmp_path / "tree"), own_folder=False)
    found = [p for p in (tmp_path / "tree").rglob("*") if p.is_file()]
    assert all(p.name.startswith("doc_id=") and p.parent.name.startswith("near=") and p.parent.parent.name == "tree" for p in found)
    texts = {}
    for r in files.read_text_docs(spark, str(tmp_path / "tree")).collect():
        texts.setdefault(r.filename.split("-")[0], []).append(r.text)
    assert {k: sorted("".join(v)) for k, v in texts.items()} == {"doc_id=7": sorted("a\n\n"), "doc_id=8": sorted("ü\nb\n"), "doc_id=__HIVE_DEFAULT_PARTITION__": sorted("c\n")}
