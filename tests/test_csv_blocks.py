"""CSV files over many tasks against Python's reader of whole files."""

import csv
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from carelake.sources import csv_blocks, files

WORDS = ["a", 'b "q" c', "x, y", "line 1\nline 2", "", "\n\n", '"', "ü", "end\r\nmore", "N/A"]


def cell(value):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in ',"\n\r') else value


@pytest.fixture
def folder(tmp_path):
    some = random.Random(1)
    for i, (mark, end) in enumerate((("", "\n"), ("\ufeff", "\r\n"))):
        with open(tmp_path / f"f {i}%20é.csv", "w", newline="", encoding="utf-8") as f:
            f.write(f'{mark}id,"na\nme",t{end}')
            for k in range(3000):
                f.write(f"{i * 10_000 + k},{cell(some.choice(WORDS))},{cell(some.choice(WORDS) + some.choice(WORDS))}{end}")
            if i == 0:
                f.write("\n\n7,last,x")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only.csv").write_text("t,z\n")
    (tmp_path / "blank.csv").write_text("\n\n")
    return tmp_path


@pytest.fixture(params=["128m", "3000"])
def split(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blocks_give_the_rows_of_the_whole_file(spark, folder, split):
    lines = csv_blocks.csv_lines(spark, str(folder), "*.csv")
    if split == "3000":
        blocks = lines.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0]
        assert blocks > 20 and lines.rdd.getNumPartitions() > 20
    want = []
    for name in ("f 0%20é.csv", "f 1%20é.csv"):
        with open(folder / name, newline="", encoding="utf-8-sig") as f:
            want += [tuple(c or None for c in row) for row in csv.reader(f) if row][1:]
    records = csv_blocks.csv_records(lines)
    got = records.where(~F.col("first")).select(csv_blocks.cells(F.col("record"), 3).alias("c")).collect()
    assert sorted((tuple(r.c) for r in got), key=repr) == sorted(want, key=repr)
    heads = {r.file: r.record for r in records.where("first").collect()}
    assert {unquote(f.rsplit("/", 1)[1]): h for f, h in heads.items()} == {"f 0%20é.csv": 'id,"na\nme",t', "f 1%20é.csv": 'id,"na\nme",t', "only.csv": "t,z"}
    paths = spark.read.format("binaryFile").load(str(folder)).select(F.col("_metadata.file_path").alias("path"))
    assert {r.file: r.header for r in csv_blocks.csv_headers(paths).collect()} == heads


@pytest.mark.parametrize("open_files", [True, False])
def test_union_over_blocks(spark, folder, split, open_files):
    out = files.union_csv_folder(spark, str(folder), open_files)
    assert dict(out.dtypes) == {"id": "bigint", "na\nme": "string", "t": "string", "z": "string"}
    assert out.count() == 6001 and out.where("id = 7").count() == 2


def test_only_the_head_is_read(tmp_path):
    path = tmp_path / "long.csv"
    with open(path, "wb") as f:
        f.write(b'\xef\xbb\xbf\n\r\n"a ""b""\nc",d\r\n1,2\n')
        f.truncate(1 << 40)  # a sparse file no reader gets to the end of
    assert csv_blocks.first_record(str(path)) == csv_blocks.first_record(f"file://{path}") == '"a ""b""\nc",d'
    (tmp_path / "open.csv").write_text('a,"b\nc')
    assert csv_blocks.first_record(str(tmp_path / "open.csv")) == 'a,"b\nc'
    (tmp_path / "none.csv").write_text("\n \r\n")
    assert csv_blocks.first_record(str(tmp_path / "none.csv")) is None


def test_a_column_twice_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,a\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        files.union_csv_folder(spark, str(tmp_path))
