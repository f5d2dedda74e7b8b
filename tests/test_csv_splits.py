"""CSV files split over tasks against Spark's own whole-file reader."""

import random

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from assaymill.plans import catalog
from assaymill.session import scratch_path
from assaymill.sources import loads
from assaymill.sources.csv_splits import CORRUPT, csv_records, read_csv_splits
from assaymill.sources.tables import file_listing

SCHEMA = StructType(
    [StructField("id", LongType()), StructField("text", StringType()), StructField("n", IntegerType())]
)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def put(spark, path, *texts):
    """One file per text, byte for byte."""
    for i, text in enumerate(texts):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{i}.csv")
        out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
        out.write(text.encode())
        out.close()
    return path


def field(rng):
    kind = rng.randrange(6)
    text = "".join(rng.choice('ab ,"\n') for _ in range(rng.randrange(30)))
    if kind == 0:
        return "plain words"
    if kind == 1:
        return ""
    if kind == 2:
        text = "\n" * rng.randrange(60) + "é" * 20
    return '"' + text.replace('"', '""') + '"'


def content(df):
    return sorted(map(str, df.select("id", "text", "n", df[CORRUPT].isNotNull()).collect()))


@pytest.mark.parametrize("size, seed, end", [(37, 1, "\n"), (200, 2, "\n"), (64, 3, "\r\n"), (1 << 20, 4, "\n")])
def test_equal_to_the_whole_file_reader(spark, small_splits, size, seed, end):
    rng = random.Random(seed)
    texts = []
    for _ in range(3):
        rows = [f"{i},{field(rng)},{rng.choice(['7', 'x', ''])}" for i in range(60)]
        texts.append(end.join(["id,text,n", *rows]) + (end if rng.random() < 0.5 else ""))
    path = put(spark, scratch_path(spark, "csv"), *texts)
    whole = content(loads.read_csv(spark, path, SCHEMA))
    small_splits(size)
    split = read_csv_splits(spark, path, SCHEMA)
    assert content(split) == whole and len(whole) == 180
    if size < 100:
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 4


def test_a_record_over_many_blocks(spark, small_splits):
    long = "line, \"\"x\"\"\n" * 500
    path = put(spark, scratch_path(spark, "csv"), f'id,text,n\n1,a,1\n2,"{long}",2\n3,"b\n",3\n\n4,,4')
    small_splits(101)
    rows = {r.id: (r.text, r.n) for r in read_csv_splits(spark, path, SCHEMA).collect()}
    assert rows == {1: ("a", 1), 2: (long.replace('""', '"').strip(" "), 2), 3: ("b\n", 3), 4: (None, 4)}
    numbers = sorted(r.number for r in csv_records(spark, path).collect())
    assert numbers == [1, 2, 3, 4, 6]


def test_refused_files_and_rejects(spark, small_splits):
    small_splits(20)
    torn = put(spark, scratch_path(spark, "csv"), "id,text,n\n1,ok,1\n", 'id,text,n\n1,"never closed\n2,b,2\n')
    with pytest.raises(ValueError, match="odd number of quotes in .*1.csv"):
        read_csv_splits(spark, torn, SCHEMA)
    other = put(spark, scratch_path(spark, "csv"), "id,words,n\n1,ok,1\n")
    with pytest.raises(ValueError, match="words"):
        read_csv_splits(spark, other, SCHEMA)
    # Two torn quotes: the stretch between them is one record, which has too many fields.
    twice = put(spark, scratch_path(spark, "csv"), '﻿id,text,n\n1,"a,1\n2,b,2\n3,c",3\n4,d,4,5\n5,e,5\n')
    target = scratch_path(spark, "t")
    assert loads.load_csv(spark, twice, SCHEMA, target, ["id"], splits=True) == 1
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 5]
    empty = put(spark, scratch_path(spark, "csv"), "id,text,n\n", "")
    assert read_csv_splits(spark, empty, SCHEMA).collect() == []


def test_documents_become_csv_by_as_many_tasks_as_read_them(spark, monkeypatch):
    sf, files, load = scratch_path(spark, "sf"), [], loads.load_csv
    docs = spark.range(1, 41, 1, 6).selectExpr("id AS doc_id", "concat('t', id) AS text", "'en' AS lang")
    docs.write.parquet(f"{sf}/documents.parquet")

    def counted(spark, csv, *args, **options):
        files.append(file_listing(spark, csv, "*.csv").count())
        return load(spark, csv, *args, **options)

    monkeypatch.setattr(loads, "load_csv", counted)
    got = catalog.run("csv_documents", spark, sf).collect()
    assert files == [6]
    assert sorted(r.doc_id for r in got) == [i for i in range(1, 41) if i % 17]
