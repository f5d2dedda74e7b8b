"""CSV loads take quoted text with breaks, quotes and commas by default."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assaymill.session import scratch_path
from assaymill.sources import loads


def test_document_texts_load_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.trim("text").alias("text"), "lang")
    extra = spark.createDataFrame([(-1, 'good\nvery "good", a,b\n\n"', "en")], docs.schema)
    docs = docs.where("text <> ''").unionByName(extra)
    csv, target = scratch_path(spark, "csv"), scratch_path(spark, "documents")
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(csv)
    assert loads.load_csv(spark, csv, docs.schema, target, ["doc_id"]) == 0
    assert sorted(map(tuple, spark.read.parquet(target).select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))


def test_rejects_are_counted_and_open_quotes_refused(spark):
    schema = StructType.fromDDL("id long, text string")
    csv, target = scratch_path(spark, "csv"), scratch_path(spark, "t")
    lines = ["id,text", '1,"a\nb"', "x,bad", "3,c"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(csv)
    assert loads.load_csv(spark, csv, schema, target, ["id"]) == 1
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a\nb"), (3, "c")]
    torn = scratch_path(spark, "csv")
    spark.createDataFrame([("\n".join([*lines, '4,"open', "5,d"]),)], "value string").coalesce(1).write.text(torn)
    with pytest.raises(ValueError, match="quotes"):
        loads.load_csv(spark, torn, schema, target, ["id"])
