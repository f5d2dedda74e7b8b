"""Raw-layer validation: files, row counts, schema drift, schema registry."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaymill.session import literal_rows
from assaymill.sources.loads import MISSING, read_if_exists
from assaymill.sources.schema_groups import SchemaGroup, read_groups, schema_groups, type_variants
from assaymill.sources.schemas import TOOL_COLUMN_PREFIX, RawTable, types_compatible
from assaymill.sources.tables import file_listing

DRIFT_DDL = "table_name string, column_name string, change string, expected string, actual string"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def observed_schema(tables: dict[str, DataFrame], non_null: bool = False) -> DataFrame:
    """``(table, position, column, type)`` per column with the table's row count.

    Parquet footers answer that much. ``non_null`` adds the values present per column, in one
    pass that reads every column.
    """
    parts = []
    for name, df in tables.items():
        fields = list(enumerate(df.schema.fields))
        present = [F.count(F.col(f.name)).alias(f"_c{i}") for i, f in fields] if non_null else []
        stats = df.agg(F.count(F.lit(1)).alias("_rows"), *present)
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("row_count"),
                *([F.col(f"_c{i}").alias("non_null")] if non_null else []),
            )
            for i, f in fields
        ]
        parts.append(stats.select(F.inline(F.array(*rows))))
    return _union(parts)


def drift_of(
    actual: dict[str, str], expected: dict[str, str]
) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, change, expected type, actual type)``; columns of load tools are ignored."""
    actual = {c: t for c, t in actual.items() if not c.startswith(TOOL_COLUMN_PREFIX)}
    added = [(c, "added", None, t) for c, t in actual.items() if c not in expected]
    removed = [(c, "removed", t, None) for c, t in expected.items() if c not in actual]
    changed = [
        (c, "type_changed", t, actual[c])
        for c, t in expected.items()
        if c in actual and not types_compatible(t, actual[c])
    ]
    return added + removed + changed


def drift_over_files(
    groups: Sequence[SchemaGroup], expected: dict[str, str]
) -> list[tuple[str, str, str | None, str | None]]:
    """As ``drift_of`` for files of several schemas: a column counts by its worst type.

    The actual type lists all that occur. Types that are compatible with the declared one, but
    not with each other, do not occur.
    """
    variants = type_variants(groups)
    worst = {
        c: next((t for t in kinds if c in expected and not types_compatible(expected[c], t)), kinds[0])
        for c, kinds in variants.items()
    }
    shown = {c: " | ".join(kinds) for c, kinds in variants.items()}
    return [(c, change, e, shown.get(c, a)) for c, change, e, a in drift_of(worst, expected)]


def schema_drift(df: DataFrame, table: RawTable | dict[str, str], name: str) -> DataFrame:
    """Differences between a table and its declaration, with the rows each one touches.

    Added and changed columns touch the rows that carry a value, removed ones every row.
    """
    expected = table.columns if isinstance(table, RawTable) else table
    drift = drift_of(dict(df.dtypes), expected)
    if not drift:
        return df.sparkSession.createDataFrame([], f"{DRIFT_DDL}, rows_affected bigint")
    seen = [c for c, change, _, _ in drift if change != "removed"]
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(seen)],
    )

    def row(column: str, change: str, before: str | None, after: str | None) -> Column:
        touched = F.col("_rows" if change == "removed" else f"_n{seen.index(column)}")
        return F.struct(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(change).alias("change"),
            F.lit(before).cast("string").alias("expected"),
            F.lit(after).cast("string").alias("actual"),
            touched.alias("rows_affected"),
        )

    return stats.select(F.inline(F.array(*[row(*d) for d in drift])))


def file_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and bytes per table from directory listings; a missing path counts as no files."""
    parts = []
    for name, path in paths.items():
        try:
            files = file_listing(spark, path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            files = spark.createDataFrame([], "path string, length bigint")
        parts.append(
            files.agg(
                F.count(F.lit(1)).alias("file_count"),
                F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
            ).select(F.lit(name).alias("table_name"), "file_count", "total_bytes")
        )
    return _union(parts)


def row_counts(tables: dict[str, DataFrame], minimum: dict[str, int]) -> DataFrame:
    """Rows per table against the declared minimum; Parquet counts need no column data."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(minimum.get(name, 1)).cast("bigint").alias("min_row_count"),
                (F.col("row_count") >= minimum.get(name, 1)).alias("passed"),
            )
            for name, df in tables.items()
        ]
    )


def validate_source(
    spark: SparkSession,
    paths: dict[str, str],
    declared: dict[str, RawTable],
) -> DataFrame:
    """``(table, check, passed, detail)`` for every declared table of a source.

    A table that cannot be read fails its count and schema checks. Files that disagree on a type are
    a drift of that column, not an error.
    """
    parts = []
    stats = {r["table_name"]: r for r in file_stats(spark, paths).collect()}
    for name, path in paths.items():
        files, size = stats[name]["file_count"], stats[name]["total_bytes"]
        checks = [
            ("files_exist", files > 0, f"{files} files"),
            ("bytes_present", size > 0, f"{size} bytes"),
        ]
        groups = schema_groups(spark, path) if files else []
        if not groups:
            checks += [("row_count", False, "unreadable"), ("schema_drift", False, "unreadable")]
        else:
            df = read_groups(spark, groups)
            drift = drift_over_files(groups, declared[name].columns)
            detail = "; ".join(f"{change} {c}" for c, change, _, _ in drift)
            checks.append(("schema_drift", not drift, detail or "none"))
            counts = row_counts({name: df}, {name: declared[name].min_rows})
            parts.append(
                counts.select(
                    "table_name",
                    F.lit("row_count").alias("check_name"),
                    "passed",
                    F.concat(
                        F.col("row_count").cast("string"),
                        F.lit(" rows, minimum "),
                        F.col("min_row_count").cast("string"),
                    ).alias("detail"),
                )
            )
        columns = ["table_name", "check_name", "passed", "detail"]
        parts.append(literal_rows(spark, columns, [(name, *check) for check in checks]))
    return _union(parts)


def read_if_exists_recursive(spark: SparkSession, path: str) -> DataFrame | None:
    """A raw table in dated folders, or None when no file has a readable schema."""
    try:
        return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in MISSING:
            return None
        raise


def register_schemas(tables: dict[str, DataFrame], registry: str, version: int) -> None:
    """Append the observed schemas to the registry as ``version``; a re-run replaces it."""
    (
        observed_schema(tables)
        .withColumn("version", F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version")
        .parquet(registry)
    )


def registry_diff(spark: SparkSession, registry: str) -> DataFrame:
    """Column changes between each registered version and the one before it."""
    entries = read_if_exists(spark, registry)
    if entries is None:
        raise FileNotFoundError(f"no schema registry at {registry}")
    versions = entries.select("table_name", "version", "row_count").distinct()
    previous = F.lag("version").over(Window.partitionBy("table_name").orderBy("version"))
    steps = versions.withColumn("previous", previous).dropna(subset=["previous"])
    new = steps.join(entries.drop("row_count"), ["table_name", "version"]).select(
        "table_name", "version", "column_name", F.col("type").alias("new_type")
    )
    old = (
        steps.select("table_name", "version", "previous")
        .join(
            entries.select(
                "table_name",
                F.col("version").alias("previous"),
                "column_name",
                F.col("type").alias("old_type"),
            ),
            ["table_name", "previous"],
        )
        .select("table_name", "version", "column_name", "old_type")
    )
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    return (
        old.join(new, ["table_name", "version", "column_name"], "full")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .join(steps.select("table_name", "version", "row_count"), ["table_name", "version"])
        .select(
            "table_name", "version", "column_name", "change", "old_type", "new_type", "row_count"
        )
    )
