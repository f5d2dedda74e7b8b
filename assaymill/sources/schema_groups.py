"""Raw tables whose files disagree on types.

Spark merges the footers of many files in tasks, but gives up where a column has two types that do not
merge. Then the folders are halved until each part merges: a change of type between two days takes
about as many passes as the number of days has binary digits, and no file is named by hand. Parts
with one schema are joined again, each group is read with its own schema, and every column is brought to
one type: the declared one, else the narrowest that holds the values of all groups, else text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.sources.loads import MISSING
from assaymill.sources.tables import file_listing

# Error conditions of footers that do not merge.
CLASHES = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "FAILED_MERGE_SCHEMA")
_WHOLE = ["tinyint", "smallint", "int", "bigint"]


@dataclass(frozen=True)
class SchemaGroup:
    """Folders or files of a table that share a merged schema."""

    schema: T.StructType
    paths: tuple[str, ...]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(*self.paths)


def _merged(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The merged schema of the files below ``paths``, or None where they clash."""
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    try:
        return reader.parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:
        # Tasks merge the footers, so the condition may sit below that of a failed stage.
        if not any(f"[{clash}]" in str(e) for clash in CLASHES):
            raise
        return None


def _split(spark: SparkSession, paths: Sequence[str]) -> list[SchemaGroup]:
    schema = _merged(spark, paths)
    if schema is not None:
        return [SchemaGroup(schema, tuple(paths))]
    if len(paths) == 1:
        files = [r["path"] for r in file_listing(spark, paths[0]).orderBy("path").collect()]
        if files == list(paths):
            raise ValueError(f"columns of {paths[0]} do not merge among themselves")
        return _split(spark, files)
    middle = len(paths) // 2
    return _split(spark, paths[:middle]) + _split(spark, paths[middle:])


def schema_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[SchemaGroup]:
    """The files below ``paths`` by schema; no groups where there is no file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    try:
        schema = _merged(spark, paths)
    except AnalysisException as e:
        if e.getCondition() in MISSING:
            return []
        raise
    if schema is not None:
        return [SchemaGroup(schema, tuple(paths))]
    folder = F.regexp_replace("path", "/[^/]+$", "")
    folders = file_listing(spark, paths).select(folder.alias("folder")).distinct().orderBy("folder")
    parts = _split(spark, [r["folder"] for r in folders.collect()])  # as many rows as folders
    joined: dict[str, list[SchemaGroup]] = {}
    for part in parts:
        shape = sorted((f.name, f.dataType.simpleString()) for f in part.schema.fields)
        joined.setdefault(str(shape), []).append(part)
    return [SchemaGroup(same[0].schema, tuple(p for g in same for p in g.paths)) for same in joined.values()]


def widened(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both without loss; text if there is none."""
    a, b = one.simpleString(), other.simpleString()
    if a == b or b == "void":
        return one
    if a == "void":
        return other
    if a in _WHOLE and b in _WHOLE:
        return max(one, other, key=lambda t: _WHOLE.index(t.simpleString()))
    floats = {"float": 24, "double": 53}
    bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64} | floats
    if a in bits and b in bits:
        # Whole numbers beyond the mantissa would be rounded.
        for wide, mantissa in ((T.FloatType(), 24), (T.DoubleType(), 53)):
            if bits[a] <= mantissa and bits[b] <= mantissa:
                return wide
        return T.StringType()
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        whole = max(one.precision - one.scale, other.precision - other.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if {a, b} <= {"date", "timestamp", "timestamp_ntz"} and "date" in (a, b):
        return other if a == "date" else one
    return T.StringType()


def unified_types(groups: Sequence[SchemaGroup]) -> dict[str, T.DataType]:
    """One type per column over all groups, in the order in which columns first occur."""
    found: dict[str, T.DataType] = {}
    for group in groups:
        for f in group.schema.fields:
            found[f.name] = widened(found[f.name], f.dataType) if f.name in found else f.dataType
    return found


def type_variants(groups: Sequence[SchemaGroup]) -> dict[str, list[str]]:
    """The types that each column has, in the order of the groups."""
    found: dict[str, list[str]] = {}
    for group in groups:
        for name, kind in ((f.name, f.dataType.simpleString()) for f in group.schema.fields):
            if kind not in found.setdefault(name, []):
                found[name].append(kind)
    return found


def _as(name: str, have: T.DataType | None, want: T.DataType) -> Column:
    if have is None:
        return F.lit(None).cast(want).alias(name)
    if have == want:
        return F.col(f"`{name}`")
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(want, T.StringType) and isinstance(have, nested):
        return F.to_json(F.col(f"`{name}`")).alias(name)
    return F.col(f"`{name}`").try_cast(want).alias(name)


def read_groups(
    spark: SparkSession,
    groups: Sequence[SchemaGroup],
    declared: Mapping[str, T.DataType] | None = None,
    always: bool = False,
) -> DataFrame:
    """All groups as one frame. A single group is read as it is, but with ``always``.

    Among several, columns get their declared type, others the common one; a value that does not
    fit a declared type becomes NULL.
    """
    if len(groups) == 1 and not always:
        return groups[0].read(spark)
    types = unified_types(groups)
    types |= {c: t for c, t in (declared or {}).items() if c in types}
    parts = []
    for group in groups:
        have = {f.name: f.dataType for f in group.schema.fields}
        parts.append(group.read(spark).select(*[_as(c, have.get(c), t) for c, t in types.items()]))
    return reduce(DataFrame.unionByName, parts)


def scan_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    declared: T.StructType | None = None,
    always: bool = False,
) -> DataFrame:
    """A raw table whose files may disagree on types; see ``read_groups``."""
    groups = schema_groups(spark, paths)
    if not groups:
        raise FileNotFoundError(f"no files below {paths}")
    types = {f.name: f.dataType for f in declared.fields} if declared is not None else None
    return read_groups(spark, groups, types, always)
