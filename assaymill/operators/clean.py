"""Row cleaning: keys, versions, timestamps, text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from assaymill.functions.timestamps import parse_iso_millis


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose key columns are all set; Parquet gets the test as a pushed filter."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def drop_duplicates_by_key(
    df: DataFrame,
    keys: Sequence[str],
    before: Observation | None = None,
    after: Observation | None = None,
) -> DataFrame:
    """One row per key, any of the copies.

    Pass observations to learn the row counts (metric ``rows``) as a by-product of the job
    that consumes the result, instead of counting in jobs of their own.
    """
    rows = F.count(F.lit(1)).alias("rows")
    if before is not None:
        df = df.observe(before, rows)
    result = df.dropDuplicates(list(keys))
    return result if after is None else result.observe(after, rows)


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest version of each key.

    The ``rank = 1`` filter becomes a group limit below the shuffle: each task sends at most
    one row per key, however many versions a key has.
    """
    versions = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn("_version", F.row_number().over(versions))
        .filter(F.col("_version") == 1)
        .drop("_version")
    )


def newest_version(
    df: DataFrame,
    keys: Sequence[str],
    version_col: str = "updated_at",
    then_by: Sequence[str] = (),
    settle_ties: bool = False,
) -> DataFrame:
    """Latest row per key by ``version_col``, then by the columns ``then_by``.

    Only the columns named here and those used later cross the shuffle. ``settle_ties`` goes on
    with all other columns, so that equal versions give the same row on every run. Without a
    version column any copy will do.
    """
    if version_col not in df.columns:
        return drop_duplicates_by_key(df, keys)
    rest = sorted(set(df.columns) - set(keys)) if settle_ties else []
    named = dict.fromkeys([version_col, *then_by, *rest])
    order = [F.col(c).desc_nulls_last() for c in named]
    return latest_by_key(df, keys, order)


def cast_timestamp_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ISO text to timestamp for those of ``columns`` that exist; malformed text gives NULL."""
    return df.withColumns({c: parse_iso_millis(c) for c in columns if c in df.columns})


def normalize_string_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and lower-case those of ``columns`` that exist; blank text becomes NULL."""
    return df.withColumns(
        {c: F.nullif(F.lower(F.trim(F.col(c))), F.lit("")) for c in columns if c in df.columns}
    )


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim text and turn blanks into NULL, keeping the case."""
    return df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns})


def add_surrogate_key(df: DataFrame, name: str = "sk_id") -> DataFrame:
    """A unique 64-bit id per row, not consecutive, and without a shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())
