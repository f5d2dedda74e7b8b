"""Joins that stay safe when a side grows or one key dominates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.operators.bloom import possible_matches
from assaymill.operators.clean import require_keys
from assaymill.session import BROADCAST_LIMIT_BYTES, literal_rows, materialize

HEAVY_KEYS_TRACKED = 65_536
HEAVY_SHARE = 1 / 2_048


def measured_bytes(df: DataFrame) -> int:
    """Payload size of a frame, measured in one aggregation pass over it."""
    fixed, variable = 0, []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(F.octet_length(F.to_json(F.struct(F.col(field.name)))))
        fixed += 16
    row = reduce(lambda a, b: a + b, variable, F.lit(fixed)).cast("bigint")
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_join(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Equi join that broadcasts ``small`` only after measuring it.

    Beyond ``limit_bytes`` the join is left to Catalyst and AQE, which shuffle both sides.
    """
    on = [on] if isinstance(on, str) else list(on)
    if measured_bytes(small) <= limit_bytes:
        small = F.broadcast(small)
    return large.join(small, on=on, how=how)


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold at least ``share`` of all rows; at most ``1 / share`` of them exist.

    A mergeable frequent-items sketch finds the candidates in one column scan, without a
    shuffle by key.
    """
    most = ceil(1 / share)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{key}`, {most}, {max(HEAVY_KEYS_TRACKED, 32 * most)})").alias("top"),
    ).first()
    floor = max(2, share * found["rows"])
    return [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] >= floor]


def skew_join(
    big: DataFrame,
    unique: DataFrame,
    key: str,
    how: str = "inner",
    share: float = HEAVY_SHARE,
) -> DataFrame:
    """Join ``big`` to a frame with one row per key although some keys of ``big`` are hot.

    Rows of hot keys meet their single partner by broadcast (as many rows as hot keys) and
    are never gathered by key; all other rows take the ordinary shuffled join. Should the
    partners not be unique after all and outgrow a broadcast, the hot rows are shuffled too and
    AQE splits their partitions. NULL keys match nothing and pass beside the join. ``big`` is
    read three times, so this is for keys known to be hot; AQE deals with the rest.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    hot = heavy_keys(big, key, share)
    known = big.filter(F.col(key).isNotNull())
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    joined = known.filter(~is_hot).join(unique.filter(~is_hot), key, how)
    if hot:
        partners = unique.filter(F.col(key).isin(hot))
        joined = broadcast_join(known.filter(is_hot), partners, key, how).unionByName(joined)
    if how == "left":
        joined = joined.unionByName(big.filter(F.col(key).isNull()), allowMissingColumns=True)
    return joined


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], prune: bool = False
) -> DataFrame:
    """Rows of ``incoming`` to append: key set, one per key, key not yet in ``target``.

    ``prune`` is for a long target: the incoming rows are stored and counted now, and of the target
    only rows whose key may be among theirs are shuffled, by a Bloom filter of the incoming keys.
    """
    keys = list(keys)
    fresh = require_keys(incoming, keys).dropDuplicates(keys)
    if prune:
        fresh = materialize(fresh, "incoming")
        target = possible_matches(target, fresh, keys, fresh.count())
    known = target.select(*keys).dropDuplicates()
    return fresh.join(known, keys, "left_anti")


def count_orphans(
    tables: dict[str, DataFrame],
    references: Sequence[tuple[str, str, str]],
    prune: bool = False,
) -> DataFrame:
    """Child rows and orphans per ``(child, fk, parent)``; the parent's key has the fk's name.

    Child rows are counted per key first, so a hot key crosses the shuffle as one row. All
    references to one parent share a single join. ``prune`` is for parents far longer than their
    children: the counted child keys are stored now and only parent rows that may match are shuffled.
    """
    by_parent: dict[tuple[str, str], list[DataFrame]] = {}
    for child, fk, parent in references:
        per_key = (
            require_keys(tables[child].select(fk), [fk])
            .groupBy(F.col(fk).alias("_key"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .select(F.lit(child).alias("child"), "_key", "_n")
        )
        by_parent.setdefault((parent, fk), []).append(per_key)
    parts = []
    for (parent, fk), children in by_parent.items():
        counted = reduce(DataFrame.unionByName, children)
        parent_keys = tables[parent].select(F.col(fk).alias("_key"))
        if prune:
            counted = materialize(counted, "child-keys")
            parent_keys = possible_matches(parent_keys, counted, ["_key"], counted.count())
        known = parent_keys.dropDuplicates().withColumn("_known", F.lit(True))
        parts.append(
            counted.join(known, "_key", "left")
            .groupBy("child")
            .agg(
                F.sum("_n").alias("child_rows"),
                F.sum(F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0)).alias("orphans"),
            )
            .select("child", F.lit(fk).alias("fk"), F.lit(parent).alias("parent"),
                    "child_rows", "orphans")
        )
    found = reduce(DataFrame.unionByName, parts)
    spark = found.sparkSession
    asked = literal_rows(spark, ["child", "fk", "parent"], list(references))
    return asked.join(found, ["child", "fk", "parent"], "left").na.fill(
        0, ["child_rows", "orphans"]
    )
