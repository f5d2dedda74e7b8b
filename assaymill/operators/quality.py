"""Data-quality rules, compiled to one aggregation per table.

A suite's row-level rules share a single scan; key uniqueness adds one shuffle by key. Reports
are small frames with one row per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "failed", "total", "ratio", "passed"]


class DataQualityError(Exception):
    """Raised when a suite fails and failing was asked for."""


@dataclass(frozen=True)
class NotNull:
    """At most ``threshold`` of the rows may lack a value; an empty table passes."""

    column: str
    threshold: float = 0.0
    name: str = field(default="not_null", init=False)

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InRange:
    """Values lie in ``[low, high]``; NULL passes."""

    column: str
    low: Any
    high: Any
    threshold: float = field(default=0.0, init=False)
    name: str = field(default="in_range", init=False)

    def failing(self) -> Column:
        return (F.col(self.column) < self.low) | (F.col(self.column) > self.high)


@dataclass(frozen=True)
class InSet:
    """Values belong to a set; NULL passes."""

    column: str
    values: tuple
    threshold: float = field(default=0.0, init=False)
    name: str = field(default="in_set", init=False)

    def failing(self) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class NotBlank:
    """Text is not empty; NULL passes."""

    column: str
    threshold: float = field(default=0.0, init=False)
    name: str = field(default="not_blank", init=False)

    def failing(self) -> Column:
        return F.trim(F.col(self.column)) == ""


@dataclass(frozen=True)
class ParsesAs:
    """Values can be cast to a type; NULL passes."""

    column: str
    type_name: str
    threshold: float = field(default=0.0, init=False)
    name: str = field(default="parses_as", init=False)

    def failing(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & c.try_cast(self.type_name).isNull()


@dataclass(frozen=True)
class OfType:
    """The column exists with this Spark type; on failure every row counts as failed."""

    column: str
    type_name: str
    name: str = field(default="of_type", init=False)

    def holds(self, df: DataFrame) -> bool:
        return dict(df.dtypes).get(self.column) == self.type_name


@dataclass(frozen=True)
class ColumnsInOrder:
    """The table has exactly these columns in this order."""

    columns: tuple
    name: str = field(default="columns_in_order", init=False)

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def holds(self, df: DataFrame) -> bool:
        return tuple(df.columns) == tuple(self.columns)


@dataclass(frozen=True)
class UniqueKey:
    """No two rows share the key; surplus rows count as failed."""

    columns: tuple
    name: str = field(default="unique_key", init=False)

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def _report_row(table: str, rule, failed: Column, total: Column, threshold: float = 0.0) -> Column:
    ratio = F.when(total > 0, failed / total).otherwise(F.lit(0.0))
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule.name).alias("check_name"),
        F.lit(rule.column).alias("column_name"),
        failed.cast("bigint").alias("failed"),
        total.cast("bigint").alias("total"),
        ratio.cast("double").alias("ratio"),
        (ratio <= threshold).alias("passed"),
    )


def run_suite(df: DataFrame, rules: Sequence, table: str) -> DataFrame:
    """One report row per rule, as a lazy frame with ``REPORT_COLUMNS``."""
    keyed = [r for r in rules if isinstance(r, UniqueKey)]
    plain = [r for r in rules if not isinstance(r, UniqueKey)]
    parts = []
    if plain:
        total = F.col("_total")
        measures, rows = [], []
        for i, rule in enumerate(plain):
            if hasattr(rule, "failing"):
                measures.append(F.count_if(rule.failing()).alias(f"_f{i}"))
                rows.append(_report_row(table, rule, F.col(f"_f{i}"), total, rule.threshold))
            else:
                ok = rule.holds(df)
                failed = F.lit(0).cast("bigint") if ok else F.greatest(total, F.lit(1))
                rows.append(_report_row(table, rule, failed, F.greatest(total, F.lit(1))))
        one = df.agg(F.count(F.lit(1)).alias("_total"), *measures)
        parts.append(one.select(F.inline(F.array(*rows))))
    for rule in keyed:
        sizes = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n"))
        one = sizes.agg(
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_failed"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
        )
        row = _report_row(table, rule, F.col("_failed"), F.col("_total"))
        parts.append(one.select(F.inline(F.array(row))))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _passes(df: DataFrame, rules: Sequence) -> bool:
    return all(r["passed"] for r in run_suite(df, rules, "").select("passed").collect())


def check_nulls(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> bool:
    return _passes(df, [NotNull(c, threshold) for c in columns])


def check_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    return _passes(df, [UniqueKey(tuple(columns))])


def check_range(df: DataFrame, column: str, low: float, high: float) -> bool:
    return _passes(df, [InRange(column, low, high)])


def check_allowed_values(df: DataFrame, column: str, allowed: Sequence) -> bool:
    return _passes(df, [InSet(column, tuple(allowed))])


def offending_values(df: DataFrame, column: str, allowed: Sequence, n: int = 5) -> DataFrame:
    """Up to ``n`` distinct values outside the allowed set, for an operator to look at."""
    return df.filter(InSet(column, tuple(allowed)).failing()).select(column).distinct().limit(n)


# The states an order can be in.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "invoiced",
    "processing", "approved", "unavailable", "created",
)

# The column list the raw orders feed promises.
RAW_ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

RAW_ORDERS_SUITE = (
    ColumnsInOrder(RAW_ORDER_COLUMNS),
    NotNull("order_id"),
    NotNull("customer_id"),
    InSet("order_status", ORDER_STATUSES),
)

SILVER_SUITES = {
    "dim_customers": (
        UniqueKey(("customer_id",)),
        NotNull("customer_id"),
        NotNull("customer_unique_id"),
    ),
    "fact_order_items": (InRange("price", 0, 100000),),
    "fact_orders": (InSet("order_status", ORDER_STATUSES),),
}


def audit(tables: dict[str, DataFrame], suites: dict[str, Sequence]) -> DataFrame:
    """Reports of several tables' suites in one frame."""
    reports = [run_suite(tables[name], rules, name) for name, rules in suites.items()]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def enforce(report: DataFrame) -> None:
    """Raise with the failed checks of a report (one row per rule, so collecting is safe)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise DataQualityError(
            "; ".join(
                f"{r['table_name']}.{r['check_name']}({r['column_name']}): "
                f"{r['failed']} of {r['total']}"
                for r in failed
            )
        )
