"""Raw loads as jobs: each declared table by the way its declaration names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from assaymill.sources import loads
from assaymill.sources.schemas import RAW_TABLES, RawTable
from assaymill.sources.tables import Lake

Source = Callable[[str], DataFrame]


def chosen(source: str = "all", names: Sequence[str] = ()) -> dict[str, RawTable]:
    """Declared tables of a source, or those named; an unknown name is an error."""
    unknown = set(names) - set(RAW_TABLES)
    if unknown:
        raise ValueError(f"not declared: {', '.join(sorted(unknown))}")
    return {
        name: table
        for name, table in RAW_TABLES.items()
        if (name in names if names else source in ("all", table.source))
    }


def run_sync(lake: Lake, source: Source, tables: dict[str, RawTable], sync_date: str) -> dict[str, str]:
    """Bring the raw tables up to date; how each one was loaded.

    Tables with a cursor get what they lack as partition ``sync_date``, so a repeated run adds
    nothing; tables without one are replaced.
    """
    done = {}
    for name, table in tables.items():
        target = lake.raw(table.source, name)
        if table.cursor:
            loads.incremental_append(source(name), target, table.cursor, sync_date, table.key)
            done[name] = "incremental"
        else:
            loads.full_refresh(source(name), target)
            done[name] = "full refresh"
    return done


def run_load(
    spark: SparkSession, lake: Lake, folder: str, tables: dict[str, RawTable], splits: bool = True
) -> dict[str, int]:
    """Load ``<folder>/<table>.csv`` (a file or a folder) of each table; unreadable rows per table.

    Rows whose declared key is there already are left out, so a repeated load adds nothing; tables
    without a key take all rows.
    """
    return {
        name: loads.load_csv(
            spark, f"{folder.rstrip('/')}/{name}.csv", table.schema,
            lake.raw(table.source, name), table.key, splits=splits,
        )
        for name, table in tables.items()
    }
