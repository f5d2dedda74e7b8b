"""Exact global ranks and tiles without a single-partition sort.

A global ``ntile`` or ``row_number`` window gathers every row in one task. Here Spark range
partitions and sorts the rows, each row's position inside its partition comes for free from
``monotonically_increasing_id``, and per-partition row counts (one row per partition) turn
positions into ranks. The ranged frame is written once to shared storage, so both passes see
the same partitions even when executors are lost.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.session import materialize

# ``monotonically_increasing_id`` keeps the partition number above this bit.
_PARTITION_SHIFT = 33


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows in global order, stored, each with its partition and position in one number."""
    return materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id()),
        "ranked",
    )


def _ranked(placed: DataFrame, rank_col: str) -> DataFrame:
    part = F.shiftright("_position", _PARTITION_SHIFT)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, whatever the number of data rows.
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = F.col("_position").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank_col, F.col("_offset") + within + 1)
        .drop("_part", "_offset", "_position")
    )


def with_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Consecutive ranks 1..N in the order given; end ``order`` with a unique key."""
    return _ranked(_placed(df, order), rank_col)


def tile_of_rank(rank: Column, rows: int, tiles: int) -> Column:
    """The ``ntile(tiles)`` value of a rank among ``rows``: the first tiles get the surplus."""
    width, surplus = divmod(rows, tiles)
    in_wide = surplus * (width + 1)
    wide = F.call_function("div", rank - 1, F.lit(width + 1)) + 1
    narrow = F.call_function("div", rank - 1 - in_wide, F.lit(max(width, 1))) + surplus + 1
    return F.when(rank <= in_wide, wide).otherwise(narrow).cast("int")


def with_ntile(
    df: DataFrame,
    order: Sequence[Column],
    tiles: int,
    tile_col: str = "tile",
) -> DataFrame:
    """``ntile(tiles) over (order by ...)`` without gathering the rows."""
    placed = _placed(df, order)
    tile = tile_of_rank(F.col("_rank"), placed.count(), tiles)
    return _ranked(placed, "_rank").withColumn(tile_col, tile).drop("_rank")


def tile_cuts(
    df: DataFrame, key: str, measures: Sequence[str], tiles: int
) -> dict[str, list[tuple[int | None, str]]]:
    """Last ``(value, key)`` of every tile but the final one, per ascending integer measure.

    All measures share one range shuffle of narrow rows. The driver gets the row count of
    each range partition, works out where the cut rows lie, and reads just those: positions
    ascend within a file, so Parquet skips all other row groups.
    """
    stacked = df.select(
        F.col(key).alias("_key"),
        F.posexplode(F.array(*[F.col(m).cast("bigint") for m in measures])).alias("_m", "_v"),
    )
    order = [F.col("_m").asc(), F.col("_v").asc_nulls_first(), F.col("_key").asc()]
    placed = _placed(stacked, order)
    part = F.shiftright("_position", _PARTITION_SHIFT).alias("part")
    sizes = sorted(placed.groupBy(part).count().collect())
    rows = sum(size for _, size in sizes) // len(measures)
    if rows == 0:
        return {m: [] for m in measures}
    width, surplus = divmod(rows, tiles)
    ends = [t * width + min(t, surplus) for t in range(1, tiles)]
    ends = [end for end in ends if end > 0]
    starts = list(accumulate((size for _, size in sizes), initial=0))

    def position(rank: int) -> int:
        i = bisect_right(starts, rank - 1) - 1
        return (sizes[i][0] << _PARTITION_SHIFT) + rank - 1 - starts[i]

    at = {(m, e): position(i * rows + e) for i, m in enumerate(measures) for e in ends}
    cut_rows = placed.filter(F.col("_position").isin(sorted(set(at.values())))).collect()
    found = {r["_position"]: (r["_v"], r["_key"]) for r in cut_rows}
    return {m: [found[at[m, e]] for e in ends] for m in measures}


def with_tiles(
    df: DataFrame,
    key: str,
    measures: dict[str, str],
    tiles: int = 5,
) -> DataFrame:
    """Add one ``ntile`` column per measure (``{tile column: measure column}``).

    Measures are integers ranked ascending, ties settled by ``key``. ``df`` should be a stored
    table: it is read more than once.
    """
    cuts = tile_cuts(df, key, list(measures.values()), tiles)

    def tile(measure: str) -> Column:
        here = F.struct(F.col(measure).cast("bigint").alias("v"), F.col(key).alias("k"))
        result = F.lit(1)
        for value, at in cuts[measure]:
            cut = F.struct(F.lit(value).cast("bigint").alias("v"), F.lit(at).alias("k"))
            result = result + (here > cut).cast("int")
        return result

    return df.withColumns({name: tile(m) for name, m in measures.items()})
