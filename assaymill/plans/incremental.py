"""Silver by increments: only raw days that are new are read, only touched partitions rewritten.

Each published version notes, per raw table and sync date, a fingerprint of that day's files. The next
run compares them with the listing:

* no change: the table's folders are carried over by name;
* new days: orders and weather readings are merged by key into the months they touch; items and
  payments are appended where every raw row counts;
* a day that was replaced or vanished, or a table without an incremental form: the table is built anew
  from all its raw days.

Whatever the path, the result is that of a full recompute, and all tables appear as one version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.functions.timestamps import parse_iso_millis
from assaymill.operators import clean, dimensions, facts, weather
from assaymill.operators.joins import BROADCAST_LIMIT_BYTES, measured_bytes
from assaymill.plans.jobs import MONTH, SILVER_PARTITIONS, SilverOptions, audited
from assaymill.session import materialize, scratch_scope
from assaymill.sources.loads import MISSING
from assaymill.sources.schema_groups import scan_raw
from assaymill.sources.schemas import RAW_TABLES
from assaymill.sources.tables import SYNC_DATE, file_listing
from assaymill.sources.versions import Publication, Version, VersionedLake, partition_name

#: Latest raw version of each order, by month of purchase: what later versions are compared with.
ORDER_STATE = "state_orders"

Days = dict[str, str]


def raw_days(spark: SparkSession, lake: VersionedLake) -> dict[str, Days]:
    """Per raw table its sync dates with a fingerprint of their files' names and sizes.

    From listings alone. Files outside dated folders count as the day ``''``.
    """
    found: dict[str, Days] = {name: {} for name in RAW_TABLES}
    parts = []
    for name, table in RAW_TABLES.items():
        try:
            files = file_listing(spark, lake.raw(table.source, name))
        except AnalysisException as e:
            if e.getCondition() not in MISSING:
                raise
            continue
        day = F.concat_ws("-", *[F.regexp_extract("path", SYNC_DATE, i) for i in (1, 2, 3)])
        mark = F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).cast("string")
        parts.append(
            files.groupBy(F.trim(day, F.lit("-")).alias("day"))
            .agg(mark.alias("mark"))
            .select(F.lit(name).alias("name"), "day", "mark")
        )
    if parts:
        for row in reduce(DataFrame.unionByName, parts).collect():  # one row per table and day
            found[row["name"]][row["day"]] = row["mark"]
    return found


def new_days(seen: Days | None, now: Days) -> list[str] | None:
    """The days to read, or None where the table must be built anew."""
    if seen is None or any(now.get(day) != mark for day, mark in seen.items()):
        return None
    days = sorted(set(now) - set(seen))
    return None if "" in days else days


def merge_partitions(
    publication: Publication,
    name: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    newest: Callable[[DataFrame], DataFrame],
    moves: bool = True,
) -> set[str]:
    """Merge ``incoming`` by key into a published table, rewriting only touched partitions.

    ``newest`` reduces rows to one per key and must not depend on how rows are grouped before. Touched are
    the partitions of incoming rows and, with ``moves``, those that hold one of their keys now, which
    one scan of the key columns finds. Without ``moves`` the caller vouches that a key keeps its
    partition. Returns the names of the touched partitions.
    """
    held = publication.layer.read(name, publication.base)
    touched = _partitions_of(incoming, partition_cols)
    if moves:
        wanted = incoming.select(*[F.col(k).alias(f"_in_{k}") for k in keys]).distinct()
        if measured_bytes(wanted) <= BROADCAST_LIMIT_BYTES:
            wanted = F.broadcast(wanted)
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_in_{k}")) for k in keys])
        touched |= _partitions_of(held.join(wanted, same, "left_semi"), partition_cols)
    if touched:
        old = publication.layer.read(name, publication.base, partitions=touched)
        publication.stage(name, newest(old.unionByName(incoming)), partition_cols, "partitions", gone=touched)
    return touched


def _partitions_of(df: DataFrame, partition_cols: Sequence[str]) -> set[str]:
    """Names of the partitions that occur: as many rows as partitions."""
    found = df.select(*partition_cols).distinct().collect()
    return {partition_name(dict(zip(partition_cols, r))) for r in found}


def order_state(raw: DataFrame) -> DataFrame:
    """The latest raw version of each order, with the month of its purchase."""
    latest = clean.newest_version(
        clean.require_keys(raw, ["order_id", "customer_id"]), ["order_id"], settle_ties=True
    )
    bought = parse_iso_millis("order_purchase_timestamp")
    return latest.withColumns({"year": F.year(bought), "month": F.month(bought)})


def merge_orders(publication: Publication, raw: DataFrame | None, fresh: DataFrame | None, moves: bool = True) -> None:
    """``fact_orders`` and its state: from all of ``raw``, or by merging the ``fresh`` rows."""
    if fresh is None:
        state = publication.stage(ORDER_STATE, order_state(raw), MONTH)
        publication.stage("fact_orders", facts.typed_orders(state.drop(*MONTH)), MONTH)
        return

    def newest(rows: DataFrame) -> DataFrame:
        return order_state(rows.drop(*MONTH))

    incoming = materialize(order_state(fresh), "fresh-orders")
    touched = merge_partitions(publication, ORDER_STATE, incoming, ["order_id"], MONTH, newest, moves)
    if touched:
        state = publication.staged(ORDER_STATE, partitions=touched)
        made = facts.typed_orders(state.drop(*MONTH))
        publication.stage("fact_orders", made, MONTH, "partitions", gone=touched)


def merge_weather(publication: Publication, raw: DataFrame | None, fresh: DataFrame | None) -> None:
    """``weather_enriched``; the station's second fixes both key and month."""
    if fresh is None:
        publication.stage("weather_enriched", weather.build_weather_enriched(raw), MONTH)
        return
    incoming = materialize(weather.build_weather_enriched(fresh), "fresh-weather")
    merge_partitions(
        publication, "weather_enriched", incoming, weather.KEYS, MONTH, weather.highest_reading
    )


def _rebuilt(name: str, raw: dict[str, DataFrame], options: SilverOptions) -> DataFrame:
    """A table that has no incremental form, from all its raw rows."""
    builders: dict[str, Callable[[], DataFrame]] = {
        "dim_customers": lambda: dimensions.build_dim_customers(raw["customers"]),
        "dim_products": lambda: dimensions.build_dim_products(
            raw["products"], raw["product_category_name_translation"]
        ),
        "dim_sellers": lambda: dimensions.build_dim_sellers(raw["sellers"]),
        "dim_geolocation": lambda: dimensions.build_dim_geolocation(raw["geolocation"]),
        "fact_order_items": lambda: facts.build_fact_order_items(
            raw["order_items"], options.newest_only
        ),
        "fact_payments": lambda: facts.build_fact_payments(
            raw["order_payments"], options.newest_only
        ),
        "fact_reviews": lambda: facts.build_fact_reviews(raw["order_reviews"]),
    }
    return builders[name]()


#: Raw tables that each silver table is made of.
INPUTS = {
    "dim_customers": ("customers",),
    "dim_products": ("products", "product_category_name_translation"),
    "dim_sellers": ("sellers",),
    "dim_geolocation": ("geolocation",),
    "fact_orders": ("orders",),
    "fact_order_items": ("order_items",),
    "fact_payments": ("order_payments",),
    "fact_reviews": ("order_reviews",),
    "weather_enriched": ("weather_current",),
}
APPENDED = {"fact_order_items", "fact_payments"}


def run_incremental(
    spark: SparkSession, lake: VersionedLake, options: SilverOptions | None = None, moves: bool = True
) -> Version | None:
    """Bring the silver layer up to the raw layer; None if no raw table changed.

    The audit covers the tables that are new in this version, as whole tables.
    """
    options = options or SilverOptions()
    days = raw_days(spark, lake)
    settings = [options.first_day, options.last_day, options.newest_only]
    with scratch_scope(spark), lake.layer(spark, "silver").publication() as publication:
        notes = publication.base.notes
        seen = notes.get("days", {}) if notes.get("settings") == settings else {}

        def scan(raw_name: str, only: Sequence[str] | None = None) -> DataFrame:
            table = RAW_TABLES[raw_name]
            days = [lake.raw(table.source, raw_name, day) for day in only or ()]
            # Declared types throughout, so that a load of one day fits what is stored.
            paths = lake.raw(table.source, raw_name) if only is None else days
            return scan_raw(spark, paths, table.schema, always=True)

        if not seen:
            calendar = dimensions.build_date_dimension(spark, options.first_day, options.last_day)
            publication.stage("dim_date", calendar)
        for name, inputs in INPUTS.items():
            there = name in publication.base.tables
            changed = {r: new_days(seen.get(r) if there else None, days[r]) for r in inputs}
            if all(found == [] for found in changed.values()):
                continue
            raw = {r: scan(r) for r in inputs}
            fresh = changed[inputs[0]]
            only_new = None if fresh is None else scan(inputs[0], fresh)
            if name == "fact_orders":
                merge_orders(publication, raw["orders"], only_new, moves)
            elif name == "weather_enriched":
                merge_weather(publication, raw["weather_current"], only_new)
            elif name in APPENDED and only_new is not None and not options.newest_only:
                publication.stage(name, _rebuilt(name, {inputs[0]: only_new}, options), replace="append")
            else:
                publication.stage(name, _rebuilt(name, raw, options), SILVER_PARTITIONS.get(name, ()))
        if not publication.names():
            return None
        staged = [n for n in publication.names() if n in options.suites]
        if staged:
            suites = {n: options.suites[n] for n in staged}
            checked = SilverOptions(fail_on_audit=options.fail_on_audit, suites=suites)
            audited(spark, {n: publication.staged(n) for n in staged}, checked)
        return publication.commit(job="incremental", days=days, settings=settings)
