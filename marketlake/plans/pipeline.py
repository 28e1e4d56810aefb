"""Landing to silver to gold to quality in one Spark application."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.quality import check_rules, expectation_counts, rulesets, run_rules
from marketlake.plans import gold, silver
from marketlake.schemas import REFERENCE, SILVER, reference_schema
from marketlake.sinks.writers import RunLog, create_table, replace_table
from marketlake.sources.landing import counted, read_table
from marketlake.sources.static import area_dim
from marketlake.streaming.landing import stream_landing
from marketlake.streaming.silver import Enrich, insert_index, insert_prices, upsert_properties, with_rejects
from marketlake.streaming.state import BUCKETS, AppendTable, BatchTable, KeyedTable, RejectTable, path_exists


@dataclass(frozen=True)
class Warehouse:
    """Where the layers live. All paths must be reachable from every executor."""

    landing: str
    silver: str
    gold: str
    checkpoints: str
    buckets: int = BUCKETS  # of the property table; set by its first batch

    @property
    def properties(self) -> KeyedTable:
        return KeyedTable(f"{self.silver}/silver_properties", SILVER["silver_properties"], ["prop_id"], self.buckets)

    @property
    def prices(self) -> AppendTable:
        return AppendTable(f"{self.silver}/silver_prices", SILVER["silver_prices"], "date")

    @property
    def index(self) -> AppendTable:
        return AppendTable(f"{self.silver}/silver_spy_prices", SILVER["silver_spy_prices"])

    @property
    def moved(self) -> BatchTable:
        """Properties whose area a batch changed."""
        return BatchTable(f"{self.silver}/changes/properties", "prop_id bigint")

    @property
    def new_dates(self) -> BatchTable:
        """Dates that a batch of prices brought."""
        return BatchTable(f"{self.silver}/changes/prices", "date date")

    @property
    def refreshed(self) -> BatchTable:
        """Batches that the stored fact holds, by refresh."""
        return BatchTable(f"{self.gold}/refreshed", "dataset string, done bigint")

    def rejects(self, dataset: str) -> RejectTable:
        return RejectTable(f"{self.silver}/rejects/{dataset}")


def run_silver(
    spark: SparkSession, house: Warehouse, log: RunLog, normalise: bool = False, late_first_seen: bool = False,
    centroids: DataFrame | None = None, x_scale: float = 1.0, keep: int | None = 2, track: bool = False,
) -> None:
    """Consume the new landing files of each dataset; a dataset without any is left alone.

    Rows that can't be stored go to the dataset's rejects, and their number to the log. With
    ``centroids`` (postcode, latitude, longitude) properties without a known postcode get the
    nearest one's. ``keep`` is how many commits of the property table stay readable. ``track``
    keeps what each batch changes, for :func:`refresh_gold`.
    """
    def enriched(incoming: DataFrame, known: DataFrame) -> DataFrame:
        return silver.with_nearest_postcodes(incoming, known, centroids, x_scale, normalise)

    enrich: Enrich | None = None if centroids is None else enriched
    for dataset in ("properties", "prices", "spy_prices"):
        if not path_exists(spark, f"{house.landing}/{dataset}"):
            continue
        written: list[int] = []
        refused: list[int] = []
        handler = {
            "properties": lambda: upsert_properties(
                house.properties, normalise, late_first_seen, written.append, enrich, keep,
                house.moved if track else None,
            ),
            "prices": lambda: insert_prices(house.prices, written.append, house.new_dates if track else None),
            "spy_prices": lambda: insert_index(house.index, written.append),
        }[dataset]()
        handler = with_rejects(handler, dataset, house.rejects(dataset), refused.append)
        start = time.monotonic()
        stream_landing(spark, house.landing, dataset, f"{house.checkpoints}/{dataset}", handler).awaitTermination()
        seconds = time.monotonic() - start
        log.note(dataset, "silver", sum(written), seconds)
        log.note(dataset, "rejected", sum(refused), seconds)


def gold_tables(spark: SparkSession, house: Warehouse) -> dict[str, DataFrame]:
    prices, props = house.prices.read(spark), house.properties.read(spark)
    return {
        "gold_area_dim": area_dim(spark),
        "gold_property_fact": gold.price_fact(prices, props),
        "gold_current_properties": gold.current_listings(prices, props),
    }


def run_gold(spark: SparkSession, house: Warehouse, log: RunLog) -> None:
    """Recompute and replace the gold tables from silver, in the working types."""
    for name, df in gold_tables(spark, house).items():
        rows, seen = counted(df, name)
        log.timed(name, "gold", lambda r=rows, n=name: replace_table(r, f"{house.gold}/{n}"), seen)


def refresh_gold(spark: SparkSession, house: Warehouse, log: RunLog) -> list:
    """Bring the fact up to date by the dates that batches since the last refresh changed, and return these dates.

    For warehouses whose :func:`run_silver` runs with ``track``. The fact is stored by date; folders of other dates stay
    as they are. A refresh that fails before its last step does the same dates again. The other two tables are small or
    of one date and are replaced.
    """
    done = house.refreshed.read(spark)
    pending = {}
    for dataset, table in (("prices", house.new_dates), ("properties", house.moved)):
        known = done.where(F.col("dataset") == dataset).select(F.col("done").alias("batch"))
        pending[dataset] = table.read(spark).join(known, "batch", "left_anti")
    prices, props = house.prices.read(spark), house.properties.read(spark)
    dates = gold.affected_dates(prices, pending["prices"], pending["properties"])
    changed = sorted(r["date"] for r in dates.collect())  # at most one row per calendar day
    start = time.monotonic()
    gold.refresh_fact(prices, props, changed, f"{house.gold}/{FACT_BY_DATE}")
    log.note("gold_property_fact", "refreshed dates", len(changed), time.monotonic() - start)
    replace_table(area_dim(spark), f"{house.gold}/gold_area_dim")
    replace_table(gold.current_listings(prices, props), f"{house.gold}/gold_current_properties")
    finished = [
        pending[d].select(F.lit(d).alias("dataset"), F.col("batch").alias("done")).distinct() for d in sorted(pending)
    ]
    runs = done.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0] + 1
    house.refreshed.write(finished[0].union(finished[1]), runs)
    return changed


#: The fact in folders by date, which refreshes keep up to date.
FACT_BY_DATE = "gold_property_fact_by_date"
GOLD = ("gold_area_dim", "gold_property_fact", "gold_current_properties")


def open_tables(spark: SparkSession, house: Warehouse, published: bool = False) -> dict[str, DataFrame]:
    """All silver and gold tables, on request narrowed to the published types, which large ids do not fit."""
    tables = {
        "silver_properties": house.properties.read(spark),
        "silver_prices": house.prices.read(spark),
        "silver_spy_prices": house.index.read(spark),
        **{name: read_table(spark, f"{house.gold}/{name}") for name in GOLD},
    }
    return {name: reference_schema(df, name) for name, df in tables.items()} if published else tables


def publish(spark: SparkSession, house: Warehouse, database: str) -> None:
    """The gold tables as catalog tables of fixed columns, in the published types and beside the working ones."""
    tables = open_tables(spark, house, published=True)
    for name in GOLD:
        path = f"{house.gold}/published/{name}"
        replace_table(tables[name], path)
        create_table(spark, f"{database}.{name}", REFERENCE[name], path)
        spark.catalog.refreshTable(f"{database}.{name}")


def run_quality(tables: dict[str, DataFrame]) -> DataFrame:
    """Verdicts of all rulesets."""
    verdicts = None
    for name, rules in rulesets().items():
        frame = run_rules(tables[name], name, rules)
        verdicts = frame if verdicts is None else verdicts.unionByName(frame)
    return verdicts


def run_all(
    spark: SparkSession, house: Warehouse, on_fail: str = "report", normalise: bool = False,
    late_first_seen: bool = False, centroids: DataFrame | None = None, x_scale: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Silver, gold, quality. Returns the verdicts and the run's metrics.

    A broken rule is only reported, or with ``on_fail="fail"`` ends the run with an error.
    """
    if on_fail not in ("report", "fail"):
        raise ValueError("on_fail is 'report' or 'fail'")
    log = RunLog(spark)
    run_silver(spark, house, log, normalise, late_first_seen, centroids, x_scale)
    run_gold(spark, house, log)
    verdicts = run_quality(open_tables(spark, house))
    if on_fail == "fail":
        check_rules(verdicts)
    return verdicts, log.frame()


# ---- the earlier generation: named tables that depend on each other ----


@dataclass(frozen=True)
class Table:
    """A named result of a function over other named results."""

    name: str
    comment: str
    layer: str
    deps: tuple[str, ...]
    build: Callable[..., DataFrame]


LEGACY_TABLES = {
    t.name: t
    for t in (
        Table("silver_properties", "Newest state of every property.", "silver",
              ("landing_properties",), silver.legacy_properties),
        Table("silver_prices", "One positive price for each property and scrape day.", "silver",
              ("landing_prices",), silver.legacy_prices),
        Table("silver_spy_prices", "One index close for each day.", "silver",
              ("landing_spy_prices",), silver.legacy_index),
        Table("gold_area_dim", "Names of the areas.", "gold", (), lambda: area_dim(SparkSession.active())),
        Table("gold_property_fact", "Price level and number of listings, by day and area.", "gold",
              ("silver_prices", "silver_properties"),
              lambda prices, props: gold.price_fact(prices, props, date_col="scraped_at")),
        Table("gold_current_properties", "What was listed on the newest scrape day.", "gold",
              ("silver_prices", "silver_properties"),
              lambda prices, props: gold.current_listings(prices, props, date_col="scraped_at", unlisted="null")),
    )
}


def build_tables(inputs: dict[str, DataFrame], tables: dict[str, Table] = LEGACY_TABLES) -> dict[str, DataFrame]:
    """All tables as DataFrames, each built from the ones it names."""
    built = dict(inputs)

    def get(name: str) -> DataFrame:
        if name not in built:
            built[name] = tables[name].build(*[get(d) for d in tables[name].deps])
        return built[name]

    return {name: get(name) for name in tables}


def legacy_expectations(inputs: dict[str, DataFrame]) -> DataFrame:
    """Violations of the earlier generation's row expectations: (table, check, violations, num_rows).

    They are counted on request and ride along with no table, so that building tables costs nothing for them.
    """
    props = silver.legacy_properties(inputs["landing_properties"])
    checks = {name: F.expr(text) for name, text in silver.LEGACY_EXPECTATIONS.items()}
    counts = expectation_counts(props, checks).withColumn("table", F.lit("silver_properties"))
    prices = expectation_counts(inputs["landing_prices"], {"valid_price": F.col("price") > 0})
    return counts.unionByName(prices.withColumn("table", F.lit("silver_prices"))).select(
        "table", "check", "violations", "num_rows"
    )


__all__ = [
    "GOLD", "LEGACY_TABLES", "REFERENCE", "Table", "Warehouse", "build_tables", "gold_tables", "legacy_expectations",
    "open_tables", "publish", "refresh_gold", "run_all", "run_gold", "run_quality", "run_silver",
]
