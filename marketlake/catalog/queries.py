"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.catalog import inputs
from marketlake.functions import area_code, layouts, partition_path, postcode_from_geocode
from marketlake.operators import changes, enrich, filters, quality, sketches
from marketlake.operators.dedupe import dedupe_latest
from marketlake.operators.greatcircle import nearest_great_circle
from marketlake.operators.medians import grouped_stats, value_counts
from marketlake.operators.nearest import nearest_join
from marketlake.operators.quality import QualityFailure
from marketlake.operators.quality_state import QualityState
from marketlake.plans import gold, ingest, pipeline, serving, silver
from marketlake.schemas import AREA_CODES, SILVER, reference_schema, struct_of
from marketlake.session import scratch_path
from marketlake.sinks.writers import RunLog, create_table, preview, replace_table, write_landing
from marketlake.sources import pages as page_source
from marketlake.sources.broken_tables import extract_any_table, irregular_share
from marketlake.sources.landing import read_landing, read_table
from marketlake.sources.series import shape_close_series
from marketlake.sources.static import area_dim
from marketlake.streaming.landing import stream_dedupe, stream_latest, stream_to_state
from marketlake.streaming.silver import apply_changes, insert_prices
from marketlake.streaming.state import AppendTable, KeyedTable, path_exists

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHOSEN = ["SW2", "SW7", "SW11"]
AS_OF = date(1998, 6, 30)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _silver(spark: SparkSession, sf: str, normalise: bool = False) -> tuple[DataFrame, DataFrame]:
    props = silver.incoming_properties(inputs.raw_properties(spark, sf), normalise)
    return silver.incoming_prices(inputs.raw_prices(spark, sf)), props


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return gold.price_fact(*_silver(spark, sf))


def _current(spark: SparkSession, sf: str) -> DataFrame:
    return gold.current_listings(*_silver(spark, sf), dates=inputs.raw_prices(spark, sf).select("date"))


# ---- silver --------------------------------------------------------------------------


@register
def silver_properties(spark, sf):
    return silver.incoming_properties(inputs.raw_properties(spark, sf))


@register
def silver_properties_normalised_area(spark, sf):
    return silver.incoming_properties(inputs.raw_properties(spark, sf), normalise=True).select(
        "prop_id", "postcode", "area_code"
    )


@register
def silver_prices(spark, sf):
    return silver.incoming_prices(inputs.raw_prices(spark, sf))


@register
def silver_spy_prices(spark, sf):
    return silver.incoming_index(inputs.raw_index(spark, sf))


@register
def legacy_silver_properties(spark, sf):
    return silver.legacy_properties(inputs.raw_properties(spark, sf))


@register
def legacy_silver_prices(spark, sf):
    raw = inputs.raw_prices(spark, sf).withColumn("price", F.col("price") - 500)
    return silver.legacy_prices(raw)


@register
def legacy_silver_spy_prices(spark, sf):
    return silver.legacy_index(inputs.raw_index(spark, sf))


@register
def dedupe_latest_with_ties(spark, sf):
    orders = inputs.table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    return dedupe_latest(
        orders, ["o_custkey"], ["order_day"], ["o_orderkey"], first_seen=("order_day", "first_day")
    )


# ---- gold ----------------------------------------------------------------------------


@register
def gold_area_dim(spark, sf):
    """The dimension with the number of properties in each of its areas."""
    _, props = _silver(spark, sf)
    counts = props.groupBy("area_code").agg(F.count(F.lit(1)).alias("n"))
    return area_dim(spark).join(counts, "area_code", "left").select(
        "area_code", "district", F.coalesce("n", F.lit(0)).cast("bigint").alias("num_properties")
    )


@register
def gold_property_fact(spark, sf):
    return _fact(spark, sf)


@register
def gold_property_fact_normalised_area(spark, sf):
    return gold.price_fact(*_silver(spark, sf, normalise=True))


@register
def gold_property_fact_approx_median(spark, sf):
    return gold.price_fact(*_silver(spark, sf), accuracy=1_000_000)


@register
def gold_property_fact_large_groups(spark, sf):
    return gold.price_fact(*inputs.large_facts(spark, sf))


@register
def gold_property_fact_unmatched(spark, sf):
    """Properties without a postcode are unknown and ten areas unlisted: the total exceeds the sum of the areas."""
    prices, props = _silver(spark, sf)
    return gold.price_fact(prices, props.where(F.col("postcode").isNotNull()), AREA_CODES[:10])


def _legacy(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return pipeline.build_tables({
        "landing_properties": inputs.raw_properties(spark, sf),
        "landing_prices": inputs.raw_prices(spark, sf).withColumn("price", F.col("price") - 500),
        "landing_spy_prices": inputs.raw_index(spark, sf),
    })


@register
def legacy_gold_property_fact(spark, sf):
    return _legacy(spark, sf)["gold_property_fact"]


@register
def legacy_gold_current_properties(spark, sf):
    return _legacy(spark, sf)["gold_current_properties"]


@register
def gold_current_properties(spark, sf):
    return _current(spark, sf)


@register
def gold_current_properties_reference_types(spark, sf):
    """Narrowed types; the FLOAT coordinates are shown as the whole number of their 10,000ths."""
    narrow = reference_schema(_current(spark, sf), "gold_current_properties")
    return narrow.withColumns({c: F.round(F.col(c) * 10000).cast("bigint") for c in ("latitude", "longitude")})


@register
def gold_property_fact_wide_values(spark, sf):
    """Prices beyond 32 bits keep their type."""
    prices, props = _silver(spark, sf)
    return gold.price_fact(prices.withColumn("price", F.col("price").cast("bigint") * 100_000), props)


# ---- serving -------------------------------------------------------------------------


@register
def serve_area_summary(spark, sf):
    """From a stored fact, whose newest date is looked up first."""
    path = f"{scratch_path(spark, 'summary')}/fact"
    replace_table(_fact(spark, sf), path)
    return serving.area_summary(spark.read.parquet(path), area_dim(spark))


@register
def serve_area_options(spark, sf):
    return serving.area_options(_fact(spark, sf))


@register
def serve_default_areas(spark, sf):
    return serving.default_areas(_fact(spark, sf))


@register
def serve_trend(spark, sf):
    return serving.trend(_fact(spark, sf), CHOSEN)


@register
def serve_trend_default_areas(spark, sf):
    fact = _fact(spark, sf)
    return serving.trend(fact, serving.default_areas(fact))


@register
def serve_price_lines(spark, sf):
    return serving.price_lines(_fact(spark, sf), CHOSEN)


@register
def serve_headline_all(spark, sf):
    return serving.headline(_current(spark, sf))


@register
def serve_headline_chosen(spark, sf):
    return serving.headline(_current(spark, sf), CHOSEN)


@register
def serve_headline_text(spark, sf):
    return serving.headline_text(serving.headline(_current(spark, sf)))


@register
def serve_headline_large(spark, sf):
    """Exact median over all line items."""
    prices, _ = inputs.large_facts(spark, sf)
    return serving.headline(prices)


@register
def serve_histogram(spark, sf):
    return serving.histogram(_current(spark, sf))


@register
def serve_histogram_large(spark, sf):
    prices, _ = inputs.large_facts(spark, sf)
    return serving.histogram(prices)


@register
def serve_map_points(spark, sf):
    return serving.map_points(_current(spark, sf), CHOSEN)


@register
def serve_last_updated(spark, sf):
    return serving.last_updated(_current(spark, sf))


@register
def serve_views(spark, sf):
    """The dashboard's reads through SQL views: area rows of the dimension and the ordered series."""
    serving.register_views({
        "view_area_dim": area_dim(spark),
        "view_silver_spy_prices": silver.incoming_index(inputs.raw_index(spark, sf)),
    })
    series = serving.load_index(spark, "view_silver_spy_prices")
    areas = serving.load_area_dim(spark, "view_area_dim").agg(F.count(F.lit(1))).scalar()
    return series.select("date", "close", areas.alias("listed_areas"))


@register
def serve_round_histogram(spark, sf):
    """Bins with round edges of prices, of prices around zero, of very small ones and of equal ones."""
    price = inputs.raw_prices(spark, sf).select(F.col("price").cast("decimal(18,0)").alias("price"))
    cases = {
        "prices": F.col("price"), "around zero": F.col("price") - 25000, "tiny": F.col("price") / F.lit(10**7), "equal": F.lit(7),
    }
    found = [
        serving.round_histogram(price.select(value.cast("decimal(28,10)").alias("price"))).select(
            F.lit(name).alias("case"), F.col("bin_start").cast("double"), F.col("bin_end").cast("double"), "num_rows"
        ) for name, value in cases.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


@register
def median_of_wide_values(spark, sf):
    """Exact middles of values over the whole range of 64 bits, all line items in one group and by return flag."""
    rows = inputs.wide_values(spark, sf)
    every = grouped_stats(value_counts(rows, [], "value"), []).withColumn("l_returnflag", F.lit("all"))
    by_flag = grouped_stats(value_counts(rows, ["l_returnflag"], "value"), ["l_returnflag"])
    return every.unionByName(by_flag).select("l_returnflag", "num_rows", "median_low", "median")


@register
def median_by_month_from_sketches(spark, sf):
    """Medians by year and area from stored sketches by month, whose ranks are off by less than a hundredth."""
    prices, props = inputs.large_facts(spark, sf)
    months = inputs.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("prop_id"), F.trunc("l_shipdate", "month").alias("month"),
        F.floor("l_extendedprice").cast("bigint").alias("price"),
    )
    placed = months.join(props, "prop_id").withColumn("year", F.year("month"))
    path = scratch_path(spark, "sketches")
    sketches.sketch_values(placed, ["month", "area_code"], "price").write.parquet(path)
    stored = spark.read.parquet(path)
    merged = sketches.merge_sketches(stored, [F.year("month").alias("year"), "area_code"])
    found = sketches.sketch_quantile(merged)
    error = sketches.rank_error(placed, ["year", "area_code"], "price", found.where("area_code IS NOT NULL"))
    return merged.drop("sketch").where("area_code IS NOT NULL").join(error, ["year", "area_code"]).select(
        "year", "area_code", "num_rows", (F.col("rank_error") < 0.01).alias("close")
    )


# ---- selections ----------------------------------------------------------------------


@register
def filter_nothing_chosen(spark, sf):
    """The two readings of an empty choice, side by side."""
    props = silver_properties(spark, sf)
    optional = filters.filter_optional(props, "area_code", []).agg(F.count(F.lit(1)).alias("num_rows"))
    strict = filters.filter_strict(props, "area_code", []).agg(F.count(F.lit(1)).alias("num_rows"))
    return optional.withColumn("reading", F.lit("all")).unionByName(strict.withColumn("reading", F.lit("none")))


@register
def filter_by_summary_rows(spark, sf):
    """Current listings in the areas of the summary with a median of at least 3000."""
    chosen = serving.area_summary(_fact(spark, sf), area_dim(spark)).where(F.col("median_price") >= 3000)
    return filters.filter_by_frame(_current(spark, sf), "area_code", chosen).select("prop_id", "area_code", "price")


@register
def filter_date_range(spark, sf):
    series = silver.incoming_index(inputs.raw_index(spark, sf))
    return series.where(filters.between_dates(F.col("date"), date(1998, 1, 1), date(1998, 3, 31)))


@register
def close_series_last_days(spark, sf):
    closes = inputs.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("Date")).agg(
        F.max_by("o_totalprice", "o_orderkey").alias("Close")
    )
    return shape_close_series(closes, AS_OF, days=90)


# ---- merges --------------------------------------------------------------------------


def _delivered(spark: SparkSession, sf: str, first: bool) -> DataFrame:
    return silver.incoming_properties(inputs.batch_properties(spark, sf, first))


@register
def merge_upsert_properties(spark, sf):
    return silver.merge_properties(_delivered(spark, sf, True), _delivered(spark, sf, False))


@register
def merge_upsert_late_first_seen(spark, sf):
    return silver.merge_properties(
        _delivered(spark, sf, True), _delivered(spark, sf, False), late_first_seen=True
    ).select("prop_id", "first_seen", "last_seen")


@register
def merge_insert_only_prices(spark, sf):
    first = silver.incoming_prices(inputs.batch_properties(spark, sf, True))
    second = silver.incoming_prices(inputs.batch_properties(spark, sf, False))
    return first.unionByName(silver.new_prices(first, second))


@register
def merge_insert_only_index(spark, sf):
    raw = inputs.raw_index(spark, sf)
    first = silver.incoming_index(raw.where(F.month("date") <= 6))
    second = silver.incoming_index(raw.where(F.month("date") >= 6).withColumn("close", F.col("close") + 1))
    return first.unionByName(silver.new_index_rows(first, second))


# ---- enrichment ----------------------------------------------------------------------


@register
def needs_postcode(spark, sf):
    return enrich.needs_enrichment(
        _delivered(spark, sf, False), _delivered(spark, sf, True), ["prop_id"], "postcode"
    ).select("prop_id", "postcode", "last_seen")


@register
def request_batches(spark, sf):
    """Customers in request batches of at most 100 within their nation's quarter, each with its batch."""
    customers = inputs.table(spark, sf, "customer").select(F.col("c_custkey").alias("prop_id"), "c_nationkey")
    quarter = F.pmod("c_nationkey", F.lit(4)).cast("int")
    return enrich.batch_rows(customers, 100, "prop_id", buckets=4, bucket=quarter).select("prop_id", "bucket", "batch_no")


@register
def nearest_site_great_circle(spark, sf):
    """Customers all over the globe with the nearest supplier, across the date line and around the poles."""
    points, sites = inputs.globe(spark, sf)
    return nearest_great_circle(points, sites, "site_id").select(
        "prop_id", "site_id", F.round("distance", 3).alias("distance")
    )


@register
def nearest_site(spark, sf):
    points, centroids = inputs.places(spark, sf)
    return nearest_join(points, centroids, "site_id", x_scale=0.62).select(
        "prop_id", "site_id", F.round("distance", 9).alias("distance")
    )


@register
def postcode_by_nearest_site(spark, sf):
    points, centroids = inputs.places(spark, sf)
    known = points.withColumn("postcode", F.when(F.col("prop_id") % 3 == 0, inputs.postcode_of(F.col("prop_id"))))
    missing = known.where(F.col("postcode").isNull()).drop("postcode")
    found = nearest_join(missing, centroids, "site_id", x_scale=0.62).join(
        centroids.select("site_id", "postcode"), "site_id"
    )
    return enrich.fill_from(known, found, ["prop_id"], "postcode").select("prop_id", "postcode")


@register
def postcode_for_new_properties(spark, sf):
    """The second delivery with postcodes for what the first left without one."""
    _, centroids = inputs.places(spark, sf)
    named = centroids.groupBy("postcode").agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    return silver.with_nearest_postcodes(
        _delivered(spark, sf, False), _delivered(spark, sf, True), named
    ).select("prop_id", "postcode", "area_code")


@register
def postcode_from_geocode_answer(spark, sf):
    return inputs.geocoded(spark, sf).select("c_custkey", postcode_from_geocode(F.col("results")).alias("postcode"))


@register
def area_code_forms(spark, sf):
    code = inputs.postcode_of(F.col("c_custkey"))
    forms = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("EC1A "), code)).when(
        F.col("c_custkey") % 4 == 1, F.concat(F.lit(" "), code)
    ).otherwise(code)
    rows = inputs.table(spark, sf, "customer").select("c_custkey", forms.alias("postcode"))
    return rows.select(
        "c_custkey", area_code(F.col("postcode")).alias("area"),
        area_code(F.col("postcode"), normalise=True).alias("normalised"),
    )


# ---- pages ---------------------------------------------------------------------------


def _listings(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["page_id", "scraped_at"]
    results = page_source.extract_embedded_json(inputs.listing_pages(spark, sf), keys)
    return page_source.parse_listings(results, ["page_id"], F.col("scraped_at"))


@register
def page_properties(spark, sf):
    return page_source.split_listings(_listings(spark, sf))[0]


@register
def page_prices(spark, sf):
    return page_source.split_listings(_listings(spark, sf))[1]


@register
def page_status(spark, sf):
    found = page_source.extract_embedded_json(inputs.listing_pages(spark, sf), ["page_id"])
    return found.select("page_id", "status")


@register
def page_failure_rate(spark, sf):
    return quality.failure_rate(_listings(spark, sf), ["page_id"], F.col("is_bad"), F.col("is_listing"))


@register
def page_index_list(spark, sf):
    """One row per page, also of those without any further page."""
    found = page_source.extract_embedded_json(inputs.listing_pages(spark, sf), ["page_id"])
    pages = page_source.page_indices(found, ["page_id"])
    return pages.withColumn("indices", F.array_join(F.transform("indices", lambda i: i.cast("string")), ","))


@register
def html_table_skipped_rows(spark, sf):
    return page_source.skipped_rows(inputs.rate_pages(spark, sf), ["o_orderkey"])


@register
def web_page_listings(spark, sf):
    """Data scripts at the end of whole web pages."""
    found = page_source.extract_embedded_json(inputs.web_pages(spark, sf), ["page_id"])
    listings = page_source.parse_listings(found, ["page_id"], F.lit("2024-01-01T12:00:00").cast("timestamp_ntz"))
    return listings.select("page_id", "is_listing", "prop_id", "price", "address", "latitude", "longitude", "is_bad")


@register
def html_table_rates(spark, sf):
    return page_source.extract_html_table(inputs.rate_pages(spark, sf), ["o_orderkey"], F.lit("2024-01-01").cast("date"))


@register
def broken_table_rates(spark, sf):
    """The rates of pages whose tables are nested or not closed, too."""
    return extract_any_table(inputs.broken_pages(spark, sf), ["o_orderkey"], F.lit("2024-01-01").cast("date"))


@register
def broken_table_share(spark, sf):
    return irregular_share(inputs.broken_pages(spark, sf)).withColumn("share", F.round("share", 9))


@register
def date_layouts_of_sources(spark, sf):
    """What the date cells of each customer group can have been written in, and how many of them are read."""
    return layouts.column_layouts(inputs.date_cells(spark, sf), ["source"], "cell")


@register
def dates_by_source_layout(spark, sf):
    """Every date cell read as the other cells of its source say."""
    cells = inputs.date_cells(spark, sf)
    found = layouts.column_layouts(cells, ["source"], "cell")
    return layouts.dates_by_layout(cells, ["source"], "cell", found, ambiguous="leave").select("o_orderkey", "source", "date")


@register
def rates_in_range(spark, sf):
    """Number and sum of the parsed rates by day, within a closed range of dates.

    The rates have two decimals and are added as such: a sum of doubles, and a mean rounded
    from it, would depend on the order of the rows.
    """
    rates = html_table_rates(spark, sf)
    chosen = rates.where(filters.between_dates(F.col("date").cast("date"), date(1997, 1, 1), date(1997, 12, 31)))
    return chosen.groupBy("date").agg(
        F.count(F.lit(1)).alias("num_rates"),
        F.sum(F.col("rate").cast("decimal(12,2)")).cast("double").alias("sum_rate"),
    )


# ---- quality -------------------------------------------------------------------------


def _verdicts(table: str, df: DataFrame) -> DataFrame:
    return quality.run_rules(df, table, quality.rulesets()[table])


@register
def quality_silver_properties(spark, sf):
    return _verdicts("silver_properties", silver_properties(spark, sf))


@register
def quality_silver_prices(spark, sf):
    return _verdicts("silver_prices", silver_prices(spark, sf))


@register
def quality_silver_spy_prices(spark, sf):
    return _verdicts("silver_spy_prices", silver_spy_prices(spark, sf))


@register
def quality_gold_current_properties(spark, sf):
    return _verdicts("gold_current_properties", _current(spark, sf))


@register
def quality_gold_property_fact(spark, sf):
    return _verdicts("gold_property_fact", _fact(spark, sf))


@register
def quality_raw_listings(spark, sf):
    """Rules on undeduplicated rows: uniqueness fails, and one rule is free SQL."""
    rules = [
        quality.row_count(">", 0),
        quality.is_unique("prop_id"),
        quality.is_unique("event_id"),
        quality.completeness("postcode", ">=", 0.95),
        quality.values_between("price", 100, 50000, inclusive=True),
        quality.custom_sql(
            "share over 100 pounds",
            "SELECT try_divide(count_if(price > 10000), count(*)) FROM {primary}", "<", 0.05,
        ),
    ]
    return quality.run_rules(inputs.raw_listings(spark, sf), "raw_listings", rules).withColumn(
        "metric", F.round("metric", 9)
    )


@register
def quality_from_batches(spark, sf):
    """The same rules from the states of three batches, each of which read its own rows only."""
    rules = [
        quality.row_count(">", 0), quality.is_unique("prop_id"), quality.is_unique("event_id"),
        quality.completeness("postcode", ">=", 0.95), quality.values_between("price", 100, 50000, inclusive=True),
        quality.share_of("share over 100 pounds", F.col("price") > 10000, "<", 0.05),
    ]
    state = QualityState(scratch_path(spark, "rules"), rules, buckets=4)
    rows = inputs.raw_listings(spark, sf)
    for batch in range(3):
        state.add(rows.where(F.pmod("event_id", F.lit(3)) == batch), batch)
    return state.verdicts(spark, "raw_listings").withColumn("metric", F.round("metric", 9))


@register
def expectations_on_properties(spark, sf):
    checks = {name: F.expr(text) for name, text in silver.LEGACY_EXPECTATIONS.items()}
    return quality.expectation_counts(silver_properties(spark, sf), checks)


@register
def expect_or_drop_prices(spark, sf):
    raw = inputs.raw_prices(spark, sf).withColumn("price", F.when(F.col("prop_id") % 13 != 0, F.col("price") - 500))
    kept, _ = quality.expect_or_drop(raw, "valid_price", F.col("price") > 0)
    return kept.groupBy("date").agg(F.count(F.lit(1)).alias("kept"), F.sum("price").alias("sum_price"))


@register
def missing_postcode_rate(spark, sf):
    raw = inputs.raw_properties(spark, sf).withColumn(
        "postcode", F.when(F.col("prop_id") % 17 == 0, F.lit("")).otherwise(F.col("postcode"))
    )
    return quality.missing_rate(raw, "postcode").withColumn("rate", F.round("rate", 9))


@register
def failure_rate_by_day(spark, sf):
    raw = inputs.raw_listings(spark, sf)
    return quality.failure_rate(raw, ["date"], F.col("postcode").isNull()).withColumn("rate", F.round("rate", 9))


# ---- landing, streams, pipeline ------------------------------------------------------


@register
def landing_written_by_day(spark, sf):
    """Prices written to landing folders by day, one day rewritten, and read back."""
    root = scratch_path(spark, "landing")
    prices = inputs.raw_prices(spark, sf)
    write_landing(prices, root, "prices", "date")
    write_landing(
        prices.where(F.col("date") == F.lit(date(2024, 1, 5))).withColumn("price", F.lit(1)),
        root, "prices", date(2024, 1, 5), on_empty="fail",
    )
    stored = read_landing(spark, root, "prices")
    return stored.groupBy("date", partition_path(F.col("date").cast("date")).alias("folder")).agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("price").alias("sum_price")
    )


def _house(spark: SparkSession, name: str) -> pipeline.Warehouse:
    root = scratch_path(spark, name)
    return pipeline.Warehouse(f"{root}/landing", f"{root}/silver", f"{root}/gold", f"{root}/checkpoints")


BOTH = ("properties", "prices")


def _deliver(
    spark: SparkSession, sf: str, house: pipeline.Warehouse, first: bool, datasets: Sequence[str] = BOTH
) -> None:
    rows = inputs.batch_properties(spark, sf, first)
    run_date = date(2024, 2, 1) if first else date(2024, 2, 8)
    for dataset in datasets:
        write_landing(rows, house.landing, dataset, run_date)


def _two_runs(
    spark: SparkSession, sf: str, name: str, log: RunLog | None = None, datasets: Sequence[str] = BOTH
) -> pipeline.Warehouse:
    house = _house(spark, name)
    for first in (True, False):
        _deliver(spark, sf, house, first, datasets)
        pipeline.run_silver(spark, house, log or RunLog(spark))
    return house


@register
def incremental_silver_properties(spark, sf):
    """Two deliveries through the landing stream, each merged into the stored table."""
    return _two_runs(spark, sf, "properties", datasets=["properties"]).properties.read(spark)


@register
def incremental_silver_prices(spark, sf):
    return _two_runs(spark, sf, "prices", datasets=["prices"]).prices.read(spark)


@register
def incremental_late_file(spark, sf):
    """The second delivery's files carry modification times of a month before the first one's."""
    house = _house(spark, "late")
    for first in (True, False):
        _deliver(spark, sf, house, first, ["prices"])
        if not first:
            _age(spark, f"{house.landing}/prices/year=2024/month=02/day=08", days=30)
        pipeline.run_silver(spark, house, RunLog(spark))
    return house.prices.read(spark)


def _age(spark: SparkSession, folder: str, days: int) -> None:
    """Set back the modification times of a folder's files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def _untrusted(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of which some lack the key, have a date in another spelling, or exceed their type."""
    event = F.col("event_id")
    rows = inputs.raw_listings(spark, sf)
    return rows.select(
        F.when(event % 17 != 0, F.col("prop_id")).alias("prop_id"),
        F.when(event % 19 == 0, F.date_format("date", "dd/MM/yyyy")).otherwise(F.col("date").cast("string")).alias("date"),
        F.when(event % 23 == 0, F.lit(3_000_000_000)).otherwise(F.col("price").cast("bigint")).alias("price"),
        F.col("scraped_at").cast("string").alias("scraped_at"),
    )


@register
def incremental_untrusted_prices(spark, sf):
    """Landing rows of any content: what can be stored is, and the next run goes on."""
    house = _house(spark, "untrusted")
    for _ in range(2):
        write_landing(_untrusted(spark, sf), house.landing, "prices", date(2024, 2, 1))
        pipeline.run_silver(spark, house, RunLog(spark))
    return house.prices.read(spark)


@register
def incremental_rejects(spark, sf):
    """Rows that could not be stored, counted by reason."""
    house = _house(spark, "rejects")
    write_landing(_untrusted(spark, sf), house.landing, "prices", date(2024, 2, 1))
    pipeline.run_silver(spark, house, RunLog(spark))
    return house.rejects("prices").read(spark).groupBy("reason").agg(F.count(F.lit(1)).alias("num_rows"))


@register
def incremental_replayed_batch(spark, sf):
    """A batch with keys in several files and NULL keys, handled twice under one id."""
    table = AppendTable(f"{scratch_path(spark, 'replay')}/prices", SILVER["silver_prices"], "date")
    path = scratch_path(spark, "files")
    _untrusted(spark, sf).repartition(8).write.parquet(path)
    for _ in range(2):
        insert_prices(table)(spark.read.parquet(path), 0)
    return table.read(spark)


@register
def ingest_pages(spark, sf):
    """Price rows landed from the pages that pass their gate."""
    root = scratch_path(spark, "ingest")
    ingest.run_ingest(
        inputs.gate_pages(spark, sf), ["page_id"], root, date(2024, 2, 1),
        F.lit("2024-02-01T12:00:00").cast("timestamp_ntz"), on_bad_page="drop",
    )
    return read_landing(spark, root, "prices")


@register
def ingest_gate_verdicts(spark, sf):
    """Every page with its failures and verdict; exactly a tenth of bad records passes."""
    listings = ingest.parsed_once(
        inputs.gate_pages(spark, sf), ["page_id"], F.lit("2024-02-01T12:00:00").cast("timestamp_ntz")
    )
    return ingest.page_verdicts(listings, ["page_id"]).withColumn("rate", F.round("rate", 9))


@register
def ingest_postcode_gate(spark, sf):
    """Rows landed by postcode where the gate on missing postcodes passes; where it fails, nothing lands."""
    pages, day = inputs.gate_pages(spark, sf), date(2024, 2, 1)
    scraped = F.lit("2024-02-01T12:00:00").cast("timestamp_ntz")
    found = []
    for name, near in (("named", "SW1 1AA"), ("blank", "")):
        root = scratch_path(spark, f"gate-{name}")
        sites = spark.createDataFrame([(near, 51.5, -0.1), ("SW9 1AA", 52.0, 0.3)], "postcode string, latitude double, longitude double")
        verdict = "passed"
        try:
            ingest.run_ingest(pages, ["page_id"], root, day, scraped, centroids=sites, on_bad_page="drop")
            landed = read_landing(spark, root, "properties").groupBy("postcode").agg(F.count(F.lit(1)).alias("num_rows"))
        except QualityFailure:
            verdict = "refused" if not path_exists(spark, f"{root}/properties") else "landed in spite of the gate"
            landed = spark.range(1).select(F.lit("").alias("postcode"), F.lit(0).cast("bigint").alias("num_rows"))
        found.append(landed.select(F.lit(name).alias("case"), F.lit(verdict).alias("verdict"), "postcode", "num_rows"))
    return found[0].unionByName(found[1])


@register
def landing_preview(spark, sf):
    """The dry run's row count and sample, as a row beside the count of all rows."""
    prices = inputs.raw_prices(spark, sf).select("prop_id", "date", "price")
    n, sample = preview(prices)
    return prices.agg(F.count(F.lit(1)).alias("num_rows")).withColumns({
        "previewed": F.lit(n).cast("bigint"), "prop_id": F.lit(sample["prop_id"]).cast("bigint"), "date": F.lit(sample["date"]),
    })


@register
def catalog_table_of_prices(spark, sf):
    """A table created twice with fixed columns, filled and read by its name."""
    path, name = scratch_path(spark, "catalog"), f"prices_{uuid4().hex}"
    for _ in range(2):
        create_table(spark, name, SILVER["silver_prices"], path, ["date"])
    silver_prices(spark, sf).write.mode("append").insertInto(name)
    return spark.table(name)


@register
def end_to_end_large_ids(spark, sf):
    """Ids beyond 32 bits from landing to gold."""
    house = _house(spark, "ids")
    for first, run_date in ((True, date(2024, 2, 1)), (False, date(2024, 2, 8))):
        rows = inputs.batch_properties(spark, sf, first).withColumn("prop_id", F.col("prop_id") + 3_000_000_000)
        for dataset in BOTH:
            write_landing(rows, house.landing, dataset, run_date)
        pipeline.run_silver(spark, house, RunLog(spark))
    pipeline.run_gold(spark, house, RunLog(spark))
    return spark.read.parquet(f"{house.gold}/gold_current_properties").select("prop_id", "area_code", "price")


@register
def legacy_expectation_counts(spark, sf):
    raw = inputs.raw_prices(spark, sf).withColumn("price", F.col("price") - 500)
    return pipeline.legacy_expectations(
        {"landing_properties": inputs.raw_properties(spark, sf), "landing_prices": raw}
    )


@register
def end_to_end_gold_property_fact(spark, sf):
    house = _two_runs(spark, sf, "fact")
    pipeline.run_gold(spark, house, RunLog(spark))
    return spark.read.parquet(f"{house.gold}/gold_property_fact")


@register
def incremental_gold_property_fact(spark, sf):
    """The fact by date after two deliveries, each bringing only the dates it changed up to date."""
    house, log = _house(spark, "refresh"), RunLog(spark)
    for first in (True, False):
        _deliver(spark, sf, house, first)
        pipeline.run_silver(spark, house, log, track=True)
        pipeline.refresh_gold(spark, house, log)
    fact = read_table(spark, f"{house.gold}/{pipeline.FACT_BY_DATE}")
    return fact.select("date", "area_code", "avg_price", "median_price", "num_properties", "month", "year")


def _change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a change of its property, with its number in the feed; every eleventh deletes it."""
    return inputs.raw_listings(spark, sf).select(
        "prop_id", F.col("event_id").alias("change"), (F.col("event_id") % 11 == 0).alias("gone"), "address", "price", "date"
    )


@register
def change_feed_in_batches(spark, sf):
    """A feed with deletes in five batches of any order, one of which comes twice."""
    feed = _change_feed(spark, sf)
    data = struct_of("prop_id BIGINT, address STRING, price INT, date DATE")
    table = KeyedTable(f"{scratch_path(spark, 'feed')}/listings", changes.state_schema(data), ["prop_id"])
    handle = apply_changes(table, "change", lambda: F.col("gone"), keep=2)
    for batch, part in enumerate((3, 0, 4, 0, 1, 2)):
        handle(feed.where(F.pmod(F.col("change") * 7, F.lit(5)) == part), batch)
    return changes.live(table.read(spark))


@register
def stream_latest_per_key(spark, sf):
    """The newest event of every user and day, from a stream in update mode into a stored state."""
    root = scratch_path(spark, "latest")
    stream = spark.readStream.schema(inputs.table(spark, sf, "events").schema).parquet(f"{sf}/event[s].parquet")
    rows = stream.select(
        F.col("user_id").alias("prop_id"), F.to_date("ts").alias("date"), F.col("ts").cast("timestamp").alias("seen"),
        "event_id", "event_type",
    )
    data = struct_of("prop_id BIGINT, date DATE, event_id BIGINT, event_type STRING")
    table = KeyedTable(f"{root}/table", changes.state_schema(data), ["prop_id", "date"])

    def newest(batch: DataFrame, batch_id: int) -> None:
        order = batch.withColumn("seen_at", F.unix_micros("seen")).drop("seen")
        apply_changes(table, "seen_at", lambda: F.lit(False), keep=2)(order, batch_id)

    updates = stream_latest(rows, ["prop_id", "date"], "seen", "60 days", tie=["event_id"])
    stream_to_state(updates, f"{root}/checkpoint", newest).awaitTermination()
    return changes.live(table.read(spark))


@register
def end_to_end_quality(spark, sf):
    """Two deliveries through silver, gold and all rulesets."""
    house = _two_runs(spark, sf, "quality")
    index = inputs.raw_index(spark, sf)
    write_landing(index, house.landing, "spy_prices", date(2024, 2, 1), on_empty="fail")
    verdicts, _ = pipeline.run_all(spark, house)
    return verdicts.withColumn("metric", F.round("metric", 9))


@register
def end_to_end_metrics(spark, sf):
    """Rows written by each stage over two deliveries."""
    log = RunLog(spark)
    house = _two_runs(spark, sf, "metrics", log)
    pipeline.run_gold(spark, house, log)
    return log.frame().groupBy("dataset", "stage").agg(F.sum("rows").alias("rows"))


@register
def stream_first_per_day(spark, sf):
    """Streaming dedupe: the (property, day) pairs of all events."""
    root = scratch_path(spark, "dedupe")
    schema = inputs.table(spark, sf, "events").schema
    # As a pattern the path may be one file or a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")
    keyed = stream.select(
        F.col("user_id").alias("prop_id"), F.to_date("ts").alias("date"), F.col("ts").cast("timestamp").alias("seen")
    )
    # These events span 30 days, so 60 days of lateness keep every key until the end. Over a longer span keys older
    # than that are forgotten: rows that come later than 60 days are dropped, and a pair may then appear once more.
    unique = stream_dedupe(keyed, ["prop_id", "date"], "seen", "60 days").select("prop_id", "date")
    unique.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option(
        "path", f"{root}/out"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("prop_id bigint, date date").parquet(f"{root}/out")


@register
def replace_current_table(spark, sf):
    """A stored table replaced twice holds the last content only."""
    path = f"{scratch_path(spark, 'replace')}/table"
    props = silver_properties(spark, sf)
    replace_table(props, path, SILVER["silver_properties"])
    replace_table(props.where(F.col("area_code").isin(CHOSEN)), path, SILVER["silver_properties"])
    return spark.read.schema(SILVER["silver_properties"]).parquet(path).select("prop_id", "area_code", "last_seen")
