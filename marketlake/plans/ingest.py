"""Pages to landing files, with the gates on the way."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.nearest import nearest_join
from marketlake.operators.quality import QualityFailure, check_postcodes, failure_rate
from marketlake.schemas import PARSE_FAILURE_THRESHOLD, POSTCODE_MISSING_THRESHOLD
from marketlake.session import scratch_path
from marketlake.sinks.writers import write_landing
from marketlake.sources.pages import extract_embedded_json, parse_listings, split_listings


@dataclass(frozen=True)
class Ingested:
    """What a run wrote, and its verdict on every page."""

    properties: int
    prices: int
    verdicts: DataFrame


def parsed_once(pages: DataFrame, keys: Sequence[str], scraped_at: Column) -> DataFrame:
    """Listings of all pages, parsed and stored, with the status of their page."""
    results = extract_embedded_json(pages, keys)
    listings = parse_listings(results.withColumn("_page", F.struct(*keys, "status")), ["_page"], scraped_at)
    flat = listings.select("_page.*", *[c for c in listings.columns if c != "_page"])
    path = scratch_path(pages.sparkSession, "listings")
    flat.write.parquet(path)
    return pages.sparkSession.read.schema(flat.schema).parquet(path)


def page_verdicts(listings: DataFrame, keys: Sequence[str], threshold: float = PARSE_FAILURE_THRESHOLD) -> DataFrame:
    """Per page: total, failures, rate and ``verdict``.

    It is ``ok``, ``too many failures`` (a rate above the threshold), ``no listings``, or why
    the page could not be read: ``no_script``, ``bad_json`` or ``no_path``.
    """
    rates = failure_rate(listings, [*keys, "status"], F.col("is_bad"), F.col("is_listing"))
    verdict = (
        F.when(F.col("status") != "ok", F.col("status"))
        .when(F.col("total") == 0, "no listings")
        .when(F.col("rate") > threshold, "too many failures")
        .otherwise("ok")
    )
    return rates.select(*keys, "total", "failures", "rate", verdict.alias("verdict"))


def run_ingest(
    pages: DataFrame,
    keys: Sequence[str],
    root: str,
    run_date: date,
    scraped_at: Column,
    centroids: DataFrame | None = None,
    x_scale: float = 1.0,
    on_bad_page: str = "fail",
    parse_threshold: float = PARSE_FAILURE_THRESHOLD,
    postcode_threshold: float = POSTCODE_MISSING_THRESHOLD,
) -> Ingested:
    """Parse pages once, judge each one, add postcodes, and write the run's landing files.

    A page that fails its gate ends the run before anything is written, or with
    ``on_bad_page="drop"`` gives no rows. With ``centroids`` (postcode, latitude, longitude)
    properties get the nearest one's postcode, and too many without one end the run; without
    centroids postcodes stay NULL and are not judged.
    """
    if on_bad_page not in ("fail", "drop"):
        raise ValueError("on_bad_page is 'fail' or 'drop'")
    listings = parsed_once(pages, keys, scraped_at)
    verdicts = page_verdicts(listings, keys, parse_threshold)
    bad = verdicts.where("verdict <> 'ok'")
    if on_bad_page == "fail":
        tally = bad.agg(F.count("*").alias("n"), F.min(F.struct(*verdicts.columns)).alias("one")).first()
        if tally["n"]:
            raise QualityFailure(f"{tally['n']} page(s) failed, for instance {tally['one'].asDict()}")
    else:
        listings = listings.join(bad, list(keys), "left_anti")
    properties, prices = split_listings(listings)
    if centroids is None:
        properties = properties.withColumn("postcode", F.lit(None).cast("string"))
    else:
        found = nearest_join(properties, centroids, "postcode", x_scale=x_scale).drop("distance")
        path = scratch_path(pages.sparkSession, "located")
        found.write.parquet(path)
        properties = pages.sparkSession.read.schema(found.schema).parquet(path)
        check_postcodes(properties, postcode_threshold)
    return Ingested(
        write_landing(properties, root, "properties", run_date), write_landing(prices, root, "prices", run_date), verdicts
    )
