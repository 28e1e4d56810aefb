"""Landing rows to keyed silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.areas import area_code
from marketlake.operators.dedupe import dedupe_latest
from marketlake.operators.enrich import fill_from, needs_enrichment
from marketlake.operators.merge import merge_insert_only, merge_upsert
from marketlake.operators.nearest import nearest_join
from marketlake.schemas import SILVER, as_timestamp, conform

# ---- fixed values: names and predicates of the row expectations ----
LEGACY_EXPECTATIONS = {
    "postcode_present": "postcode IS NOT NULL",
    "valid_prop_id": "prop_id IS NOT NULL",
    "valid_coordinates": "latitude IS NOT NULL AND longitude IS NOT NULL",
}


def _unread(name: str, kind: str) -> Column:
    """Whether a value is there but is none of this type."""
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def reject_reason(dataset: str) -> Column:
    """Why a landing row can't be stored: its key is missing, or a value is none of its type. NULL for good rows."""
    if dataset == "properties":
        return F.when(F.col("prop_id").isNull(), "no prop_id").when(_unread("scraped_at", "timestamp_ntz"), "bad scraped_at")
    reason = F.when(F.col("date").isNull(), "no date").when(_unread("date", "date"), "bad date")
    if dataset == "prices":
        return reason.when(F.col("prop_id").isNull(), "no prop_id").when(_unread("price", "int"), "bad price").when(
            _unread("scraped_at", "timestamp_ntz"), "bad scraped_at"
        )
    return reason.when(_unread("loaded_at", "date"), "bad loaded_at")


def accepted(raw: DataFrame, dataset: str) -> DataFrame:
    return raw.where(reject_reason(dataset).isNull())


def rejected(raw: DataFrame, dataset: str) -> DataFrame:
    """The other rows, as ``reason`` and ``record`` (JSON)."""
    marked = raw.select(reject_reason(dataset).alias("reason"), F.to_json(F.struct(*raw.columns)).alias("record"))
    return marked.where("reason IS NOT NULL")


def incoming_properties(raw: DataFrame, normalise: bool = False) -> DataFrame:
    """One row per property of the batch: its latest scrape, with first and last seen date and area."""
    stamped = accepted(raw, "properties").withColumn("scraped_at", as_timestamp(F.col("scraped_at")))
    latest = dedupe_latest(
        stamped, ["prop_id"], ["scraped_at"], ["address", "latitude", "longitude", "postcode"],
        first_seen=("scraped_at", "first_seen"),
    )
    shaped = latest.withColumn("area_code", area_code(F.col("postcode"), normalise)).withColumnRenamed(
        "scraped_at", "last_seen"
    )
    return conform(shaped, SILVER["silver_properties"])


def incoming_prices(raw: DataFrame) -> DataFrame:
    """One price per property and date: the latest scrape's."""
    typed = accepted(raw, "prices").select(
        "prop_id", F.col("price").try_cast("int").alias("price"), F.col("date").try_cast("date").alias("date"),
        as_timestamp(F.col("scraped_at")).alias("scraped_at"),
    )
    latest = dedupe_latest(typed, ["prop_id", "date"], ["scraped_at"], ["price"])
    return conform(latest, SILVER["silver_prices"])


def incoming_index(raw: DataFrame) -> DataFrame:
    """One close per date: the last loaded one."""
    typed = accepted(raw, "spy_prices").select(
        F.col("date").try_cast("date").alias("date"), "close", F.col("loaded_at").try_cast("date").alias("loaded_at")
    )
    return dedupe_latest(typed, ["date"], ["loaded_at"], ["close"]).select("date", "close")


def merge_properties(target: DataFrame, incoming: DataFrame, late_first_seen: bool = False) -> DataFrame:
    """The property table after a batch.

    A newer row updates; it keeps the known postcode and area where it brings none, and the
    earlier first date. An older row changes nothing, or with ``late_first_seen`` only
    lowers the first date.
    """
    earliest = {"first_seen": lambda s, t: F.least(t("first_seen"), s("first_seen"))}
    return merge_upsert(
        target, incoming, ["prop_id"],
        when_newer=lambda s, t: s("last_seen") > t("last_seen"),
        set_exprs={
            "postcode": lambda s, t: F.coalesce(s("postcode"), t("postcode")),
            "area_code": lambda s, t: F.coalesce(s("area_code"), t("area_code")),
            **earliest,
        },
        when_older=earliest if late_first_seen else None,
    )


def _days(raw: DataFrame | None) -> DataFrame | None:
    return None if raw is None else raw.select(F.col("date").try_cast("date").alias("date"))


def new_prices(target: DataFrame, incoming: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Batch prices of (property, date) pairs not stored yet; stored ones never change.

    ``raw`` is the landing batch, if at hand, to take the range of dates from.
    """
    return merge_insert_only(target, incoming, ["prop_id", "date"], bound_by="date", bounds=_days(raw))


def new_index_rows(target: DataFrame, incoming: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Batch closes of dates not stored yet."""
    return merge_insert_only(target, incoming, ["date"], bound_by="date", bounds=_days(raw))


def with_nearest_postcodes(
    incoming: DataFrame, known: DataFrame, centroids: DataFrame, x_scale: float = 1.0, normalise: bool = False
) -> DataFrame:
    """The batch with postcodes for those properties that have none, neither here nor in ``known``.

    ``centroids`` holds ``postcode`` (unique), ``latitude`` and ``longitude``. Properties whose
    postcode is already stored are not looked up again; the merge keeps it.
    """
    blank = incoming.where(F.coalesce(F.col("postcode"), F.lit("")) == "")
    unknown = needs_enrichment(blank, known, ["prop_id"], "postcode").select("prop_id", "latitude", "longitude")
    found = nearest_join(unknown, centroids, "postcode", x_scale=x_scale)
    filled = fill_from(incoming, found, ["prop_id"], "postcode")
    return filled.withColumn("area_code", area_code(F.col("postcode"), normalise))


# ---- the earlier generation: full recompute, other column names ----


def legacy_properties(raw: DataFrame) -> DataFrame:
    """Latest scrape per property with ``scraped_at`` and ``first_scraped_at`` dates."""
    stamped = raw.withColumn("scraped_at", as_timestamp(F.col("scraped_at")))
    latest = dedupe_latest(
        stamped, ["prop_id"], ["scraped_at"], ["address", "latitude", "longitude", "postcode"],
        first_seen=("scraped_at", "first_scraped_at"),
    )
    return latest.withColumns({
        "scraped_at": F.col("scraped_at").cast("date"),
        "first_scraped_at": F.col("first_scraped_at").cast("date"),
        "area_code": area_code(F.col("postcode")),
    })


def legacy_prices(raw: DataFrame) -> DataFrame:
    """Positive prices, one per property and scrape date (the latest scrape's)."""
    positive = raw.where(F.col("price") > 0).select(
        "prop_id", F.col("price").try_cast("int").alias("price"), as_timestamp(F.col("scraped_at")).alias("stamp"),
    )
    keyed = positive.withColumn("scraped_at", F.col("stamp").cast("date"))
    return dedupe_latest(keyed, ["prop_id", "scraped_at"], ["stamp"], ["price"]).select(
        "prop_id", "price", "scraped_at"
    )


def legacy_index(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.col("date").try_cast("date").alias("date"), "close", F.col("loaded_at").try_cast("date").alias("loaded_at")
    )
    return dedupe_latest(typed, ["date"], ["loaded_at"], ["close"])
