"""Listing and rate records out of HTML pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.dates import flexible_date, iso_date, iso_timestamp
from marketlake.schemas import DATA_SCRIPT_ID, RESULTS_PATH


def script_body(html: Column, script_id: str = DATA_SCRIPT_ID) -> Column:
    """Text of the first script element whose ``id`` attribute is this; NULL if the page has none.

    Comments and the bodies of other scripts are read over as a whole, so that a script within
    them does not count.
    """
    name = rf"\Q{script_id}\E"
    value = rf"""(?:"{name}"|'{name}'|{name}(?=[\s>]))"""
    # An attribute: white space, a name, and perhaps a value.
    attribute = r"""\s+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?"""
    wanted = rf"script(?=\s)(?:(?!\s+id\s*=){attribute})*+\s+id\s*=\s*{value}[^>]*(>.*?)</script"
    # One pass: what is read over gives an empty piece, the body sought one that begins with its tag's end.
    pieces = F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{wanted}|!--.*?-->|script\b.*?</script)"), F.lit(1))
    return F.substring(F.get(F.filter(pieces, lambda p: p != ""), F.lit(0)), 2, (1 << 31) - 1)


def extract_embedded_json(
    pages: DataFrame,
    keys: Sequence[str],
    html_col: str = "html",
    script_id: str = DATA_SCRIPT_ID,
    path: str = RESULTS_PATH,
) -> DataFrame:
    """Page key, ``results`` (VARIANT at ``path``) and ``status``.

    ``status`` is ``ok``, ``no_script``, ``bad_json`` or ``no_path``.
    """
    parsed = pages.select(*keys, script_body(F.col(html_col), script_id).alias("_text")).withColumn(
        "_data", F.try_parse_json("_text")
    )
    results = F.try_variant_get("_data", path, "variant")
    status = (
        F.when(F.col("_text").isNull(), "no_script")
        .when(F.col("_data").isNull(), "bad_json")
        .when(F.col("results").isNull(), "no_path")
        .otherwise("ok")
    )
    return parsed.withColumn("results", results).select(*keys, "results", status.alias("status"))


def parse_listings(results: DataFrame, keys: Sequence[str], scraped_at: Column) -> DataFrame:
    """One row per listing record with ``is_bad``; a page without records gives one row of NULLs.

    A record is bad if id, price or a coordinate is missing or not a number, or if the
    address key is missing (an explicit null address is fine).
    """
    def typed(record: Column) -> Column:
        def field(path: str, kind: str) -> Column:
            return F.try_variant_get(record, path, kind)

        return F.struct(
            F.lit(True).alias("is_listing"),
            field("$.id", "bigint").alias("prop_id"),
            field("$.price.amount", "bigint").alias("price"),
            field("$.displayAddress", "string").alias("address"),
            F.round(field("$.location.latitude", "double"), 8).alias("latitude"),
            F.round(field("$.location.longitude", "double"), 8).alias("longitude"),
            field("$.displayAddress", "variant").isNull().alias("no_address"),
        )

    # Records are typed inside the array: a filter on the fields then does not work them out again.
    records = F.transform(F.try_variant_get("results", "$.properties", "array<variant>"), typed)
    fields = results.select(*keys, scraped_at.alias("scraped_at"), F.explode_outer(records).alias("_l")).select(
        *keys, "scraped_at", F.coalesce("_l.is_listing", F.lit(False)).alias("is_listing"),
        "_l.prop_id", "_l.price", "_l.address", "_l.latitude", "_l.longitude", "_l.no_address",
    )
    unset = [F.col(c).isNull() for c in ("prop_id", "price", "latitude", "longitude")]
    bad = unset[0] | unset[1] | unset[2] | unset[3] | F.col("no_address")
    return fields.withColumn("is_bad", F.col("is_listing") & bad).drop("no_address")


def split_listings(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records as landing property rows (without postcode) and landing price rows."""
    good = listings.where(F.col("is_listing") & ~F.col("is_bad"))
    day = F.col("scraped_at").cast("date").cast("string").alias("date")
    iso = iso_timestamp(F.col("scraped_at")).alias("scraped_at")
    return good.select("prop_id", "address", "latitude", "longitude", iso), good.select("prop_id", day, "price", iso)


def page_indices(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per page: ``total`` (default 1), ``indices`` (the positive ones, in given order) and ``status``.

    The status is ``ok``, ``no_results``, or ``bad_index`` if an option is no number; such options are left out.
    """
    options = F.coalesce(
        F.try_variant_get("results", "$.pagination.options", "array<variant>"), F.array().cast("array<variant>")
    )
    read = F.transform(options, lambda o: F.try_variant_get(o, "$.value", "int"))
    paged = results.select(
        *keys, F.col("results").isNull().alias("_none"),
        F.coalesce(F.try_variant_get("results", "$.pagination.total", "int"), F.lit(1)).alias("total"),
        read.alias("_read"),
    )
    status = F.when(F.col("_none"), "no_results").when(
        F.exists("_read", lambda i: i.isNull()), "bad_index"
    ).otherwise("ok")
    return paged.select(*keys, "total", F.filter("_read", lambda i: i > 0).alias("indices"), status.alias("status"))


# Text of a table cell, in steps: tags gone, the usual entities decoded, white space at the ends cut. Each step reads its
# input several times, so callers hand it the stored result of the step before, never an expression. Patterns run only on
# cells that hold what they replace.
def _untagged(cell: Column) -> Column:
    return F.when(F.contains(cell, F.lit("<")), F.regexp_replace(cell, r"(?s)<[^>]*>", "")).otherwise(cell)


def _decoded(text: Column) -> Column:
    plain = text
    for entity, char in (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")), plain).otherwise(text)


def _trimmed(text: Column) -> Column:
    odd = reduce(or_, [F.contains(text, F.lit(c)) for c in ("\u00a0", "  ", "\n", "\t", "\r", "\x0b", "\f")])
    return F.trim(F.when(odd, F.regexp_replace(text, "[\\s\u00a0]+", " ")).otherwise(text))


_TEXT_STEPS = (_untagged, _decoded, _trimmed)


def number_of(text: Column) -> Column:
    """The number in a cell, with or without thousands marks; NULL if it is none."""
    marked = F.contains(text, F.lit(",")) & text.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d*)?$")
    plain = F.when(marked, F.replace(text, F.lit(","), F.lit(""))).otherwise(text)
    # A failed cast costs an exception, so only what may be a number is tried: digits, an infinity or a NaN.
    return F.when(text.rlike("(?i)[0-9]|inf|nan"), plain.try_cast("double"))


def _inside(tag: str) -> str:
    """Pattern of an element's start tag, its content up to the first end tag (group 1) and that end tag.

    The content is taken in runs between tags, which costs far less than trying for the end at every character.
    """
    end = rf"/{tag}\s*>"
    return rf"(?i)<{tag}\b[^>]*>((?:[^<]++|<(?!{end}))*+)<{end}"


def _rows(html_col: str) -> Column:
    """The first table's rows as HTML."""
    return F.regexp_extract_all(F.regexp_extract(html_col, _inside("table"), 1), F.lit(_inside("tr")), F.lit(1))


def _cells(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(_inside("t[dh]")), F.lit(1))


def _table_rows(html_col: str, value_name: str) -> Column:
    """The first table's rows as structs of position, day and value."""
    def cells(row: Column) -> Column:
        return reduce(F.transform, _TEXT_STEPS, F.slice(_cells(row), 1, 2))

    def typed(cell: Column, position: Column) -> Column:
        return F.struct(
            position.alias("position"),
            flexible_date(F.get(cell, F.lit(0))).alias("day"),
            number_of(F.get(cell, F.lit(1))).alias(value_name),
        )

    return F.transform(F.transform(_rows(html_col), cells), typed)


def extract_html_table(
    pages: DataFrame,
    keys: Sequence[str],
    loaded_at: Column,
    html_col: str = "html",
    value_name: str = "rate",
) -> DataFrame:
    """First table of each page as (date, value, loaded_at) rows, from its first two columns.

    Numbers may have thousands marks. Rows whose first cell is no date, such as the header,
    are left out, and so are those without a number: :func:`skipped_rows` counts them. A page
    without a table gives no rows.
    """
    # Cells are cut and typed as columns of their own rows, in generated code. Each ``inline`` of one row ends a step:
    # what comes after it reads the step's results and does not work them out again.
    cut = pages.select(*keys, F.posexplode(_rows(html_col)).alias("position", "_row"))
    cut = cut.select(*keys, "position", F.inline(F.array(F.struct(_cells(F.col("_row")).alias("_cells")))))
    texts = cut.select(*keys, "position", F.get("_cells", F.lit(0)).alias("_day"), F.get("_cells", F.lit(1)).alias("_number"))
    for step in _TEXT_STEPS:
        both = F.struct(*[step(F.col(c)).alias(c) for c in ("_day", "_number")])
        texts = texts.select(*keys, "position", F.inline(F.array(both)))
    return typed_cells(texts, keys, loaded_at, value_name)


def typed_cells(texts: DataFrame, keys: Sequence[str], loaded_at: Column, value_name: str = "rate") -> DataFrame:
    """Rows of texts (keys, position, ``_day``, ``_number``) that hold a date and a number."""
    typed = texts.select(*keys, "position", F.inline(F.array(F.struct(
        flexible_date(F.col("_day")).alias("_date"), number_of(F.col("_number")).alias(value_name)
    ))))
    return typed.where(F.col("_date").isNotNull() & F.col(value_name).isNotNull()).select(
        *keys, "position", iso_date(F.col("_date")).alias("date"), value_name, iso_date(loaded_at).alias("loaded_at"),
    )


def skipped_rows(pages: DataFrame, keys: Sequence[str], html_col: str = "html") -> DataFrame:
    """Per page: how many table rows there are, how many have no date and how many a date but no number."""
    # The rows are worked out once, as a step of their own (see extract_html_table), and then counted three times.
    rows = F.coalesce(_table_rows(html_col, "value"), F.array())
    return pages.select(*keys, F.inline(F.array(F.struct(rows.alias("_rows"))))).select(
        *keys, F.size("_rows").alias("num_rows"),
        F.size(F.filter("_rows", lambda r: r["day"].isNull())).alias("no_date"),
        F.size(F.filter("_rows", lambda r: r["day"].isNotNull() & r["value"].isNull())).alias("no_number"),
    )
