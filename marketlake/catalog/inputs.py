"""The provided tables in the shapes the operators expect, derived by Spark in full."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.areas import area_code
from marketlake.schemas import DATA_SCRIPT_ID, struct_of


# Columns of the provided tables, so that no read has to infer them.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
              " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
                " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING,"
                " l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(struct_of(TABLES[name])).parquet(f"{sf_dir}/{name}.parquet")


def postcode_of(number: Column) -> Column:
    """A postcode from a number: listed, unlisted (SW21-SW25), suffixed (SW1A) and missing ones occur."""
    suffix = F.when(number % 25 == 0, "A").otherwise("")
    text = F.concat(
        F.lit("SW"), (number % 25 + 1).cast("string"), suffix, F.lit(" "), (number % 9).cast("string"), F.lit("AA")
    )
    return F.when(number % 11 != 0, text)


def latitude_of(number: Column) -> Column:
    return F.lit(51.4) + (number % 100) / F.lit(1000.0)


def longitude_of(number: Column) -> Column:
    return F.lit(-0.2) + (number % 77) / F.lit(1000.0)


def price_of(value: Column) -> Column:
    return F.floor(value * 100).cast("int")


def in_parts(spark: SparkSession, rows: DataFrame, key: str) -> DataFrame:
    """Rows by their key in as many parts as the session shuffles in, as large tables come in many files."""
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one scrape of the listing ``user_id``."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id AS prop_id",
        "concat(cast(event_id AS string), ' Test Street') AS address",
        "51.4D + (user_id % 100) / 1000D AS latitude",
        "-0.2D + (user_id % 77) / 1000D AS longitude",
        "ts AS scraped_at",
        """CASE WHEN user_id % 11 <> 0 THEN concat('SW', cast(user_id % 25 + 1 AS string),
             if(user_id % 25 = 0, 'A', ''), ' ', cast(user_id % 9 AS string), 'AA') END AS postcode""",
        "cast(ts AS date) AS date",
        "cast(floor(value * 100) AS int) AS price",
    )


def raw_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listings(spark, sf_dir).select(
        "prop_id", "address", "latitude", "longitude", "scraped_at", "postcode"
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listings(spark, sf_dir).select("prop_id", "date", "price", "scraped_at")


def raw_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a loaded close of its day; several loads per day, some of them tied."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        day.alias("date"),
        F.round("o_totalprice", 2).alias("close"),
        F.date_add(day, (F.col("o_orderkey") % 3).cast("int")).alias("loaded_at"),
    )


def batch_properties(spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    """The listings as two deliveries, some scrapes without a postcode.

    The second delivery holds newer rows of most properties, only older rows of every
    fifth, and every seventh property for the first time.
    """
    rows = raw_listings(spark, sf_dir).withColumn(
        "postcode", F.when(F.col("event_id") % 5 != 0, F.col("postcode"))
    )
    day, prop = F.dayofmonth("scraped_at"), F.col("prop_id")
    early = (prop % 7 != 0) & F.when(prop % 5 == 0, day > 10).otherwise(
        (day <= 20) & (F.col("event_id") % 2 == 0)
    )
    return rows.where(early if first else ~early)


def large_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items as prices by year and parts as properties: few groups with very many rows."""
    prices = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("prop_id"),
        F.trunc("l_shipdate", "year").alias("date"),
        F.floor("l_extendedprice").cast("int").alias("price"),
    )
    key = F.col("p_partkey")
    props = table(spark, sf_dir, "part").select(
        key.alias("prop_id"), area_code(postcode_of(key)).alias("area_code")
    )
    return prices, props


def wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a number that runs through the whole range of 64 bits.

    They are dealt out in parts: a task that counts its own rows first holds all its values, of which nearly all differ.
    """
    item = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(20,0)")
    place = (item * F.lit(1_234_567_890_123_457).cast("decimal(16,0)")) % F.lit(2**63 - 1).cast("decimal(19,0)")
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)
    items = in_parts(spark, table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey")
    return items.select("l_returnflag", (place.cast("bigint") * sign).alias("value"))


def date_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's date as its source writes it.

    Of twelve sources some write the day first and some the month; of two only the first days of a month are given, one of
    them on days that are the month's number, too; one changes its layout at every third order; one writes words. Every 40th cell is
    no date.
    """
    day, source = F.to_date("o_orderdate"), (F.col("o_custkey") % 12).cast("int")
    early = F.date_add(F.trunc(day, "month"), (F.dayofmonth(day) % 12).cast("int"))
    twin = F.make_date(F.year(day), F.month(day), F.month(day))
    form = lambda d, f: F.date_format(d, f)
    cell = (
        F.when(F.col("o_orderkey") % 40 == 0, "n/a")
        .when(source < 4, form(day, "dd/MM/yyyy")).when(source < 7, form(day, "M/d/yyyy"))
        .when(source == 7, form(day, "yyyyMMdd")).when(source == 8, form(early, "MM/dd/yyyy"))
        .when(source == 9, form(twin, "d-M-yyyy"))
        .when(source == 10, F.when(F.col("o_orderkey") % 3 == 0, form(day, "dd.MM.yyyy")).otherwise(form(day, "MM.dd.yyyy")))
        .otherwise("not known")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", source.alias("source"), cell.alias("cell"))


def _listing(event: Column, i: Column) -> Column:
    """One listing record as a struct; every 37th lacks all but its id."""
    number = event * 5 + i
    whole = number % 37 != 0
    return F.struct(
        number.cast("string").alias("id"),
        F.when(whole, F.struct((F.col("_price") + i).alias("amount"))).alias("price"),
        F.when(whole, F.concat(number.cast("string"), F.lit(" High Street"))).alias("displayAddress"),
        F.when(
            whole,
            F.struct(latitude_of(number).alias("latitude"), longitude_of(number).alias("longitude")),
        ).alias("location"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an HTML page with up to five listings in its embedded JSON.

    Events divisible by 10 give an empty page, by 23 one without the script, by 29 broken
    JSON and by 31 JSON without search results (the last rule that fits counts).
    """
    event = F.col("event_id")
    numbers = F.filter(F.sequence(F.lit(0), F.lit(4)), lambda i: event % 10 != 0)
    records = F.transform(numbers, lambda i: _listing(event, i.cast("bigint")))
    options = F.transform(
        F.sequence(F.lit(0), (event % 4).cast("int")), lambda i: F.struct((i * 24).cast("string").alias("value"))
    )
    results = F.struct(
        records.alias("properties"),
        F.struct((event % 4 + 1).alias("total"), options.alias("options")).alias("pagination"),
    )
    body = F.to_json(F.struct(F.struct(F.struct(results.alias("searchResults")).alias("pageProps")).alias("props")))
    data = (
        F.when(event % 31 == 0, F.lit('{"props":{"pageProps":{}}}'))
        .when(event % 29 == 0, F.lit('{"props":'))
        .otherwise(body)
    )
    script = F.concat(
        F.lit(f'<script id="{DATA_SCRIPT_ID}" type="application/json">'), data, F.lit("</script>")
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var a = 1;</script></head><body>"),
        F.when(event % 23 == 0, F.lit("")).otherwise(script),
        F.lit("</body></html>"),
    )
    events = in_parts(spark, table(spark, sf_dir, "events").select("event_id", "ts", "value"), "event_id")
    return events.withColumn("_price", price_of(F.col("value"))).select(
        event.alias("page_id"), F.col("ts").alias("scraped_at"), html.alias("html")
    )


def gate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a page of 9 or 10 records, of which one is bad on two thirds of the pages.

    A page of 10 is then just within a tenth, one of 9 above it. Keys divisible by 11 give a page without records, by
    13 one whose script is commented out.
    """
    key = F.col("c_custkey")

    def record(i: Column) -> Column:
        number = key * 10 + i
        whole = (i != 4) | (key % 3 == 0)
        return F.struct(
            number.cast("string").alias("id"), F.struct((number % 5000 + 300).alias("amount")).alias("price"),
            F.lit(None).cast("string").alias("displayAddress"),
            F.when(whole, F.struct(F.lit(51.5).alias("latitude"), F.lit(-0.1).alias("longitude"))).alias("location"),
        )

    last = F.when(key % 2 == 0, 9).otherwise(8)
    records = F.transform(F.sequence(F.lit(0), last), record)
    found = F.struct(F.when(key % 11 == 0, F.slice(records, 1, 0)).otherwise(records).alias("properties"))
    body = F.to_json(
        F.struct(F.struct(F.struct(found.alias("searchResults")).alias("pageProps")).alias("props")),
        {"ignoreNullFields": "false"},
    )
    script = F.concat(F.lit(f"<script data-id='x' id='{DATA_SCRIPT_ID}'>"), body, F.lit("</script>"))
    html = F.concat(
        F.lit(f"<script data-id='{DATA_SCRIPT_ID}'>1</script>"),
        F.when(key % 13 == 0, F.concat(F.lit("<!--"), script, F.lit("-->"))).otherwise(script),
    )
    customers = in_parts(spark, table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    return customers.select(key.alias("page_id"), html.alias("html"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages with a data script at the end of two thirds of them."""
    page = F.col("page_id")
    data = F.concat(
        F.lit('{"props":{"pageProps":{"searchResults":{"properties":[{"id":"'), page.cast("string"),
        F.lit('","price":{"amount":'), (page % 3000 + 500).cast("string"),
        F.lit('},"displayAddress":null,"location":{"latitude":"51.5","longitude":-0.1}}]}}}}'),
    )
    script = F.concat(F.lit(f"<SCRIPT type='application/json' id='{DATA_SCRIPT_ID}'>"), data, F.lit("</SCRIPT>"))
    html = F.when(page % 3 != 0, F.concat("html", script)).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", "html").select("page_id", html.alias("html"))


def rate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a page with a table of three rates, one of them not a number, and a second table."""
    day = F.to_date("o_orderdate")

    def row(i: Column) -> Column:
        date = F.date_format(F.date_add(day, i), "dd MMM yy")
        rate = F.when((F.col("o_orderkey") + i) % 4 == 0, F.lit("n/a")).otherwise(
            ((F.col("o_orderkey") + i) % 1000 / F.lit(100.0)).cast("string")
        )
        return F.concat(F.lit("<tr><td align='right'>"), date, F.lit("</td><td>&nbsp;<b>"), rate,
                        F.lit("</b></td></tr>\n"))

    rows = F.concat(*[F.coalesce(row(F.lit(i)), F.lit("")) for i in range(3)])  # a row without its day is left out
    html = F.concat(
        F.lit("<html><body><table class='x'>\n<tr><th>Date</th><th>Rate</th></tr>\n"), rows,
        F.lit("</table><table><tr><td>01 Jan 20</td><td>1</td></tr></table></body></html>"),
    )
    orders = in_parts(spark, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, F.lit("<p>none</p>")).otherwise(html).alias("html")
    )


def geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with a reverse-geocoding answer of two results.

    The postcode sits in the second result; every sixth has none, every eleventh an empty
    component list in the first result.
    """
    key = F.col("c_custkey")

    def component(name: Column, kind: str) -> Column:
        return F.struct(name.alias("long_name"), F.array(F.lit("political"), F.lit(kind)).alias("types"))

    town = F.when(key % 11 != 0, F.array(component(F.lit("London"), "postal_town")))
    code = component(F.concat(F.lit("N"), (key % 20 + 1).cast("string"), F.lit(" 1AA")), "postal_code")
    other = component(F.lit("England"), "country")
    kind = F.when(key % 6 == 0, F.array(other)).otherwise(F.array(other, code, code))
    results = F.array(F.struct(town.alias("address_components")), F.struct(kind.alias("address_components")))
    return table(spark, sf_dir, "customer").select("c_custkey", results.alias("results"))


def places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as points and suppliers as centroids; many share a position."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    points = table(spark, sf_dir, "customer").select(
        c.alias("prop_id"),
        F.when(c % 50 != 0, F.lit(51.3) + (c * 37 % 1000) / F.lit(2500.0)).alias("latitude"),
        (F.lit(-0.5) + (c * 91 % 997) / F.lit(1500.0)).alias("longitude"),
    )
    centroids = table(spark, sf_dir, "supplier").select(
        s.alias("site_id"),
        (F.lit(51.3) + (s * 53 % 101) / F.lit(250.0)).alias("latitude"),
        (F.lit(-0.5) + (s * 29 % 89) / F.lit(130.0)).alias("longitude"),
        F.concat(F.lit("SW"), (s % 20 + 1).cast("string"), F.lit(" 1AA")).alias("postcode"),
    )
    return points, centroids


def globe(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers at places all over the globe, many at the date line and the poles."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    longitude = F.when(c % 4 == 0, F.lit(179.5) + (c * 17 % 101) / F.lit(100.0)).otherwise((c * 97 % 3607) / F.lit(10.0) - 180)
    latitude = F.when(c % 7 == 0, F.lit(88.1) + (c * 13 % 181) / F.lit(100.0)).otherwise((c * 61 % 1777) / F.lit(10.0) - 88)
    points = table(spark, sf_dir, "customer").select(
        c.alias("prop_id"), F.when(c % 50 != 0, latitude).alias("latitude"), longitude.alias("longitude")
    )
    sites = table(spark, sf_dir, "supplier").select(
        s.alias("site_id"), ((s * 811 % 17903) / F.lit(100.0) - 89.3).alias("latitude"),
        ((s * 1237 % 36013) / F.lit(100.0) - 180.3).alias("longitude"),
    )
    return points, sites


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate pages, four in five of them broken: open cells, rows or tables, or a nested table in each row."""
    html, kind = F.col("html"), F.col("o_orderkey") % 5
    nested = "<td><table><tr><td>02 Feb 20</td><td>9</td></tr></table></td></tr>"
    broken = (
        F.when(kind == 1, F.regexp_replace(html, "</td>", "")).when(kind == 2, F.replace(html, F.lit("</tr>"), F.lit(nested)))
        .when(kind == 3, F.regexp_replace(html, "</t[dr]>", "")).when(kind == 4, F.regexp_replace(html, "</table>", ""))
        .otherwise(html)
    )
    return rate_pages(spark, sf_dir).withColumn("html", broken)
