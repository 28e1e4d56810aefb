"""Explicit schemas and the fixed values of the listings data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# ---- fixed values: area codes with their district names ----
DISTRICTS = {
    "SW1": "Westminster",
    "SW2": "Brixton",
    "SW3": "Chelsea",
    "SW4": "Clapham",
    "SW5": "Earl's Court",
    "SW6": "Fulham",
    "SW7": "South Kensington",
    "SW8": "South Lambeth",
    "SW9": "Stockwell",
    "SW10": "West Brompton",
    "SW11": "Battersea",
    "SW12": "Balham",
    "SW13": "Barnes",
    "SW14": "Mortlake",
    "SW15": "Putney",
    "SW16": "Streatham",
    "SW17": "Tooting",
    "SW18": "Wandsworth",
    "SW19": "Wimbledon",
    "SW20": "West Wimbledon",
}
TOTAL_AREA = "all"
TOTAL_DISTRICT = "All districts"

# ---- fixed values: failure thresholds, both strictly greater ----
PARSE_FAILURE_THRESHOLD = 0.1
POSTCODE_MISSING_THRESHOLD = 0.1

# ---- fixed values: script that carries the page's data, and the path to its search results ----
DATA_SCRIPT_ID = "__NEXT_DATA__"
RESULTS_PATH = "$.props.pageProps.searchResults"

AREA_CODES = list(DISTRICTS)


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def struct_of(columns: str) -> T.StructType:
    """Schema from ``name TYPE, ...``, usable before there is a session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---- fixed values: columns and types of the published tables and landing files ----
# Landing data arrives without day columns; those come from the folder names.
LANDING = {
    "properties": struct_of(
        "prop_id BIGINT, address STRING, latitude DOUBLE, longitude DOUBLE, scraped_at STRING, postcode STRING"
    ),
    "prices": struct_of("prop_id BIGINT, date STRING, price BIGINT, scraped_at STRING"),
    "spy_prices": struct_of("date STRING, close DOUBLE, loaded_at STRING"),
    "rates": struct_of("date STRING, rate DOUBLE, loaded_at STRING"),
}

PARTITION_COLUMNS = ["year", "month", "day"]

# Working schemas keep BIGINT ids and DOUBLE coordinates; REFERENCE narrows them on request.
SILVER = {
    "silver_properties": struct_of(
        "prop_id BIGINT, address STRING, latitude DOUBLE, longitude DOUBLE, postcode STRING,"
        " last_seen DATE, first_seen DATE, area_code STRING"
    ),
    "silver_prices": struct_of("prop_id BIGINT, price INT, date DATE"),
    "silver_spy_prices": struct_of("date DATE, close DOUBLE"),
}

REFERENCE = {
    "silver_properties": struct_of(
        "prop_id INT, address STRING, latitude FLOAT, longitude FLOAT, postcode STRING,"
        " last_seen DATE, first_seen DATE, area_code STRING"
    ),
    "silver_prices": struct_of("prop_id INT, price INT, date DATE"),
    "silver_spy_prices": struct_of("date DATE, close FLOAT"),
    "gold_area_dim": struct_of("area_code STRING, district STRING"),
    "gold_property_fact": struct_of(
        "date DATE, area_code STRING, avg_price INT, median_price INT, num_properties BIGINT,"
        " month STRING, year STRING"
    ),
    "gold_current_properties": struct_of(
        "prop_id INT, address STRING, postcode STRING, latitude FLOAT, longitude FLOAT,"
        " area_code STRING, price INT, date DATE"
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, in order and cast; extra columns are left out."""
    return df.selectExpr(*[f"cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def reference_schema(df: DataFrame, table: str) -> DataFrame:
    """The table in the narrow published types (INT ids, FLOAT coordinates)."""
    return conform(df, REFERENCE[table])


def as_timestamp(column: Column) -> Column:
    """ISO text or timestamp to a timestamp free of time zones; NULL if the text is none."""
    return column.try_cast("timestamp_ntz")
