from marketlake.functions.areas import area_code, listed_or_null
from marketlake.functions.dates import flexible_date, iso_date, iso_timestamp, month_name, partition_path, year_text
from marketlake.functions.geocode import postcode_from_geocode

__all__ = [
    "area_code",
    "flexible_date",
    "iso_date",
    "iso_timestamp",
    "listed_or_null",
    "month_name",
    "partition_path",
    "postcode_from_geocode",
    "year_text",
]
