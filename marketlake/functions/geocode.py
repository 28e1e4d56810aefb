"""Postcode out of a reverse-geocoding answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOCODE_DDL = (
    "struct<results: array<struct<address_components: array<struct<long_name: string, types: array<string>>>>>>"
)


def postcode_from_geocode(results: Column) -> Column:
    """``long_name`` of the first component, over all results in order, typed ``postal_code``."""
    none = F.expr("cast(array() as array<struct<long_name: string, types: array<string>>>)")
    components = F.flatten(
        F.transform(results, lambda r: F.coalesce(r["address_components"], none))
    )
    hits = F.filter(components, lambda c: F.array_contains(c["types"], "postal_code"))
    return F.get(hits, F.lit(0))["long_name"]
