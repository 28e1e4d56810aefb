"""Area codes out of postcodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def area_code(postcode: Column, normalise: bool = False) -> Column:
    """First word of the postcode; ``normalise`` also strips a trailing letter (EC1A -> EC1)."""
    outward = F.substring_index(postcode, " ", 1)
    if not normalise:
        return outward
    return F.nullif(F.regexp_extract(outward, r"^([A-Z]{1,2}\d+)", 1), F.lit(""))


def listed_or_null(area: Column, areas: Sequence[str]) -> Column:
    """The area if it is one of the listed ones, else NULL."""
    return F.when(area.isin(list(areas)), area)
