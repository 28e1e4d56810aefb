"""Date layouts found from all cells of a source and column together.

``03/04/2024`` alone may be the third of April or the fourth of March. Each cell admits some layouts; those that all
cells of its source and column admit are what the source can have been written in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: shapes of a date cell, and the layouts a cell of that shape may have, the likelier one first ----
SHAPES = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("d/M/yyyy", "M/d/yyyy")),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ("d-M-yyyy", "M-d-yyyy")),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ("d.M.yyyy", "M.d.yyyy")),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ("yyyy/M/d", "yyyy/d/M")),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ("yyyy-M-d", "yyyy-d-M")),
    (r"^\d{8}$", ("yyyyMMdd", "ddMMyyyy", "MMddyyyy")),
)
LAYOUTS = tuple(layout for _, layouts in SHAPES for layout in layouts)


def _readings(cell: Column) -> Column:
    """The date of the cell in every layout, NULL where it is none; only layouts of the cell's shape are tried."""
    by_layout = {layout: shape for shape, layouts in SHAPES for layout in layouts}
    return F.array(*[F.when(cell.rlike(by_layout[x]), F.try_to_date(cell, x)) for x in LAYOUTS])


def column_layouts(cells: DataFrame, group: Sequence[str], cell: str) -> DataFrame:
    """Per group: ``layout`` (NULL if no layout fits all its dates), ``status`` and ``num_cells``, ``num_read``.

    Cells that no layout reads (text, empty cells) say nothing about the others. ``status`` is ``one``; ``same`` if several
    layouts fit and read every cell alike; ``ambiguous`` if they differ for some cell (``layout`` is then the likelier one);
    ``mixed`` if each date fits a layout but none fits all; ``none`` without any date. One aggregate of a few numbers per
    group, which tasks work out before the shuffle.
    """
    readings = cells.select(*group, F.inline(F.array(F.struct(_readings(F.trim(cell)).alias("_dates")))))
    some = F.exists("_dates", lambda d: d.isNotNull())
    bits = sum(
        (F.when(F.get("_dates", F.lit(i)).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(len(LAYOUTS))),
        F.lit(0),
    )
    # For each pair of layouts of one shape: whether some cell tells them apart.
    pairs = [(LAYOUTS.index(a), LAYOUTS.index(b)) for _, layouts in SHAPES for i, a in enumerate(layouts) for b in layouts[i + 1:]]
    apart = sum((
        F.when(~F.get("_dates", F.lit(a)).eqNullSafe(F.get("_dates", F.lit(b))), F.lit(1 << k)).otherwise(F.lit(0))
        for k, (a, b) in enumerate(pairs)
    ), F.lit(0))
    found = readings.groupBy(*group).agg(
        F.count(F.lit(1)).alias("num_cells"), F.count_if(some).alias("num_read"),
        F.bit_and(F.when(some, bits)).alias("_fit"), F.bit_or(F.when(some, apart)).alias("_apart"),
    )
    fits = [F.col("_fit").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(LAYOUTS))]
    first = F.coalesce(*[F.when(fit, F.lit(x)) for fit, x in zip(fits, LAYOUTS)])
    count = sum((fit.cast("int") for fit in fits), F.lit(0))
    differ = F.lit(False)
    for k, (a, b) in enumerate(pairs):
        differ = differ | (fits[a] & fits[b] & (F.col("_apart").bitwiseAND(F.lit(1 << k)) != 0))
    status = F.when(F.col("num_read") == 0, "none").when(F.col("_fit") == 0, "mixed").when(count == 1, "one").when(
        differ, "ambiguous").otherwise("same")
    return found.select(*group, first.alias("layout"), status.alias("status"), "num_cells", "num_read")


def dates_by_layout(cells: DataFrame, group: Sequence[str], cell: str, layouts: DataFrame, name: str = "date",
                    ambiguous: str = "read") -> DataFrame:
    """The cells with the date that their group's layout reads, NULL where it reads none.

    With ``ambiguous="leave"`` cells of groups that stayed ambiguous have no date. Groups may hold NULL.
    """
    if ambiguous not in ("read", "leave"):
        raise ValueError("ambiguous is 'read' or 'leave'")
    known = layouts if ambiguous == "read" else layouts.where("status <> 'ambiguous'")
    known = known.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("layout").alias("_layout"))
    match = F.lit(True)
    for i, g in enumerate(group):
        match = match & cells[g].eqNullSafe(known[f"_g{i}"])
    reading = F.coalesce(*[
        F.when(F.col("_layout") == x, F.when(F.trim(cell).rlike(shape), F.try_to_date(F.trim(cell), x)))
        for shape, found in SHAPES for x in found
    ])
    return cells.join(known, match, "left").withColumn(name, reading).drop("_layout", *[f"_g{i}" for i in range(len(group))])
