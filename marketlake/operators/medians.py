"""Exact medians of whole-number columns that stay distributed for any group size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bins of neighbouring values, the finest first: a window sees at most 2**22 bins of a group of 32-bit values, and at most
# 2**16 bins of 64-bit ones, then twice 2**16 of one or two opened bins, level by level.
_BITS = (10,)
_WIDE_BITS = (16, 32, 48)
_NO_BIN = -(2**60)  # below the bin of any 64-bit value
# The ranks of the two middle values.
_LOW, _HIGH = "(_total + 1) div 2", "_total div 2 + 1"
_TOTALS = ["num_rows", "_total", "_all"]


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value). Tasks count their own rows first, and a hot group spreads over its values.

    The value keeps its type, which must be a whole number's: scale others to whole units first.
    """
    kind = df.schema[value].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"medians need whole numbers, but {value} is {kind.simpleString()}")
    return df.groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _placed(bins: DataFrame, bin_name: str, start: str) -> DataFrame:
    """Bins that hold a middle row. ``start`` is where a group's lowest bin begins; the NULL values' bin takes no place."""
    placed = bins.selectExpr(
        "*", f"{start} + coalesce(sum(_valued) OVER (PARTITION BY _k ORDER BY {bin_name} ROWS UNBOUNDED PRECEDING)"
        " - _valued, 0) AS _before",
    )
    # A group without any value keeps its only bin.
    return placed.where(f"_total IS NULL OR (_before < {_HIGH} AND _before + _valued >= {_LOW})")


def grouped_stats(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count, mean, lower and interpolated median per group from :func:`value_counts`.

    A value may come in several rows of a group; their counts add up.
    Output: keys, ``num_rows`` (NULL values included), ``mean``, ``median_low`` (the discrete
    median, smallest value with at least half of the rows at or below it) and ``median``.

    The middle is found by descent: rows are added up to bins of neighbouring values, bins to wider bins, and from the
    widest down only the one or two bins that hold the middle are opened. So a window sees a bounded number of bins
    (see above) or of distinct values (2,048 of 32 bits, 2**17 of 64), however many rows or values a group has and however they are spread.
    """
    # Keys as one struct and a bin of their own for NULL values: neither is ever NULL, so the
    # joins below are plain ones and add no filter that would tell their two inputs apart.
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_g"))
    wide = isinstance(counts.schema["value"].dataType, T.LongType)
    shifts = _WIDE_BITS if wide else _BITS
    # This partitioning serves the finest bins and the last join; the counts are moved by it once. A
    # partition's share of a hot group is a few of its bins.
    binned = counts.select(
        group.alias("_k"), F.expr(f"coalesce(shiftright(bigint(value), {shifts[0]}), bigint({_NO_BIN})) AS _bin0"), "value", "n"
    )
    # Nearly all bins of 64-bit values may differ, so their parts are never merged to few: a task holds its part's bins.
    width = [int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if wide else []
    binned = binned.repartition(*width, "_k", "_bin0")
    levels = [binned.groupBy("_k", "_bin0").agg(
        F.expr("sum(n) AS _rows"), F.expr("sum(cast(value AS double) * n) AS _sum")
    )]
    for level in range(1, len(shifts)):
        below, more = f"_bin{level - 1}", shifts[level] - shifts[level - 1]
        wider = F.expr(f"if({below} = bigint({_NO_BIN}), bigint({_NO_BIN}), shiftright({below}, {more})) AS _bin{level}")
        levels.append(levels[-1].select("_k", wider, "_rows", "_sum").groupBy("_k", f"_bin{level}").agg(
            F.expr("sum(_rows) AS _rows"), F.expr("sum(_sum) AS _sum")
        ))

    def valued(name: str) -> str:
        return f"if({name} = bigint({_NO_BIN}), NULL, _rows) AS _valued"

    top = len(shifts) - 1
    widest = levels[top].selectExpr("_k", f"_bin{top}", "_rows", "_sum", valued(f"_bin{top}")).selectExpr(
        "*", "sum(_rows) OVER (PARTITION BY _k) AS num_rows", "sum(_valued) OVER (PARTITION BY _k) AS _total",
        "sum(_sum) OVER (PARTITION BY _k) AS _all",
    )
    holding = _placed(widest, f"_bin{top}", "0").select("_k", f"_bin{top}", "_before", *_TOTALS)
    for level in range(top - 1, -1, -1):
        above, name, more = f"_bin{level + 1}", f"_bin{level}", shifts[level + 1] - shifts[level]
        opened = levels[level].selectExpr(
            "_k", name, "_rows", valued(name),
            f"if({name} = bigint({_NO_BIN}), bigint({_NO_BIN}), shiftright({name}, {more})) AS {above}",
        ).join(holding.withColumnRenamed("_before", "_start"), ["_k", above]).selectExpr(
            "_k", name, "_valued", "min(_start) OVER (PARTITION BY _k) AS _start", *_TOTALS
        )
        holding = _placed(opened, name, "_start").select("_k", name, "_before", *_TOTALS)

    # The selected bins are neighbours, so counting on from the lowest one's start is enough.
    ranked = binned.join(holding, ["_k", "_bin0"]).withColumn(
        "_upto",
        F.expr(
            "min(_before) OVER (PARTITION BY _k)"
            " + sum(n) OVER (PARTITION BY _k ORDER BY value ROWS UNBOUNDED PRECEDING)"
        ),
    )
    result = ranked.groupBy("_k").agg(
        F.expr("max(num_rows) AS num_rows"),
        F.expr("max(_all) / max(_total) AS mean"),
        F.expr(f"min(value) FILTER (WHERE _upto >= {_LOW}) AS median_low"),
        F.expr(f"min(value) FILTER (WHERE _upto >= {_HIGH}) AS _median_high"),
    )
    return result.selectExpr(
        *[f"_k.{k} AS {k}" for k in keys], "num_rows", "mean", "median_low",
        "(cast(median_low AS double) + _median_high) / 2 AS median",
    )
