"""Data-quality rules, row expectations and failure-rate gates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from operator import ge, gt, le, lt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlake.schemas import PARSE_FAILURE_THRESHOLD, POSTCODE_MISSING_THRESHOLD

_COMPARE: dict[str, Callable] = {">": gt, ">=": ge, "<": lt, "<=": le}


def violates(predicate: Column) -> Column:
    """True where the predicate is false or NULL."""
    return ~F.coalesce(predicate, F.lit(False))


# ---- rules ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A metric over the table and the bound it must keep. A NULL metric fails.

    ``hits`` is a count that adds up over parts of the table: the metric itself, or, with ``is_share``, what the metric
    divides by the number of rows.
    """

    name: str
    metric: Column | None
    op: str
    threshold: float
    key: str | None = field(default=None)
    sql: str | None = field(default=None)
    hits: Column | None = field(default=None)
    is_share: bool = field(default=False)


def _counting(name: str, hits: Column, op: str, n: float) -> Rule:
    return Rule(name, hits, op, n, hits=hits)


def _share(name: str, hits: Column, op: str, share: float) -> Rule:
    return Rule(name, F.try_divide(hits, F.count(F.lit(1))), op, share, hits=hits, is_share=True)


def row_count(op: str, n: float) -> Rule:
    return _counting(f"RowCount {op} {n:g}", F.count(F.lit(1)), op, n)


def is_complete(column: str) -> Rule:
    """No NULLs; the metric counts them."""
    return _counting(f"IsComplete {column}", F.count_if(F.col(column).isNull()), "<=", 0)


def completeness(column: str, op: str, share: float) -> Rule:
    return _share(f"Completeness {column} {op} {share:g}", F.count(column), op, share)


def is_unique(column: str) -> Rule:
    """No value twice; the metric counts the values that do occur more than once."""
    return Rule(f"IsUnique {column}", None, "<=", 0, key=column)


def values_between(column: str, low: float, high: float, inclusive: bool = False) -> Rule:
    """All values inside the range (open by default); the metric counts the others and NULLs."""
    value = F.col(column)
    inside = value.between(low, high) if inclusive else (value > low) & (value < high)
    return _counting(f"ColumnValues {column} between {low:g} and {high:g}", F.count_if(violates(inside)), "<=", 0)


def values_compare(column: str, op: str, bound: float) -> Rule:
    good = _COMPARE[op](F.col(column), F.lit(bound))
    return _counting(f"ColumnValues {column} {op} {bound:g}", F.count_if(violates(good)), "<=", 0)


def share_of(name: str, predicate: Column, op: str, share: float) -> Rule:
    """Share of rows for which the predicate is true."""
    return _share(f"{name} {op} {share:g}", F.count_if(predicate), op, share)


def custom_sql(name: str, query: str, op: str, threshold: float) -> Rule:
    """A query over ``{primary}`` that gives one number."""
    return Rule(name, None, op, threshold, sql=query)


def verdict_row(table: str, rule: Rule, metric: Column) -> Column:
    value = metric.cast("double")
    passed = F.coalesce(_COMPARE[rule.op](value, F.lit(float(rule.threshold))), F.lit(False))
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(rule.name).alias("rule"),
        value.alias("metric"),
        F.lit(float(rule.threshold)).alias("threshold"),
        passed.alias("passed"),
    )


def run_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """(table, rule, metric, threshold, passed), one row per rule.

    All plain rules share one aggregate over one scan. Uniqueness counts rows per value
    first, so neither many values nor one very frequent value lands in a single task.
    """
    spark = df.sparkSession
    frames = []
    plain = [r for r in rules if r.metric is not None]
    if plain:
        row = df.agg(*[r.metric.alias(f"m{i}") for i, r in enumerate(plain)])
        verdicts = F.array(*[verdict_row(table, r, F.col(f"m{i}")) for i, r in enumerate(plain)])
        frames.append(row.select(F.inline(verdicts)))
    for rule in rules:
        if rule.key is not None:
            per_value = df.where(F.col(rule.key).isNotNull()).groupBy(rule.key).agg(F.count(F.lit(1)).alias("n"))
            row = per_value.agg(F.count_if(F.col("n") > 1).alias("m"))
        elif rule.sql is not None:
            row = spark.sql(rule.sql, primary=df).toDF("m")
        else:
            continue
        frames.append(row.select(F.inline(F.array(verdict_row(table, rule, F.col("m"))))))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _not_south_west() -> Column:
    return F.col("area_code").isNull() | ~F.col("area_code").like("SW%")


def rulesets() -> dict[str, list[Rule]]:
    """The rules of each table."""
    # ---- fixed values: bounds of the rules ----
    return {
        "silver_properties": [
            row_count(">", 500),
            is_complete("prop_id"),
            is_complete("address"),
            is_complete("latitude"),
            is_complete("longitude"),
            is_unique("prop_id"),
            completeness("postcode", ">=", 0.9),
            share_of("share outside SW", _not_south_west(), "<", 0.1),
        ],
        "silver_prices": [
            row_count(">", 500),
            is_complete("prop_id"),
            is_complete("price"),
            is_complete("date"),
            values_between("price", 100, 50000),
        ],
        "silver_spy_prices": [
            row_count(">", 0),
            is_complete("date"),
            is_complete("close"),
            values_compare("close", ">", 0),
            is_unique("date"),
        ],
        "gold_current_properties": [
            row_count(">", 400),
            is_complete("prop_id"),
            is_complete("price"),
            is_complete("area_code"),
            values_between("price", 100, 50000),
        ],
        "gold_property_fact": [
            row_count(">", 0),
            is_complete("area_code"),
            is_complete("avg_price"),
            values_between("avg_price", 500, 20000),
            values_compare("num_properties", ">", 0),
        ],
    }


# ---- expectations --------------------------------------------------------------------


def expect(df: DataFrame, checks: dict[str, Column], name: str = "expect") -> tuple[DataFrame, Observation]:
    """Keep every row and count violations per check, in passing."""
    seen = Observation(name)
    counts = [F.count_if(violates(p)).alias(check) for check, p in checks.items()]
    return df.observe(seen, *counts), seen


def expect_or_drop(df: DataFrame, check: str, predicate: Column) -> tuple[DataFrame, Observation]:
    """Drop rows that violate the predicate (a NULL result does) and count them in passing."""
    seen = Observation(check)
    observed = df.observe(seen, F.count_if(violates(predicate)).alias(check))
    return observed.where(F.coalesce(predicate, F.lit(False))), seen


def expectation_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, violations, num_rows) as a frame, for reports."""
    row = df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        *[F.count_if(violates(p)).alias(f"v{i}") for i, p in enumerate(checks.values())],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(f"v{i}").alias("violations"), F.col("num_rows").alias("num_rows"))
        for i, c in enumerate(checks)
    ])
    return row.select(F.inline(entries))


# ---- gates ---------------------------------------------------------------------------


class QualityFailure(RuntimeError):
    """A gate was breached."""


def failure_rate(df: DataFrame, keys: Sequence[str], bad: Column, counted: Column | None = None) -> DataFrame:
    """Per key: ``total`` rows, ``failures`` and ``rate`` (NULL if there are no rows to count)."""
    counted = F.lit(True) if counted is None else counted
    return df.groupBy(*keys).agg(
        F.count_if(counted).alias("total"), F.count_if(counted & bad).alias("failures")
    ).withColumn("rate", F.try_divide("failures", "total"))


def missing_rate(df: DataFrame, column: str) -> DataFrame:
    """One row: ``total``, ``failures`` (NULL or empty text) and ``rate``, 0 for an empty input."""
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.col(column), F.lit("")) == "").alias("failures"),
    )
    return row.withColumn("rate", F.coalesce(F.try_divide("failures", "total"), F.lit(0.0)))


def _tally(rates: DataFrame, threshold: float):
    """One row over all groups: how many are empty, above the threshold and below it with failures, and the worst."""
    above = F.coalesce(F.col("rate") > threshold, F.lit(False))
    empty = F.col("total") == 0
    others = [c for c in rates.columns if c != "rate"]
    return rates.agg(
        F.count_if(empty).alias("empty"),
        F.count_if(above).alias("above"),
        F.count_if(~above & (F.col("failures") > 0)).alias("warned"),
        F.max(F.when(above, F.struct("rate", *others))).alias("worst"),
        F.min(F.when(empty, F.struct(*others))).alias("an_empty"),
    ).first()


def _judge(tally, what: str, threshold: float, empty_message: str | None) -> int:
    if empty_message is not None and tally["empty"]:
        raise QualityFailure(f"{empty_message} in {tally['empty']} group(s), for instance {tally['an_empty'].asDict()}")
    if tally["above"]:
        raise QualityFailure(
            f"{what} exceeds {threshold:.0%} in {tally['above']} group(s), the worst being {tally['worst'].asDict()}"
        )
    return tally["warned"]


def fail_if_rate(rates: DataFrame, what: str, threshold: float, empty_message: str | None = None) -> int:
    """Raise if a rate is above the threshold; return how many groups had failures below it.

    With ``empty_message`` a group without rows fails too. The rates are worked out once, and
    only their tally and one example reach the driver.
    """
    return _judge(_tally(rates, threshold), what, threshold, empty_message)


def check_pages(listings: DataFrame, page_keys: Sequence[str], threshold: float = PARSE_FAILURE_THRESHOLD) -> int:
    """Per-page gate on parsed listings: an empty page fails, as does a failure rate above the threshold."""
    rates = failure_rate(listings, page_keys, F.col("is_bad"), F.col("is_listing"))
    return fail_if_rate(rates, "Parse failure rate", threshold, empty_message="No properties found")


def check_postcodes(properties: DataFrame, threshold: float = POSTCODE_MISSING_THRESHOLD) -> int:
    """Run-wide gate on properties without a postcode."""
    return fail_if_rate(missing_rate(properties, "postcode"), "Missing postcode rate", threshold)


def check_rules(results: DataFrame) -> None:
    """Raise if any rule of :func:`run_rules` failed."""
    failed = [r.asDict() for r in results.where(~F.col("passed")).collect()]
    if failed:
        raise QualityFailure(f"rules failed: {failed}")
