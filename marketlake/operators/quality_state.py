"""Verdicts on a growing table from states of its batches, without reading the table again.

Counts and shares of a batch are a few numbers, which add up. Uniqueness needs rows per value: these are a keyed table in
hash buckets, of which a batch rewrites those it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.quality import Rule, verdict_row
from marketlake.schemas import struct_of
from marketlake.streaming.state import BatchTable, KeyedTable


class QualityState:
    """States of the rules under a path. All batches must come with the same rules; a replayed batch replaces its own."""

    def __init__(self, path: str, rules: Sequence[Rule], buckets: int = 32):
        unfit = [r.name for r in rules if r.hits is None and r.key is None]
        if unfit:
            raise ValueError(f"rules without mergeable states: {unfit}")
        self.rules = list(rules)
        self.counts = BatchTable(f"{path}/counts", "rule int, hits bigint, total bigint")
        self.values = {
            i: KeyedTable(f"{path}/values/{i}", struct_of("value STRING, n BIGINT"), ["value"], buckets)
            for i, r in enumerate(rules) if r.key is not None
        }

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Take in a batch of new rows of the table; only these are read, and the buckets of values they touch."""
        plain = [(i, r) for i, r in enumerate(self.rules) if r.hits is not None]
        if plain:
            row = batch.agg(F.count(F.lit(1)).alias("total"), *[r.hits.alias(f"h{i}") for i, r in plain])
            entries = F.array(*[
                F.struct(F.lit(i).alias("rule"), F.col(f"h{i}").cast("bigint").alias("hits"), F.col("total").alias("total"))
                for i, _ in plain
            ])
            self.counts.write(row.select(F.inline(entries)), batch_id)
        for i, table in self.values.items():
            value = F.col(self.rules[i].key).cast("string").alias("value")
            incoming = batch.select(value).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
            buckets = table.touched(incoming.select("value"), before=batch_id)
            known = table.read(batch.sparkSession, before=batch_id, only=buckets)
            table.write(known.unionByName(incoming).groupBy("value").agg(F.sum("n").alias("n")), batch_id, buckets)

    def verdicts(self, spark: SparkSession, name: str) -> DataFrame:
        """(table, rule, metric, threshold, passed) of the table after the batches so far."""
        sums = self.counts.read(spark).groupBy("rule").agg(F.sum("hits").alias("hits"), F.sum("total").alias("total"))
        by_rule = sums.agg(F.map_from_entries(F.collect_list(F.struct("rule", F.struct("hits", "total")))).alias("sums"))
        found = [
            verdict_row(name, rule, F.try_divide(F.col("sums")[i]["hits"], F.col("sums")[i]["total"]) if rule.is_share
                        else F.col("sums")[i]["hits"])
            for i, rule in enumerate(self.rules) if rule.hits is not None
        ]
        frames = [by_rule.select(F.inline(F.array(*found)))] if found else []
        for i, table in self.values.items():
            twice = table.read(spark).agg(F.count_if(F.col("n") > 1).alias("m"))
            frames.append(twice.select(F.inline(F.array(verdict_row(name, self.rules[i], F.col("m"))))))
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out
