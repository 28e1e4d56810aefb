"""Change feeds, refreshed gold, date layouts, sketches, wide medians and round bins."""

import random
import statistics
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlake.functions import layouts
from marketlake.operators import changes, sketches
from marketlake.operators.medians import _WIDE_BITS, grouped_stats, value_counts
from marketlake.plans import gold, pipeline, serving
from marketlake.schemas import struct_of
from marketlake.session import scratch_path
from marketlake.sinks.writers import RunLog, write_landing
from marketlake.streaming.landing import stream_latest, stream_to_state
from marketlake.streaming.silver import apply_changes
from marketlake.streaming.state import KeyedTable

FEED = "k bigint, n bigint, gone boolean, v string"


def feed_rows(seed=1, count=200):
    rng = random.Random(seed)
    rows = [(rng.randrange(12), n, rng.random() < 0.3, f"v{n}") for n in range(count)]
    return rows + [(3, 50, True, "x"), (3, 50, False, "tie"), (None, 7, False, "no key"), (5, None, True, "no number")]


def newest(rows):
    out = {}
    for k, n, gone, v in rows:
        if k is not None and n is not None:
            out[k] = max(out.get(k, (n, gone, "" if gone else v)), (n, gone, "" if gone else v))
    return {(k, v) for k, (_, gone, v) in out.items() if not gone}


@pytest.mark.parametrize("cuts", [1, 4])
def test_any_cut_of_a_feed_gives_the_same_table(spark, tmp_path, cuts):
    rows = feed_rows()
    shuffled = random.Random(cuts).sample(rows, len(rows))
    table = KeyedTable(str(tmp_path / "t"), changes.state_schema(struct_of("k BIGINT, v STRING")), ["k"], 4)
    handle = apply_changes(table, "n", lambda: F.col("gone"))
    for batch in range(cuts):
        part = spark.createDataFrame(shuffled[batch::cuts], FEED)
        handle(part, batch)
    handle(part, cuts - 1)  # the last one comes again
    live = changes.live(table.read(spark))
    assert live.columns == ["k", "v"] and {tuple(r) for r in live.collect()} == newest(rows)
    assert changes.unusable(spark.createDataFrame(rows, FEED), ["k"], "n").count() == 2


def test_a_late_update_does_not_revive_a_deleted_key(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), changes.state_schema(struct_of("k BIGINT, v STRING")), ["k"], 2)
    handle = apply_changes(table, "n", lambda: F.col("gone"))
    handle(spark.createDataFrame([(1, 5, False, "a"), (2, 1, False, "b")], FEED), 0)
    handle(spark.createDataFrame([(1, 9, True, None)], FEED), 1)
    handle(spark.createDataFrame([(1, 7, False, "late"), (2, 0, True, None)], FEED), 2)
    assert [tuple(r) for r in changes.live(table.read(spark)).collect()] == [(2, "b")]
    handle(spark.createDataFrame([(1, 10, False, "new")], FEED), 3)
    assert changes.live(table.read(spark)).count() == 2
    states = table.read(spark)
    assert changes.forget_deleted(states, 100).count() == 2


def home(i, day, postcode):
    return (i, f"{i} High St", 51.5, -0.1, f"{day}T12:00:00", postcode)


def test_refreshes_equal_a_rebuild_and_leave_other_dates_alone(spark, tmp_path):
    house = pipeline.Warehouse(*[str(tmp_path / x) for x in ("landing", "silver", "gold", "cp")], buckets=2)
    first = date(2024, 1, 1)
    days = [str(first + timedelta(days=d)) for d in range(5)]
    props = "prop_id bigint, address string, latitude double, longitude double, scraped_at string, postcode string"
    prices = "prop_id bigint, date string, price bigint, scraped_at string"
    deliveries = [
        ([home(i, days[0], f"SW{i} 1AA") for i in range(1, 5)], [(i, d, 1000 * i, f"{d}T12:00:00") for i in (1, 2, 3) for d in days[:3]]),
        ([home(4, days[3], "SW9 1AA")], [(4, days[3], 900, f"{days[3]}T12:00:00"), (1, days[3], 1100, f"{days[3]}T12:00:00")]),
        ([home(2, days[4], "SW7 1AA")], [(1, days[4], 700, f"{days[4]}T12:00:00")]),  # the second home moves
    ]
    fact = tmp_path / "gold" / pipeline.FACT_BY_DATE
    seen = []

    def files():
        return {d.name[len("date="):]: sorted(f.name for f in d.glob("*.parquet")) for d in fact.glob("date=*")}

    for n, (homes, rates) in enumerate(deliveries):
        write_landing(spark.createDataFrame(homes, props), house.landing, "properties", first + timedelta(days=7 * n))
        write_landing(spark.createDataFrame(rates, prices), house.landing, "prices", first + timedelta(days=7 * n))
        pipeline.run_silver(spark, house, RunLog(spark), track=True)
        before = files() if fact.exists() else {}
        changed = [str(d) for d in pipeline.refresh_gold(spark, house, RunLog(spark))]
        after = files()
        assert all((before[d] == after[d]) == (d not in changed) for d in before)
        seen.append(changed)
        whole = gold.price_fact(house.prices.read(spark), house.properties.read(spark))
        got = spark.read.parquet(str(fact)).select(*whole.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert seen == [days[:3], [days[3]], [*days[:3], days[4]]]
    assert pipeline.refresh_gold(spark, house, RunLog(spark)) == []


def test_newest_of_a_stream_with_late_rows_and_a_restart(spark, tmp_path):
    source = tmp_path / "in"
    table = KeyedTable(str(tmp_path / "t"), changes.state_schema(struct_of("k BIGINT, v STRING")), ["k"], 2)
    schema = "k bigint, seen timestamp, v string"

    def arrive(*rows):
        spark.createDataFrame([(k, s, v) for k, s, v in rows], "k bigint, seen string, v string").select(
            "k", F.to_timestamp("seen").alias("seen"), "v").coalesce(1).write.mode("append").parquet(str(source))

    def keep(batch, batch_id, crash=False):
        rows = batch.withColumn("n", F.unix_micros("seen")).drop("seen")
        apply_changes(table, "n", lambda: F.lit(False))(rows, batch_id)
        if crash:
            raise RuntimeError("lost")

    def run(crash=False):
        stream = spark.readStream.schema(schema).parquet(str(source))
        updates = stream_latest(stream, ["k"], "seen", "2 days", tie=["v"])
        stream_to_state(updates, str(tmp_path / "cp"), lambda b, i: keep(b, i, crash)).awaitTermination()

    arrive((1, "2024-01-02 10:00:00", "a"), (1, "2024-01-02 09:00:00", "older"), (2, "2024-01-02 08:00:00", "x"))
    run()
    arrive((1, "2024-01-02 09:30:00", "late"), (2, "2024-01-03 01:00:00", "y"), (2, "2024-01-03 01:00:00", "z"))
    with pytest.raises(Exception, match="lost"):
        run(crash=True)
    run()
    assert {tuple(r) for r in changes.live(table.read(spark)).collect()} == {(1, "a"), (2, "z")}


def test_layouts_of_mixed_sources(spark):
    cells = {
        "day": ["03/04/2024", "25/12/2023", "n/a", None], "month": ["03/04/2024", "12/25/2023"], "open": ["03/04/2024", "1/2/2024"],
        "same": ["05/05/2024"], "mixed": ["25/12/2023", "12/25/2023"], "none": ["soon", "31/31/2024"],
        "turned": ["2024/25/12", "2024/03/04"], None: ["20240313", "20241231"],
    }
    rows = [(s, c) for s, texts in cells.items() for c in texts]
    df = spark.createDataFrame(rows, "source string, cell string")
    found = layouts.column_layouts(df, ["source"], "cell")
    got = {r.source: (r.layout, r.status, r.num_read) for r in found.collect()}
    assert got == {
        "day": ("d/M/yyyy", "one", 2), "month": ("M/d/yyyy", "one", 2), "open": ("d/M/yyyy", "ambiguous", 2),
        "same": ("d/M/yyyy", "same", 1), "mixed": (None, "mixed", 2), "none": (None, "none", 0),
        "turned": ("yyyy/d/M", "one", 2), None: ("yyyyMMdd", "one", 2),
    }
    left = layouts.dates_by_layout(df, ["source"], "cell", found, ambiguous="leave")
    dates = {(r.source, r.cell): str(r.date) if r.date else None for r in left.collect()}
    assert dates[("day", "03/04/2024")] == "2024-04-03" and dates[("month", "03/04/2024")] == "2024-03-04"
    assert dates[("open", "03/04/2024")] is None and dates[("turned", "2024/03/04")] == "2024-04-03"
    assert dates[(None, "20240313")] == "2024-03-13" and len(dates) == len(set(rows))
    read = layouts.dates_by_layout(df, ["source"], "cell", found).where("source = 'open' AND cell = '1/2/2024'").first()
    assert str(read.date) == "2024-02-01"
    with pytest.raises(ValueError):
        layouts.dates_by_layout(df, ["source"], "cell", found, ambiguous="guess")


def test_middles_of_wide_values_in_one_group(spark):
    rng = random.Random(2)
    wide = [rng.randrange(-(2**63), 2**63) for _ in range(801)]
    dense = [10**17 + rng.randrange(5000) for _ in range(500)]
    rows = [("wide", v) for v in wide] + [("dense", v) for v in dense] + [("edges", -(2**63)), ("edges", 2**63 - 1)]
    rows += [("nulls", None)] * 3 + [("some", None), ("some", -1), ("some", -1024), ("some", -1025)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {r["g"]: r for r in grouped_stats(value_counts(df, ["g"], "v"), ["g"]).collect()}
    for g, values in (("wide", wide), ("dense", dense), ("edges", [-(2**63), 2**63 - 1]), ("some", [-1, -1024, -1025])):
        low, high = statistics.median_low(values), statistics.median_high(values)
        assert got[g]["median_low"] == low and got[g]["median"] == (float(low) + float(high)) / 2
    assert got["nulls"]["median"] is None and got["nulls"]["num_rows"] == 3 and got["some"]["num_rows"] == 4


def test_no_window_sees_all_bins_of_a_wide_group(spark):
    """Of 20,000 values over the whole range no window's partition gets more than the widest bins and those it opens."""
    df = spark.range(20000).select((F.col("id") * 461168601842738 - 2**62).alias("v"))
    plan = grouped_stats(value_counts(df, [], "v"), [])
    assert plan.first()["median_low"] == 9999 * 461168601842738 - 2**62
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("_bin2") > 0 and text.count("Window") >= 4


def test_windows_over_wide_values_see_few_bins():
    """No level of the descent holds more than 2**17 bins of a group: the widest has 2**16, one or two are opened at a time."""
    opened = [above - below for below, above in zip((0, *_WIDE_BITS), _WIDE_BITS)]
    assert 64 - _WIDE_BITS[-1] <= 16 and max(opened) <= 16


def test_sketches_merge_to_close_medians(spark):
    rng = random.Random(3)
    rows = [(m, rng.choice("ab"), int(rng.lognormvariate(7, 1))) for m in range(12) for _ in range(1500)]
    rows += [(0, "hot", 5)] * 3000 + [(1, "none", None)]
    df = spark.createDataFrame(rows, "month int, area string, price bigint")
    path = scratch_path(spark, "sk")
    sketches.sketch_values(df, ["month", "area"], "price").write.parquet(path)
    merged = sketches.merge_sketches(spark.read.parquet(path), [F.floor(F.col("month") / 3).alias("quarter"), "area"])
    found = sketches.sketch_quantile(merged)
    placed = df.withColumn("quarter", F.floor(F.col("month") / 3))
    errors = sketches.rank_error(placed, ["quarter", "area"], "price", found).collect()
    assert len(errors) == 9 and max(r.rank_error for r in errors) < 0.01
    counts = {(r.quarter, r.area): r.num_rows for r in merged.collect()}
    assert counts[(0, "hot")] == 3000 and sum(counts.values()) == len(rows) - 1
    assert merged.select(F.max(F.length("sketch"))).first()[0] < 20000


@pytest.mark.parametrize("values,step,starts", [
    ([0, 100, 399], "10", ["0", "100", "390"]), ([-7, -1, 3], "0.5", ["-7", "-1", "3"]), ([5, 5], "1", ["5"]),
    ([0.0000001, 0.0000009], "0.00000005", ["0.0000001", "0.0000009"]), ([-1, 1], "0.1", ["-1", "1"]),
    ([10**15, 10**15 + 39], "1", [str(10**15), str(10**15 + 39)]), ([0, 40], "2", ["0", "40"]),
])
def test_round_bins(spark, values, step, starts):
    df = spark.createDataFrame([(str(v) if not isinstance(v, float) else f"{v:.10f}",) for v in values] + [(None,)], "t string")
    df = df.select(F.col("t").cast("decimal(28,10)").alias("price"))
    from decimal import Decimal

    assert serving.round_step(df).first()["step"] == Decimal(step)
    got = serving.round_histogram(df).collect()
    assert [r.bin_start for r in got] == [Decimal(s) for s in starts]
    assert sum(r.num_rows for r in got) == len(values) and all(r.bin_end - r.bin_start == Decimal(step) for r in got)


def test_round_bins_of_nothing(spark):
    empty = spark.createDataFrame([], "price int")
    assert serving.round_step(empty).count() == 0 and serving.round_histogram(empty).count() == 0


def test_commits_are_a_table_of_one_file_each(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), struct_of("k BIGINT, v STRING"), ["k"], 4)
    rows = spark.createDataFrame([(i, "a") for i in range(20)], "k bigint, v string")
    assert table.write(rows, 0) == 20 and table.write(rows.limit(0), 1, only=[]) == 20
    folders = sorted(Path(tmp_path / "t" / "commits").iterdir())
    assert [len(list(f.glob("*.parquet"))) for f in folders] == [1, 1]
    (Path(tmp_path) / "t" / "commits" / "batch=000000000002").mkdir()  # a commit that was about to be written
    assert table.batches(spark) == [0, 1] and table.read(spark).count() == 20


def test_parts_of_wide_bins_are_of_the_session_width(spark):
    """Parts of 64-bit bins are dealt out by number, which AQE doesn't merge to a few large ones."""
    plan = grouped_stats(value_counts(spark.range(9).select(F.col("id").alias("v")), [], "v"), [])._jdf.queryExecution()
    width = spark.conf.get("spark.sql.shuffle.partitions")
    assert "REPARTITION_BY_NUM" in plan.executedPlan().toString() and f", {width})" in plan.executedPlan().toString()
