"""Landing and table writers, incremental runs and replays."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.catalog import queries
from marketlake.operators.quality import QualityFailure
from marketlake.plans import pipeline
from marketlake.schemas import LANDING, SILVER
from marketlake.session import scratch_path, shared_dir
from marketlake.sinks import writers
from marketlake.sources.landing import (
    counted, read_foreign_landing, read_landing, read_landing_day, read_table,
)
from marketlake.streaming.landing import stream_dedupe, stream_landing
from marketlake.streaming.silver import insert_prices, upsert_properties
from marketlake.streaming.state import AppendTable, KeyedTable, MissingCommit, path_exists

WEEK1, WEEK2 = date(2024, 1, 1), date(2024, 1, 8)


@pytest.fixture
def root(spark):
    return scratch_path(spark, "test")


def prices(spark, *rows):
    return spark.createDataFrame(rows, LANDING["prices"])


def price(prop, day, amount, hour=12):
    return (prop, str(day), amount, f"{day}T{hour:02d}:00:00")


def home(prop, day, postcode="SW1 1AA", address="a"):
    return (prop, address, 51.5, -0.1, f"{day}T12:00:00", postcode)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_landing_folders_are_zero_padded_and_days_are_replaced(spark, root):
    assert writers.write_landing(prices(spark, price(1, WEEK1, 5), price(2, WEEK1, 6)), root, "prices", WEEK1) == 2
    writers.write_landing(prices(spark, price(1, WEEK2, 7)), root, "prices", WEEK2)
    writers.write_landing(prices(spark, price(3, WEEK1, 8)), root, "prices", WEEK1)
    assert path_exists(spark, f"{root}/prices/year=2024/month=01/day=08")
    assert {r["prop_id"] for r in read_landing(spark, root, "prices").collect()} == {1, 3}
    assert {r["prop_id"] for r in read_landing_day(spark, root, "prices", WEEK1).collect()} == {3}
    assert read_landing(spark, root, "prices").schema == LANDING["prices"]


def test_empty_writes(spark, root):
    writers.write_landing(prices(spark, price(1, WEEK1, 5)), root, "prices", WEEK1)
    assert writers.write_landing(prices(spark), root, "prices", WEEK1) == 0
    assert read_landing(spark, root, "prices").count() == 1
    with pytest.raises(writers.EmptyWrite):
        writers.write_landing(prices(spark), root, "prices", WEEK1, on_empty="fail")


def test_all_null_column_keeps_its_type(spark, root):
    rows = spark.createDataFrame([(1, "a", 51.5, -0.1, "2024-01-01T12:00:00")],
                                 "prop_id bigint, address string, latitude double, longitude double, scraped_at string")
    writers.write_landing(rows.withColumn("postcode", F.lit(None)), root, "properties", WEEK1)
    assert read_landing(spark, root, "properties").first()["postcode"] is None


def test_files_of_other_writers_with_other_types(spark, root):
    spark.createDataFrame([(1, "x")], "prop_id int, postcode string").write.parquet(f"{root}/a")
    spark.createDataFrame([(2, None)], "prop_id bigint, postcode int").write.parquet(f"{root}/b")
    spark.createDataFrame([(3, "y")], "prop_id int, postcode string").write.parquet(f"{root}/c")
    df = read_foreign_landing(spark, [f"{root}/a", f"{root}/b", f"{root}/c"], "properties")
    assert df._jdf.queryExecution().analyzed().toString().count("Relation") == 2
    assert df.schema.names == LANDING["properties"].names
    assert {(r["prop_id"], r["postcode"], r["address"]) for r in df.collect()} == {(1, "x", None), (2, None, None), (3, "y", None)}


def test_replace_table_also_by_nothing(spark, root):
    df = spark.range(3)
    writers.replace_table(df, f"{root}/t")
    writers.replace_table(df.where("id < 0"), f"{root}/t")
    assert read_table(spark, f"{root}/t").count() == 0
    df.write.json(f"{root}/j")
    assert read_table(spark, f"{root}/j", "json").count() == 3


def test_create_table_is_idempotent(spark, root):
    for _ in range(2):
        writers.create_table(spark, "houses.silver_prices", SILVER["silver_prices"], f"{root}/p", ["date"])
    spark.sql("INSERT INTO houses.silver_prices VALUES (1, 2, date'2024-01-01')")
    assert read_table(spark, "houses.silver_prices").count() == 1
    spark.sql("DROP DATABASE houses CASCADE")


def test_preview_and_log(spark):
    assert writers.preview(spark.range(3).orderBy("id")) == (3, spark.range(1).first())
    assert writers.preview(spark.range(0)) == (0, None)
    log = writers.RunLog(spark)
    rows, seen = counted(spark.range(7), "n")
    log.timed("things", "read", rows.collect, seen)
    entry = log.frame().first()
    assert (entry["dataset"], entry["stage"], entry["rows"]) == ("things", "read", 7) and entry["seconds"] > 0


def test_stream_reads_each_file_once_and_nothing_when_nothing_came(spark, root):
    calls = []

    def run():
        stream_landing(
            spark, root, "prices", f"{root}/cp", lambda df, i: calls.append((i, df.count()))
        ).awaitTermination()

    writers.write_landing(prices(spark, price(1, WEEK1, 5), price(2, WEEK1, 5)), root, "prices", WEEK1)
    run()
    run()
    writers.write_landing(prices(spark, price(1, WEEK2, 5)), root, "prices", WEEK2)
    run()
    # A rewritten day has new file names and is read again.
    writers.write_landing(prices(spark, price(1, WEEK2, 6)), root, "prices", WEEK2)
    run()
    assert calls == [(0, 2), (1, 1), (2, 1)]


def test_failed_batch_comes_again_and_changes_nothing_twice(spark, root):
    table = AppendTable(f"{root}/silver", SILVER["silver_prices"], "date")
    handle = insert_prices(table)
    writers.write_landing(prices(spark, price(1, WEEK1, 5), price(1, WEEK1, 9, 13)), root, "prices", WEEK1)

    def crash_after_write(df, i):
        handle(df, i)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        stream_landing(spark, root, "prices", f"{root}/cp", crash_after_write).awaitTermination()
    stream_landing(spark, root, "prices", f"{root}/cp", handle).awaitTermination()
    assert as_set(table.read(spark)) == {(1, 9, WEEK1)}
    # Across batches the stored price stays.
    writers.write_landing(prices(spark, price(1, WEEK1, 77), price(2, WEEK1, 8)), root, "prices", WEEK2)
    stream_landing(spark, root, "prices", f"{root}/cp", handle).awaitTermination()
    assert as_set(table.read(spark)) == {(1, 9, WEEK1), (2, 8, WEEK1)}


def test_property_snapshots_survive_a_replay(spark, root):
    table = properties(root)
    handle = upsert_properties(table)

    def batch(*rows):
        return spark.createDataFrame(rows, LANDING["properties"])

    handle(batch(home(1, WEEK1), home(2, WEEK1)), 0)
    handle(batch(home(1, WEEK2, None, "b")), 1)
    once = as_set(table.read(spark))
    handle(batch(home(1, WEEK2, None, "b")), 1)
    assert as_set(table.read(spark)) == once
    assert (1, "b", 51.5, -0.1, "SW1 1AA", WEEK2, WEEK1, "SW1") in once and len(once) == 2
    assert table.batches(spark) == [0, 1]
    with pytest.raises(ValueError, match="ahead"):
        handle(batch(home(3, WEEK2)), 0)
    handle(batch(home(3, WEEK2)), 2)
    assert table.expire(spark, keep=2) == [0] and table.batches(spark) == [1, 2]
    assert table.read(spark).count() == 3


def properties(root, buckets=16):
    return KeyedTable(f"{root}/silver", SILVER["silver_properties"], ["prop_id"], buckets)


def rows_of(spark, *ids, address="a"):
    return spark.createDataFrame([(i, address, 1.0, 1.0, None, WEEK1, WEEK1, None) for i in ids], SILVER["silver_properties"])


def test_commits_do_not_need_marker_files_of_the_writer(spark, root):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        handle = upsert_properties(properties(root))
        handle(spark.createDataFrame([home(1, WEEK1)], LANDING["properties"]), 0)
        handle(spark.createDataFrame([home(2, WEEK1)], LANDING["properties"]), 1)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert {r["prop_id"] for r in properties(root).read(spark).collect()} == {1, 2}


def test_data_without_its_commit_is_an_error_or_unread(spark, root):
    table = properties(root)
    table.write(rows_of(spark, 1), 0)
    rows_of(spark, 2).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(table._data(1))
    assert table.read(spark).count() == 1  # batch 1 is unfinished and will come again
    assert table.read(spark, before=1).count() == 1
    with pytest.raises(MissingCommit):  # batch 2 comes only after batch 1 was committed
        table.read(spark, before=2)
    bare = properties(f"{root}/bare")
    rows_of(spark, 2).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(bare._data(0))
    with pytest.raises(MissingCommit):
        bare.read(spark)
    assert bare.read(spark, before=0).count() == 0  # batch 0 is being replayed


def test_a_batch_rewrites_the_buckets_it_touches(spark, root):
    table = properties(root)
    table.write(rows_of(spark, *range(200)), 0)
    batch = spark.createDataFrame([home(7, WEEK2, address="new")], LANDING["properties"])
    touched = table.touched(batch.select("prop_id"), before=1)
    upsert_properties(table)(batch, 1)
    folders = [p.rsplit("bucket=", 1)[1].split("/")[0] for p in table.read(spark).inputFiles() if "batch=000000000001" in p]
    assert [int(f) for f in folders] == touched and len(touched) == 1
    assert table.read(spark).count() == 200
    assert table.read(spark).where("prop_id = 7").first()["address"] == "new"
    assert table.read(spark, before=1).where("prop_id = 7").first()["address"] == "a"
    other = KeyedTable(table.path, table.schema, table.keys, buckets=3)  # the first commit's number holds
    other.write(rows_of(spark, 500), 2, other.touched(rows_of(spark, 500).select("prop_id")))
    assert other.n_buckets(spark) == 16 and other.expire(spark) == [0]
    assert other.read(spark, before=2).count() == 200


def test_files_that_came_late_are_read_however_old_they_are(spark, root):
    table = AppendTable(f"{root}/silver", SILVER["silver_prices"], "date")

    def run():
        stream_landing(spark, root, "prices", f"{root}/cp", insert_prices(table)).awaitTermination()

    writers.write_landing(prices(spark, price(1, WEEK1, 5)), root, "prices", WEEK1)
    run()
    writers.write_landing(prices(spark, price(2, WEEK2, 6)), root, "prices", WEEK2)
    queries._age(spark, f"{root}/prices/year=2024/month=01/day=08", days=400)
    run()
    assert as_set(table.read(spark)) == {(1, 5, WEEK1), (2, 6, WEEK2)}


def test_one_price_in_two_files_of_an_increment_is_the_latest(spark, root):
    table = AppendTable(f"{root}/silver", SILVER["silver_prices"], "date")
    for hour, amount in ((13, 2000), (12, 1000)):
        prices(spark, price(1, WEEK1, amount, hour)).write.mode("append").parquet(f"{root}/prices")
    stream_landing(spark, root, "prices", f"{root}/cp", insert_prices(table)).awaitTermination()
    assert as_set(table.read(spark)) == {(1, 2000, WEEK1)}


def test_rejects_are_stored_once_and_counted(spark, root):
    house = pipeline.Warehouse(f"{root}/landing", f"{root}/silver", f"{root}/gold", f"{root}/cp")
    rows = prices(spark, price(1, WEEK1, 5), (None, "2024-01-01", 5, None), (2, "01.02.2024", 5, None))
    writers.write_landing(rows, house.landing, "prices", WEEK1)
    log = writers.RunLog(spark)
    pipeline.run_silver(spark, house, log)
    pipeline.run_silver(spark, house, log)
    assert {(r["dataset"], r["stage"], r["rows"]) for r in log.frame().collect()} >= {("prices", "silver", 1), ("prices", "rejected", 2)}
    rejects = house.rejects("prices").read(spark).collect()
    assert sorted(r["reason"] for r in rejects) == ["bad date", "no prop_id"] and '"01.02.2024"' in "".join(r["record"] for r in rejects)


def test_silver_fills_postcodes_and_run_can_fail_on_quality(spark, root):
    house = pipeline.Warehouse(f"{root}/landing", f"{root}/silver", f"{root}/gold", f"{root}/cp")
    homes = spark.createDataFrame([home(1, WEEK1, None), home(2, WEEK1)], LANDING["properties"])
    writers.write_landing(homes, house.landing, "properties", WEEK1)
    writers.write_landing(prices(spark, price(1, WEEK1, 5)), house.landing, "prices", WEEK1)
    writers.write_landing(spark.createDataFrame([("2024-01-02", 1.0, "2024-01-03")], LANDING["spy_prices"]), house.landing, "spy_prices", WEEK1)
    sites = spark.createDataFrame([("SW8 1AA", 51.5, -0.1)], "postcode string, latitude double, longitude double")
    with pytest.raises(QualityFailure, match="rules failed"):
        pipeline.run_all(spark, house, on_fail="fail", centroids=sites)
    assert {r["prop_id"]: r["area_code"] for r in house.properties.read(spark).collect()} == {1: "SW8", 2: "SW1"}
    pipeline.publish(spark, house, "published")
    assert spark.table("published.gold_current_properties").schema["prop_id"].dataType.simpleString() == "int"
    spark.sql("DROP DATABASE published CASCADE")


def test_whole_pipeline_twice(spark, root):
    house = pipeline.Warehouse(f"{root}/landing", f"{root}/silver", f"{root}/gold", f"{root}/cp")
    homes = spark.createDataFrame([home(i, WEEK1) for i in range(10)], LANDING["properties"])
    writers.write_landing(homes, house.landing, "properties", WEEK1)
    writers.write_landing(prices(spark, *[price(i, WEEK1, 1000 + i) for i in range(10)]), house.landing, "prices", WEEK1)
    index = spark.createDataFrame([("2024-01-02", 470.12, "2024-01-03")], LANDING["spy_prices"])
    writers.write_landing(index, house.landing, "spy_prices", WEEK1)
    verdicts, metrics = pipeline.run_all(spark, house)
    failed = {(r["table"], r["rule"]) for r in verdicts.where("not passed").collect()}
    assert failed == {
        ("silver_properties", "RowCount > 500"), ("silver_prices", "RowCount > 500"),
        ("gold_current_properties", "RowCount > 400"),
    }
    assert {(r["dataset"], r["rows"]) for r in metrics.where("stage = 'gold'").collect()} == {
        ("gold_area_dim", 21), ("gold_property_fact", 2), ("gold_current_properties", 10),
    }
    writers.write_landing(prices(spark, price(3, WEEK2, 5000)), house.landing, "prices", WEEK2)
    pipeline.run_all(spark, house)
    tables = pipeline.open_tables(spark, house)
    assert [tuple(r)[-2:] for r in tables["gold_current_properties"].collect()] == [(5000, WEEK2)]
    assert tables["gold_property_fact"].count() == 4
    assert tables["silver_spy_prices"].schema.simpleString() == "struct<date:date,close:double>"
    narrow = pipeline.open_tables(spark, house, published=True)["silver_spy_prices"]
    assert narrow.schema.simpleString() == "struct<date:date,close:float>"


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_dedupe(spark, root, salts):
    rows = [(1, datetime(2024, 1, 1, i % 24)) for i in range(50)] + [(2, datetime(2024, 1, 2))]
    spark.createDataFrame(rows, "k int, seen timestamp").coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("k int, seen timestamp").parquet(f"{root}/in")
    query = stream_dedupe(stream, ["k"], "seen", "30 days", salts).writeStream.format("parquet").option(
        "checkpointLocation", f"{root}/cp").option("path", f"{root}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2]


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_legacy_tables_resolve_their_inputs(spark):
    built = pipeline.build_tables({
        "landing_properties": spark.createDataFrame([home(1, WEEK1), home(2, WEEK1, "SW25 1AA")], LANDING["properties"]),
        "landing_prices": prices(spark, price(1, WEEK1, 10), price(1, WEEK1, 20, 13), price(2, WEEK1, 0)),
        "landing_spy_prices": spark.createDataFrame([], LANDING["spy_prices"]),
    })
    assert set(built) == set(pipeline.LEGACY_TABLES)
    fact = {(r["area_code"], r["avg_price"], r["num_properties"]) for r in built["gold_property_fact"].collect()}
    assert fact == {("SW1", 20, 1), ("all", 20, 1)}
    assert built["gold_current_properties"].columns[-1] == "scraped_at"
