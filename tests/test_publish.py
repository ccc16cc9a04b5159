from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import bag, settings_of
from gridwright.session import scratch_path
from gridwright.sinks.publish import Layout, list_versions, publish, read_latest, read_published

SCHEMA = (
    "territory string, city string, branch string, position string, level int, salary decimal(15,2), "
    "leader_level string, headcount bigint"
)


def grid(spark, n=1):
    from decimal import Decimal

    data = [
        ("Center", "Moscow", "b1", "p", 1, Decimal("10.00"), "L", n),
        ("Center", "Moscow", None, "q", 2, Decimal("20.00"), "L", 0),
        (None, None, None, "q", 3, Decimal("30.00"), None, 0),  # NULL partition value
        ("123", "x", "b", "p", 1, Decimal("1.00"), "L", 1),  # numeric-looking partition value
    ]
    return spark.createDataFrame(data, SCHEMA)


def name():
    return "t_" + uuid.uuid4().hex[:10]


def test_swap_first_publish_and_republish(spark):
    root, n = scratch_path(spark, "pub"), name()
    first = publish(grid(spark, 1), n, root)
    served = read_published(spark, n)
    assert served.schema.simpleString() == grid(spark).schema.simpleString()
    assert bag(served) == bag(grid(spark, 1))
    second = publish(grid(spark, 2), n, root)
    assert second != first
    assert bag(read_published(spark, n)) == bag(grid(spark, 2))
    # previous version kept, nothing older
    assert list_versions(spark, root, n) == sorted([first, second])
    third = publish(grid(spark, 3), n, root, keep_versions=2)
    assert list_versions(spark, root, n) == sorted([second, third])


def test_swap_layout_is_sorted_and_lookups_skip_by_statistics(spark):
    root, n = scratch_path(spark, "pub"), name()
    path = publish(grid(spark), n, root, layout=Layout())
    assert spark.read.parquet(path).schema == grid(spark).schema  # every column in the files, nothing in folder names
    plan = read_published(spark, n).where(F.col("territory") == "Center")._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(territory), EqualTo(territory,Center)]" in plan.toString()


AWKWARD = ["007", "010", "", None, "a/b", "k=v", " lead", "trail ", "two  words", "%2F", "NULL", "1e3", "2024-01-01", "Ü"]


def awkward(spark, some=AWKWARD):
    return spark.createDataFrame([(t, f"c{i}", i) for i, t in enumerate(some)], "territory string, city string, n int")


AWKWARD_LAYOUT = Layout(cluster_by=("territory",), sort_by=("territory", "city"))


@pytest.mark.parametrize("mode", ["swap", "truncate_insert", "replace"])
def test_awkward_values_round_trip_exactly(spark, mode):
    root, n, df = scratch_path(spark, "pub"), name(), awkward(spark)
    for _ in range(2):
        publish(df, n, root, mode=mode, layout=AWKWARD_LAYOUT)
    assert bag(read_published(spark, n)) == bag(df) and read_published(spark, n).schema == df.schema
    if mode == "swap":
        for latest in (read_latest(spark, root, n), read_latest(spark, root, n, schema=df.schema)):
            assert bag(latest) == bag(df) and latest.schema == df.schema


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
@pytest.mark.parametrize("mode", ["swap", "truncate_insert", "replace"])
def test_a_shrinking_republish_leaves_no_old_rows(spark, mode, overwrite):
    root, n = scratch_path(spark, "pub"), name()
    less = awkward(spark, ["x"])
    with settings_of(spark, {"spark.sql.sources.partitionOverwriteMode": overwrite}):
        publish(awkward(spark), n, root, mode=mode, layout=AWKWARD_LAYOUT)
        publish(less, n, root, mode=mode, layout=AWKWARD_LAYOUT)
    assert bag(read_published(spark, n)) == bag(less)


def test_a_partitioned_table_made_elsewhere_is_replaced_whole(spark):
    root, n = scratch_path(spark, "pub"), name()
    df = spark.createDataFrame([("x", 1), ("y", 2)], "t string, v int")
    df.write.partitionBy("t").option("path", f"{root}/{n}/old").saveAsTable(n)
    with settings_of(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        publish(df.where("t = 'x'"), n, root, mode="truncate_insert", layout=None)
    assert [tuple(r) for r in read_published(spark, n).select("t", "v").collect()] == [("x", 1)]


def test_failed_publish_keeps_old_version(spark):
    root, n = scratch_path(spark, "pub"), name()
    publish(grid(spark, 1), n, root)
    boom = grid(spark, 9).withColumn(
        "headcount", F.when(F.col("level") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("headcount"))
    ).withColumn("headcount", F.col("headcount").cast("bigint"))
    with pytest.raises(Exception):
        publish(boom, n, root)
    assert bag(read_published(spark, n)) == bag(grid(spark, 1))


def test_truncate_insert_twice_equals_once(spark):
    root, n = scratch_path(spark, "pub"), name()
    publish(grid(spark, 1), n, root, mode="truncate_insert", layout=None)
    publish(grid(spark, 2), n, root, mode="truncate_insert", layout=None)
    assert bag(read_published(spark, n)) == bag(grid(spark, 2))


def test_truncate_insert_failure_keeps_table(spark):
    root, n = scratch_path(spark, "pub"), name()
    publish(grid(spark, 1), n, root, mode="truncate_insert", layout=None)
    boom = grid(spark, 9).withColumn("headcount", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception):
        publish(boom, n, root, mode="truncate_insert", layout=None)
    assert bag(read_published(spark, n)) == bag(grid(spark, 1))


def test_replace_mode(spark):
    root, n = scratch_path(spark, "pub"), name()
    publish(grid(spark, 1), n, root, mode="replace", layout=None)
    publish(grid(spark, 4), n, root, mode="replace", layout=None)
    assert bag(read_published(spark, n)) == bag(grid(spark, 4))


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        publish(grid(spark), "x; drop", "/tmp/none")
    with pytest.raises(ValueError):
        publish(grid(spark), "ok_name", "/tmp/none", mode="upsert")
    with pytest.raises(KeyError):
        publish(grid(spark), "ok_name", scratch_path(spark, "pub"), layout=Layout(sort_by=("nope",)))


def test_truncate_insert_with_a_layout(spark):
    root, n = scratch_path(spark, "pub"), name()
    publish(grid(spark, 1), n, root, mode="truncate_insert", layout=Layout())
    publish(grid(spark, 5), n, root, mode="truncate_insert", layout=Layout())
    assert bag(read_published(spark, n)) == bag(grid(spark, 5))


def test_read_latest_from_any_session(spark):
    root, n = scratch_path(spark, "pub"), name()
    with pytest.raises(FileNotFoundError):
        read_latest(spark, root, n)
    publish(grid(spark, 1), n, root)
    publish(grid(spark, 2), n, root)
    latest = read_latest(spark, root, n, schema=grid(spark).schema)
    assert latest.schema == grid(spark).schema
    assert bag(latest) == bag(grid(spark, 2))


def test_plain_local_root_keeps_versions(spark, tmp_path):
    root, n = str(tmp_path / "marts"), name()  # no scheme
    first = publish(grid(spark, 1), n, root)
    second = publish(grid(spark, 2), n, root, keep_versions=1)
    assert [v.split("/")[-1] for v in list_versions(spark, root, n)] == [second.split("/")[-1]]
    assert first != second
    assert bag(read_published(spark, n)) == bag(grid(spark, 2))


def test_publish_logs_rows_written(spark, caplog):
    import logging

    root, n = scratch_path(spark, "pub"), name()
    with caplog.at_level(logging.INFO, logger="gridwright.sinks.publish"):
        publish(grid(spark, 1), n, root)
        publish(grid(spark, 1), n + "_t", root, mode="truncate_insert", layout=None)
        publish(grid(spark, 1), n + "_t", root, mode="truncate_insert", layout=None)
    assert caplog.text.count(": 4 rows at") == 3


def test_rebalance_splits_an_oversized_territory_across_writers(spark):
    from gridwright.config import STANDIN
    from gridwright.plans.pay_grid import build_pay_grid
    from gridwright.sources.standins import standin_sources

    pay = build_pay_grid(standin_sources(spark, "/root/testdata/sf0.01"), STANDIN, as_of="2024-01-01")
    # one territory holds about a third of the rows; the upstream stage gets
    # several map tasks, as on a cluster (AQE splits a skewed partition only
    # at map-output boundaries, and this test table is one parquet row group)
    pay = pay.withColumn(
        "territory", F.when(F.col("position").contains("o"), F.lit("HOT")).otherwise(F.col("territory"))
    ).repartition(8)
    previous = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        root, n = scratch_path(spark, "pub"), name()
        path = publish(pay, n, root, layout=Layout())
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", previous)
    hot = spark.read.parquet(path).where("territory = 'HOT'").select(F.input_file_name().alias("f")).distinct()
    assert hot.count() >= 4  # the hot territory was written by several tasks, not one
    assert bag(read_published(spark, n)) == bag(pay)


def test_read_latest_ignores_an_uncommitted_version(spark):
    root, n = scratch_path(spark, "pub"), name()
    publish(grid(spark, 1), n, root)
    # a later write that died before its commit: data files, no _SUCCESS
    partial = f"{root}/{n}/v99991231T000000000000-deadbeef"
    grid(spark, 7).write.parquet(partial)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(partial + "/_SUCCESS")
    fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs_path, False)
    assert bag(read_latest(spark, root, n, schema=grid(spark).schema)) == bag(grid(spark, 1))
    assert partial not in " ".join(list_versions(spark, root, n))
