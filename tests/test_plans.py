"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import re

import pytest

from conftest import bag, settings_of
from gridwright.config import STANDIN
from gridwright.operators.merge import left_merge
from gridwright.plans import pay_grid as pg
from gridwright.sources.standins import standin_sources

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def src(spark):
    return standin_sources(spark, SF)


def test_latest_pay_by_maxima_filters_big_side_without_window_or_shuffle(src):
    p = plan(pg.latest_pay(src, strategy="maxima"))
    assert "Window" not in p
    assert re.search(r"BroadcastHashJoin .*LeftSemi", p)
    # the register side of the semi-join is not hash-partitioned on the group keys
    assert "hashpartitioning(coalesce(city_ref" not in p


def test_latest_pay_agg_join_partitions_on_keys_and_period(src):
    p = plan(pg.latest_pay(src, strategy="agg_join"))
    assert "Window" not in p
    m = re.search(r"Exchange hashpartitioning\(coalesce\(city_ref[^\n]*", p)
    if m:  # a shuffle join: the ordering value is part of the partitioning
        assert "period" in m.group(0)


def test_window_strategy_is_the_literal_form(src):
    assert "Window [max(period" in plan(pg.latest_pay(src, strategy="window"))


def test_grid_uses_explode_not_union(src):
    p = plan(pg.position_grid(src, STANDIN))
    assert "Generate explode" in p
    assert "Union" not in p


def test_pay_grid_has_no_nested_loop_or_cartesian(src):
    p = plan(pg.build_pay_grid(src, STANDIN, as_of="2024-01-01"))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    # the NULL-safe merges are equi-joins on (coalesce(k), isnull(k))
    assert "isnull(city" in p


def test_filters_reach_the_scan_and_columns_are_pruned(src):
    p = plan(pg.salary_in_force(src, STANDIN, as_of="2024-01-01"))
    part_scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "p_type" in ln]
    assert part_scan and all("Not(In(p_type" in ln for ln in part_scan)
    for ln in p.splitlines():
        if "FileScan parquet" in ln and "l_orderkey" in ln:
            schema = ln.split("ReadSchema:")[1]
            assert "l_tax" not in schema and "l_discount" not in schema and "l_shipdate" not in schema


def test_headcount_is_partial_then_final_aggregate(src):
    p = plan(pg.headcount(src, STANDIN))
    assert p.count("HashAggregate") >= 2  # map-side combine before the shuffle


def test_pay_grid_by_maxima_main_query_has_no_shuffle(src):
    # Every relation joined into the pay rows is materialised, measured and,
    # being under the cap here, broadcast: the main query is one stage.
    p = plan(pg.build_pay_grid(src, STANDIN, as_of="2024-01-01", strategy="maxima"))
    assert "hashpartitioning" not in p
    assert re.search(r"BroadcastHashJoin .*LeftOuter", p)


def test_pay_grid_over_the_cap_falls_back_to_shuffle_joins(spark, src):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(pg.build_pay_grid(src, STANDIN, as_of="2024-01-01", strategy="auto"))
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_spread_by_the_semi_join_partitioning(spark, src):
    from pyspark.sql import functions as F

    from conftest import bag
    from gridwright.operators.latest import latest_per_group

    # One city holds a third of the register (derived from the test tables).
    reg = src["salary_register"].withColumn(
        "city_ref", F.when(F.col("position_ref") % 3 == 0, F.lit(0)).otherwise(F.col("city_ref"))
    )
    keys = ["city_ref", "position_ref", "level"]
    hot = reg.groupBy(keys).count().orderBy(F.desc("count")).first()
    hot_rows = reg.where((F.col("city_ref") == hot.city_ref) & (F.col("position_ref") == hot.position_ref)
                         & (F.col("level") == hot.level))
    by_keys = hot_rows.repartition(16, *keys).select(F.spark_partition_id().alias("p")).distinct().count()
    by_keys_ts = hot_rows.repartition(16, *keys, "period").select(F.spark_partition_id().alias("p")).distinct().count()
    assert by_keys == 1 and by_keys_ts >= 8

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = latest_per_group(reg, keys, "period", strategy="agg_join")
        w = latest_per_group(reg, keys, "period", strategy="window")
        u = latest_per_group(reg, keys, "period", strategy="auto")
        assert bag(a) == bag(w) == bag(u)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _null_heavy(spark, hot_side):
    """A merge of which one side has a third of its rows on one NULL key."""
    from pyspark.sql import functions as F

    reg = standin_sources(spark, "/root/testdata/sf0.01")["salary_register"]
    reg = reg.select(F.col("city_ref").cast("string").alias("city"), "position_ref", "level", "salary")
    third = F.col("position_ref") % 3 == 0
    hot = reg.withColumns({"city": F.when(third, F.lit(None)).otherwise(F.col("city")),
                           "level": F.when(third, F.lit(None)).otherwise(F.col("level"))}).repartition(8)
    few = reg.groupBy("city", "level").agg(F.count(F.lit(1)).alias("n")).unionByName(
        spark.range(3).select(F.lit(None).cast("string").alias("city"), F.lit(None).cast("int").alias("level"), F.col("id").alias("n"))
    ).unionByName(spark.createDataFrame([("nowhere", 1, 5)], "city string, level int, n bigint"))
    return (hot, few) if hot_side == "left" else (few, hot)


def _join_tasks(plan):
    """Rows that each task of the last shuffle join handed on, and whether AQE split it."""
    return [ln for ln in plan.splitlines() if "SortMergeJoin" in ln and "LeftOuter" in ln]


@pytest.mark.parametrize("hot_side", ["left", "right", "both"])
def test_a_null_heavy_key_is_split_on_either_side(spark, hot_side):
    """Over the broadcast cap the NULL-safe merge is one left sort-merge join.
    A third of the left rows on one NULL key: AQE splits that partition
    (thresholds lowered so that it does at test size). A third of the right
    rows: the key is dealt into slices. The rows are the plain left join's,
    and the left side is read once."""
    from pyspark.sql import functions as F

    from conftest import bag, settings_of
    from gridwright.operators.merge import left_merge
    from gridwright.operators.sizing import materialize

    left, right = _null_heavy(spark, "left" if hot_side == "both" else hot_side)
    if hot_side == "both":  # thousands of rows of the same NULL key on the right as well
        right = right.unionByName(spark.range(6000).select(
            F.lit(None).cast("string").alias("city"), F.lit(None).cast("int").alias("level"), (F.col("id") + 9).alias("n")))
        left = left.limit(900).repartition(8)
    left = materialize(left, "merge-left")
    expected = bag(left_merge(left, right, on=["city", "level"]).groupBy("city", "level").agg(
        F.count(F.lit(1)), F.sum(F.xxhash64(*[c for c in (*left.columns, *right.columns) if c not in ("city", "level")]) % 10**9)))
    with settings_of(spark, SPLITTING):
        out = left_merge(left, right, on=["city", "level"], split_skew=True)
        assert bag(out.groupBy("city", "level").agg(
            F.count(F.lit(1)), F.sum(F.xxhash64(*[c for c in out.columns if c not in ("city", "level")]) % 10**9))) == expected
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        out._jdf.queryExecution().toRdd().count()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = _join_tasks(final)
    assert len(joins) == 1 and "Inner" not in joins[0]
    assert final.count("merge-left") == 1 and "Union" not in final  # one scan of the left side
    if hot_side == "left":
        assert "skew=true" in joins[0], final
    if hot_side != "left":
        assert "__l_slice" in joins[0], final
    total = sum(sizes)
    assert total > 3000 and max(sizes) < total / 3, sorted(sizes)[-5:]  # four fifths of the rows made are of the hot key


def test_hot_keys_are_exact_and_null_safe(spark):
    from pyspark.sql import functions as F

    from gridwright.operators.skew import Written, hot_keys, write_with_sketch

    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 1500).alias("k"), (F.col("id") % 3).cast("string").alias("s"))
    found = write_with_sketch(rows, ["k", "s"], "hot")
    assert found.rows == 9000 and found.bytes > 9000 * 16
    hot = hot_keys(found, ["k", "s"], slice_rows=100)
    assert [tuple(r) for r in hot.collect()] == [(None, "0", 30)]
    assert hot_keys(found, ["k", "s"], null_safe=False, slice_rows=100) is None
    assert hot_keys(found, ["k", "s"], slice_rows=3000) is None
    # a hash that the sketch names without cause is no hot key
    wrong = Written(found.frame, found.rows, found.bytes, ((12345, 9000), *found.top))
    assert hot_keys(wrong, ["k", "s"], slice_rows=100).count() == 1
    empty = write_with_sketch(rows.limit(0), ["k"], "hot")
    assert empty.top == () and hot_keys(empty, ["k"]) is None


def test_city_names_and_territories_meet_the_pay_rows_once(spark, src):
    """With broadcasting off, the latest pay rows are shuffled once for the
    city side and once for the positions."""
    from conftest import settings_of

    with settings_of(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = plan(pg.salary_in_force(src, STANDIN, as_of="2024-01-01", strategy="maxima"))
    assert p.count("hashpartitioning(city_ref") <= 2 and p.count("SortMergeJoin") <= 5


def test_one_base_and_one_document_join(spark):
    """Each copy of the literal union reads the stored base; the latest step
    of the approvals reads stored rows."""
    from gridwright.plans import registry

    p = plan(registry.queries()["level_union_all"](spark, SF))
    assert "Join" not in p and p.count("FileScan parquet") == len(STANDIN.levels)
    p = plan(registry.queries()["approval_latest"](spark, SF))
    assert p.count("Join") <= 1 and "l_orderkey" not in p


def test_aqe_splits_rows_tying_on_a_hot_maximum(spark):
    """The semi-join fallback concentrates only rows that tie on the group
    maximum; when a third of all rows do, AQE splits that partition too."""
    from pyspark.sql import functions as F

    from conftest import bag
    from gridwright.operators.latest import latest_per_group

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        reg = standin_sources(spark, "/root/testdata/sf0.01")["salary_register"]
        hot = F.col("position_ref") % 3 == 0
        reg = reg.select(
            F.when(hot, F.lit(0)).otherwise(F.col("city_ref")).alias("city_ref"),
            F.when(hot, F.lit(0)).otherwise(F.col("position_ref")).alias("position_ref"),
            F.when(hot, F.lit(1)).otherwise(F.col("level")).alias("level"),
            F.when(hot, F.lit("2099-01-01").cast("timestamp_ntz")).otherwise(F.col("period")).alias("period"),
            "salary",
        )
        keys = ["city_ref", "position_ref", "level"]
        out = latest_per_group(reg, keys, "period", strategy="agg_join")
        out._jdf.queryExecution().toRdd().count()
        final = out._jdf.queryExecution().executedPlan().toString()
        semi = next(ln for ln in final.splitlines() if "SortMergeJoin" in ln and "LeftSemi" in ln)
        assert "skew=true" in semi
        assert bag(out) == bag(latest_per_group(reg, keys, "period", strategy="window"))
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_the_strategy_follows_the_sketch(spark, caplog):
    """Few groups: maxima. As many groups as rows: the window. As many, but one
    group too big for a task: the join that splits it."""
    import logging

    from pyspark.sql import functions as F

    from conftest import bag, settings_of
    from gridwright.operators.latest import choose_strategy, last_day_in_month, latest_per_group, sketch_keys, with_group_max

    n = 40_000
    base = spark.range(n).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("ts"))
    reducing = base.withColumn("k", F.col("id") % 50)
    distinct = base.withColumn("k", F.when(F.col("id") % 1000 == 5, None).otherwise(F.col("id")))
    hot = base.withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
    with settings_of(spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}), caplog.at_level(logging.INFO, "gridwright.operators.latest"):
        for df, want in ((reducing, "maxima"), (distinct, "window"), (hot, "agg_join")):
            assert choose_strategy(df, ["k"]) == want
            assert f"-> {want}" in caplog.text
            plan_text = plan(latest_per_group(df, ["k"], "ts"))
            assert ("Window" in plan_text) == (want == "window")
            expected = bag(latest_per_group(df, ["k"], "ts", strategy="window"))
            assert bag(latest_per_group(df, ["k"], "ts")) == expected
            assert bag(with_group_max(df, ["k"], "ts", "m")) == bag(with_group_max(df, ["k"], "ts", "m", strategy="window"))
        found = sketch_keys(hot, ["k"])
        assert sketch_keys(base.limit(0), ["id"]).rows == 0
    for df in (reducing, distinct, hot, base.limit(0).withColumn("k", F.lit(1))):
        assert choose_strategy(df, ["k"]) == "window"  # under the usual size of a task
    assert found.rows == n and abs(found.biggest - n // 3) < 10 and abs(found.groups - n * 2 / 3) < n * 0.1
    docs = base.select(F.col("id").alias("firm"), F.timestamp_seconds(F.col("ts") * 86400).alias("t"))
    assert bag(last_day_in_month(docs, ["firm"], "t")) == bag(last_day_in_month(docs, ["firm"], "t", strategy="window"))


def test_a_bloom_filter_thins_the_lines_before_their_shuffle(spark):
    """Over the broadcast cap of the documents, under that of their filter."""
    from pyspark.sql import functions as F

    from conftest import bag, settings_of
    from gridwright.operators.bloom import bloom_filter, possible, prefiltered
    from gridwright.operators.latest import last_day_in_month
    from gridwright.operators.sizing import materialize_measured

    s = standin_sources(spark, "/root/testdata/sf0.01")
    lines = s["approval_lines"].select("doc_ref", "position_ref")
    docs = last_day_in_month(s["approvals"].select("doc_ref", "firm_ref", "doc_ts"), ["firm_ref"], "doc_ts")
    docs, rows, size = materialize_measured(docs, "docs")
    joined = lines.join(docs, "doc_ref").count()
    words, n = bloom_filter(docs, ["doc_ref"], rows)
    kept = possible(lines, ["doc_ref"], words, n)
    assert kept.columns == lines.columns and joined <= kept.count() <= 1.1 * joined < 0.5 * lines.count()
    assert kept.join(docs, "doc_ref").count() == joined  # nothing that joins is lost
    expected = bag(pg.approved_rows(s, "agg_join"))
    with settings_of(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = pg.approved_rows(s, "maxima", broadcast_bytes=size)  # the hashed documents need twice as much
        p = plan(out)
        assert "__bloom_bits" in p and "SortMergeJoin" in p and bag(out) == expected
        below = p[p.index("SortMergeJoin"):]
        line_side = below[below.rindex("Exchange hashpartitioning(doc_ref") :]
        assert "__bloom_bits" in line_side  # under the exchange of the lines
        assert "__bloom_bits" not in plan(pg.approved_rows(s, "maxima"))
    with settings_of(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert prefiltered(lines, ["doc_ref"], docs, ["doc_ref"], rows) is lines
        assert bag(pg.approved_rows(s, "maxima")) == expected
    odd = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    words, n = bloom_filter(odd.where("v < 3"), ["k"], 2)
    assert {r.v for r in possible(odd, ["k"], words, n).collect()} >= {1, 2}
    empty, n = bloom_filter(odd.limit(0), ["k"], 0)
    assert possible(odd, ["k"], empty, n).count() == 0


def test_a_merge_sorts_by_a_hash_of_its_keys_first(spark):
    """Names that begin alike: sorts and exchanges take the hash, which is no
    column; pairs of other types are compared by themselves only."""
    left = spark.createDataFrame([("Supplier#1", "red widget #1", 1), (None, "red widget #1", 2), ("Supplier#2", None, None)],
                                 "branch string, position string, level int")
    right = spark.createDataFrame(
        [("Supplier#1", "red widget #1", 1, 5), (None, "red widget #1", 2, 6), (None, "red widget #1", 2, 7),
         ("Supplier#2", None, None, 8), ("Supplier#9", None, None, 9)],
        "branch string, position string, level bigint, headcount bigint")
    with settings_of(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        out = left_merge(left, right, on=["branch", "position", "level"])
        text = plan(out)
        sorts = re.findall(r"Sort \[(\w+)", text)
        assert len(sorts) == 2 and set(sorts) == {"xxhash64"}
        assert "level" not in re.search(r"xxhash64\(([^)]*)\)", text)[1]  # int against bigint: no common hash
        assert sorted(out.collect(), key=str) == sorted([
            ("Supplier#1", "red widget #1", 1, 5), (None, "red widget #1", 2, 6), (None, "red widget #1", 2, 7),
            ("Supplier#2", None, None, 8)], key=str)
    floats = spark.createDataFrame([(0.0, 1)], "k double, v int"), spark.createDataFrame([(-0.0, 2)], "k double, w int")
    assert left_merge(*floats, on=["k"]).collect() == [(0.0, 1, 2)]


def test_document_headers_are_made_once(spark, src, monkeypatch):
    """Over the size of one task they are written, with all that is derived
    from them read from there; the staffed grid is written with the columns
    that the mart needs."""
    names, kept = [], {}
    made, sided = pg.materialize, pg.sketched_side
    monkeypatch.setattr(pg, "materialize", lambda df, name: names.append(name) or made(df, name))
    monkeypatch.setattr(pg, "sketched_side", lambda df, keys, name: kept.update({name: df.columns}) or sided(df, keys, name))
    with settings_of(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1b"}):
        out = pg.build_pay_grid(src, STANDIN, as_of="2024-01-01")
        assert bag(out) == bag(pg.build_pay_grid(src, STANDIN, as_of="2024-01-01", strategy="window"))
    assert names == ["approvals"]
    assert kept == {"staff-counts": ["position", "pay_level", "headcount", "city", "branch"],
                    "staffed-grid": ["city", "position", "level", "branch", "headcount"]}
