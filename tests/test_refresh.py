from __future__ import annotations

from oracle import compare, duck

import __spark_entry__ as se
from gridwright.config import STANDIN
from gridwright.plans.refresh import refresh
from gridwright.session import open_scopes, run_concurrently, scratch_path, scratch_scope
from gridwright.sinks.publish import read_published
from gridwright.sources.standins import standin_sources

SF = "/root/testdata/sf0.001"


def _exists(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def test_refresh_publishes_the_pay_grid(spark):
    root = scratch_path(spark, "refresh-root")
    path = refresh(spark, standin_sources(spark, SF), STANDIN, root, name="pay_grid_refresh", as_of="2024-01-01")
    assert path.startswith(root) and open_scopes() == ()
    res = compare(read_published(spark, "pay_grid_refresh"), duck(SF), se.oracle_sql()["pay_grid"])
    assert res["columns_match"] and res["values_match"], res


def test_scratch_scope_removes_only_its_own_paths(spark):
    outside = scratch_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark) as paths:
        inside = scratch_path(spark, "inside")
        spark.range(3).write.parquet(inside)
    assert paths == [inside]
    assert not _exists(spark, inside) and _exists(spark, outside)


def test_refresh_with_served_names(spark):
    from gridwright.sources.erp import SERVED_COLUMNS

    root = scratch_path(spark, "refresh-root")
    refresh(spark, standin_sources(spark, SF), STANDIN, root, name="pay_grid_served", as_of="2024-01-01", served=True)
    served = read_published(spark, "pay_grid_served")
    assert served.columns == list(SERVED_COLUMNS.values())
    assert served.count() == 1339


def test_threads_record_into_their_callers_scope(spark):
    with scratch_scope(spark) as paths:
        made = run_concurrently(lambda: scratch_path(spark, "a"), lambda: scratch_path(spark, "b"))
    assert sorted(paths) == sorted(made)
    assert open_scopes() == ()


def test_cli_on_parquet_relations(spark, capsys):
    import json

    from gridwright.plans.refresh import main
    from gridwright.session import cluster_conf

    base = scratch_path(spark, "relations")
    for name, df in standin_sources(spark, SF).items():
        df.write.parquet(f"{base}/{name}.parquet")
    root = scratch_path(spark, "cli-root")
    main(["--parquet", base, "--root", root, "--name", "pay_grid_cli", "--as-of", "2024-01-01", "--report"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["published"].startswith(root) and "null_census" in out["report"]
    assert read_published(spark, "pay_grid_cli").columns[0] == "territory"
    assert cluster_conf(1000, 4)["spark.sql.shuffle.partitions"] == "16000"


def test_cli_served_names_with_report(spark, capsys):
    import json

    from gridwright.plans.refresh import main

    root = scratch_path(spark, "cli-root")
    main(["--standin", SF, "--root", root, "--name", "pay_grid_cli_served", "--served-names", "--report",
          "--as-of", "2024-01-01"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["report"]["null_census"]["branch"] == 1051  # FIXTURES.md: rows with NULL branch at sf0.001
    assert read_published(spark, "pay_grid_cli_served").columns[0] == "Территория"


def test_scratch_outside_a_scope_can_be_removed(spark):
    from gridwright import session

    held, session._UNSCOPED[:] = list(session._UNSCOPED), []
    try:
        path = scratch_path(spark, "unscoped")
        spark.range(3).write.parquet(path)
        assert _exists(spark, path)
        session.remove_unscoped()
        assert not _exists(spark, path) and not session._UNSCOPED
    finally:
        session._UNSCOPED[:] = held


def test_no_local_scratch_on_a_cluster():
    import pytest

    from gridwright.session import ensure_checkpoint_dir, is_local

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            raise AssertionError("no folder may be chosen here")

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    for master, local in (("local", True), ("local[8]", True), ("local[*]", True), ("local-cluster[2,1,1024]", False),
                          ("yarn", False)):
        Context.master = master
        assert is_local(Session()) is local
