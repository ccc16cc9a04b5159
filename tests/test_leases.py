from __future__ import annotations

import os
import subprocess
import sys
import textwrap
import time

from conftest import ROOT

from gridwright import session


def test_a_killed_drivers_scratch_goes_and_a_live_ones_stays(spark, tmp_path):
    """A driver dies inside its scope; the next start removes what it left, once its lease has ended."""
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from gridwright.operators.sizing import materialize
        from gridwright.session import build_session, scratch_scope
        spark = build_session("local[1]", extra_conf={{
            "spark.checkpoint.dir": "file://{tmp_path}", "spark.gridwright.scratch.leaseSeconds": "30",
            "spark.sql.warehouse.dir": "{tmp_path}/wh"}})
        with scratch_scope(spark):
            materialize(spark.range(10), "left-behind")
            os._exit(9)
    """)
    assert subprocess.run([sys.executable, "-c", code], timeout=120, stderr=subprocess.DEVNULL).returncode == 9
    root = f"file:{tmp_path}"
    leases = os.listdir(tmp_path / session.LEASES)
    (lease,) = [n for n in leases if n.endswith(".json") and not n.startswith(".")]
    dead = tmp_path / lease[:-5]
    assert any(n.startswith("left-behind") for n in os.listdir(dead))
    live, foreign = tmp_path / "live", tmp_path / "foreign"
    live.mkdir(), foreign.mkdir()
    (tmp_path / session.LEASES / "live.json").write_text('{"owner": "x", "seconds": 30}')
    (tmp_path / session.LEASES / "torn.json").write_text("{")
    now = int(1000 * time.time())
    assert session.collect_abandoned(spark, root, now) == []  # its lease has not ended
    old = time.time() - 31
    os.utime(tmp_path / session.LEASES / lease, (old, old))
    os.utime(tmp_path / session.LEASES / "torn.json", (old, old))
    assert session.collect_abandoned(spark, root, now) == [f"{root}/{lease[:-5]}"]
    assert not dead.exists() and live.exists() and foreign.exists()
    assert session.collect_abandoned(spark, root, now) == []


def test_the_lease_is_renewed_while_the_driver_lives(spark, tmp_path, monkeypatch):
    folder = tmp_path / "mine"
    folder.mkdir()
    before = spark.conf.get(session.LEASE_KEY, None)
    spark.conf.set(session.LEASE_KEY, "2")
    try:
        session.hold_lease(spark, f"file:{folder}")
        lease = tmp_path / session.LEASES / "mine.json"
        first = lease.stat().st_mtime_ns
        session.hold_lease(spark, f"file:{folder}")  # held already
        time.sleep(2.5)
        assert lease.stat().st_mtime_ns > first
        # Its own process never collects it, whatever the times say.
        assert session.collect_abandoned(spark, f"file:{tmp_path}", int(1000 * time.time()) + 10**7) == []
        assert folder.exists()
    finally:
        session._HELD.pop(f"file:{folder}").set()
        spark.conf.set(session.LEASE_KEY, before) if before else spark.conf.unset(session.LEASE_KEY)
