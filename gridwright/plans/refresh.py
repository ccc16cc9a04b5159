"""One refresh of the mart: build, publish, clean up.

The source job ran hourly as a chain of tasks handing whole frames to each
other. Here a refresh is one call: the three extracts and both merges are
one lazy plan, the publish write is its only full action, and the scratch
files the plan wrote (materialised maxima) are removed afterwards.

    python -m gridwright.plans.refresh --standin /root/testdata/sf0.1 --root /shared/marts
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import time

from pyspark.sql import DataFrame, SparkSession

from gridwright.config import PRODUCTION, STANDIN, JobConfig
from gridwright.plans.pay_grid import build_pay_grid
from gridwright.session import build_session, scratch_scope
from gridwright.sinks.commits import CommitLog
from gridwright.sinks.publish import PAY_GRID_LAYOUT, Layout, publish


def refresh(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    cfg: JobConfig,
    root: str,
    name: str = "pay_grid",
    mode: str = "swap",
    layout: Layout | None = PAY_GRID_LAYOUT,
    as_of: _dt.date | str | None = None,
    strategy: str = "auto",
    served: bool = False,
    land: bool = False,
) -> str:
    """Rebuild and publish the mart; returns the location now served. The
    scratch data the plan materialised is removed once the publish write,
    its last reader, has finished. ``served=True`` publishes under the served
    table's own column names (with the layout renamed to match). ``land=True``
    reads every relation once, into the shared folder, before planning (for
    JDBC sources: one consistent read of each, and one load). If another refresh
    commits while this one runs, this one changes nothing (``CommitConflict``)."""
    base = CommitLog(spark, root, name).head()  # what these rows replace: an older refresh may not
    with scratch_scope(spark):
        if land:
            from gridwright.sources.erp import land_sources

            sources = land_sources(spark, sources)
        grid = build_pay_grid(sources, cfg, as_of=as_of, strategy=strategy)
        if served:
            from gridwright.sources.erp import served_layout, served_names

            grid = served_names(grid)
            layout = served_layout() if layout is not None else None
        return publish(grid, name, root, mode=mode, layout=layout, base=base)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Rebuild and publish the pay-grid mart")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--standin", help="test-table folder: derive the nine relations from it")
    src.add_argument("--parquet", help="folder holding one <relation>.parquet per relation")
    src.add_argument("--erp-url", help="JDBC URL of the ERP database (the HR one via --hr-url)")
    ap.add_argument("--hr-url", help="JDBC URL of the HR database holding the staff list")
    ap.add_argument(
        "--connections",
        help="JSON file with user, password source, driver and per-relation partitioning (see load_connection_options)",
    )
    ap.add_argument("--served-names", action="store_true", help="publish with the served column names")
    ap.add_argument("--report", action="store_true", help="print the quality figures of the published data")
    ap.add_argument(
        "--strategy", default="auto", choices=["auto", "maxima", "agg_join", "window"],
        help="latest-per-group strategy (auto: by a sketch of the keys, see README)",
    )
    ap.add_argument("--root", required=True, help="shared folder for published versions")
    ap.add_argument("--name", default="pay_grid")
    ap.add_argument("--mode", default="swap", choices=["swap", "truncate_insert", "replace"])
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.standin:
        from gridwright.sources.standins import standin_sources

        sources, cfg = standin_sources(spark, args.standin), STANDIN
    elif args.erp_url:
        from gridwright.sources.erp import ConnectionOptions, erp_sources, load_connection_options

        if not args.hr_url:
            ap.error("--erp-url needs --hr-url")
        given = load_connection_options(args.connections) if args.connections else ConnectionOptions()
        sources = erp_sources(
            spark, args.erp_url, args.hr_url, erp_auth=given.erp, hr_auth=given.hr, partitioning=given.partitioning)
        cfg = PRODUCTION
    else:
        from gridwright.sources.readers import load_parquet_sources
        from gridwright.sources.standins import RELATIONS

        base = args.parquet.rstrip("/")
        sources = load_parquet_sources(spark, {r: f"{base}/{r}.parquet" for r in RELATIONS})
        cfg = PRODUCTION
    t0 = time.perf_counter()
    path = refresh(
        spark, sources, cfg, args.root, args.name, args.mode, as_of=args.as_of, strategy=args.strategy,
        served=args.served_names, land=bool(args.erp_url),
    )
    out = {"published": path, "name": args.name, "sec": round(time.perf_counter() - t0, 3)}
    if args.report:
        from gridwright.plans.quality_report import published_report, report_summary, summary_of
        from gridwright.sinks.publish import read_published

        if args.served_names:
            from gridwright.sources.erp import SERVED_COLUMNS

            out["report"] = report_summary(read_published(spark, args.name).toDF(*SERVED_COLUMNS))
        else:
            out["report"] = summary_of(published_report(spark, args.root, args.name))
    print(json.dumps(out, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
