"""The pay-grid mart as one lazy Spark plan.

For each territory, city, branch, position and grade: the pay in force and
the current head-count.

    salary_in_force   latest pay per (city, position, grade), ties kept,
                      fanned out to every territory of the city       (G1)
    headcount         staff counted by seven keys, two hidden          (G2)
    position_grid     positions approved in the final document of a
                      firm-month, latest per (firm code, position),
                      expanded to every grade                          (G3)
    assemble          grid <-left-> staff, then pay <-left-> grid,
                      both NULL-safe, head-count 0 when missing        (G4)

Plan shape (see README "Plans at scale"):

* The latest-pay filter runs on the narrow register *before* the dimension
  joins. Those joins are on the filter's own group keys, so each group
  either survives whole or not at all and the maxima cannot change; the
  big table then meets the dimensions already reduced to its latest rows.
* The latest-pay and last-document-day filters (``auto`` strategy) compute
  the per-group maxima first, write them to the shared checkpoint folder, measure
  them, and broadcast them only when they fit under the cap; the big input
  is then filtered map-side without being shuffled. Beyond the cap they
  use a shuffle semi-join keyed on the group *and* the ordering value, so
  one hot group is still spread over many tasks.
* The approval lines are reduced to distinct (firm, position, document
  time) triples right after the document join. Everything after that point
  only feeds a ``GROUP BY`` with no aggregate, so duplicates cannot change
  the result; partial aggregation removes them on the map side. The
  latest-per-(firm code, position) step then runs on one row per (firm
  code, position, firm, firm city) holding that combination's latest date:
  a combination has a row on the group's latest date exactly when its own
  maximum equals the group's, so the window there only ever sees a handful
  of rows per group.
* The grade expansion is an ``explode`` of a literal array: no union of
  three copies, no extra scan.
* No join carries an unconditional broadcast hint. The only explicit
  broadcasts are of materialised relations (maxima, the city map, the staff
  counts, the staffed grid) whose measured size is under the cap; elsewhere the planner broadcasts a side whose estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold`` and AQE converts joins at
  runtime from measured sizes; anything bigger is a sort-merge join, with
  AQE splitting skewed partitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwright.config import JobConfig
from gridwright.functions import run_date
from gridwright.operators.bloom import prefiltered
from gridwright.operators.filters import exclude_containing, exclude_equal, exclude_values
from gridwright.operators.latest import MEASURED, last_day_in_month, latest_per_group
from gridwright.operators.merge import fill_from, left_merge
from gridwright.operators.reduce import count_by, distinct_keys, expand_levels
from gridwright.operators.sizing import broadcast_if_small, fits_one_task, materialize, materialize_measured, small_side
from gridwright.operators.skew import Written, sketched_side
from gridwright.session import run_concurrently

SALARY_COLUMNS = ["territory", "city", "city_code", "position", "level", "salary", "run_date", "leader_level"]
STAFF_COLUMNS = ["position", "pay_level", "current_branch", "headcount", "city", "branch"]
STAFF_KEYS = ["position", "pay_level", "current_branch", "refreshed", "city", "branch", "rrs"]
STAFF_HIDDEN = ["refreshed", "rrs"]
# What the last merge reads of the staffed grid.
MERGED_COLUMNS = ["city", "position", "level", "branch", "headcount"]
GRID_COLUMNS = ["firm", "firm_city", "position", "level"]
PAY_GRID_COLUMNS = ["territory", "city", "branch", "position", "level", "salary", "leader_level", "headcount"]


# Columns the job reads from each source relation.
REQUIRED_COLUMNS = {
    "salary_register": ("city_ref", "position_ref", "level", "salary", "period"),
    "cities": ("city_ref", "city", "city_code"),
    "positions": ("position_ref", "position", "leader_level", "prefix"),
    "firms": ("firm_ref", "firm_code", "firm", "city_ref"),
    "firm_territories": ("firm_ref", "depth", "territory_ref"),
    "territories": ("territory_ref", "territory"),
    "approvals": ("doc_ref", "firm_ref", "doc_ts"),
    "approval_lines": ("doc_ref", "position_ref"),
    "actual_staff": ("position", "pay_level", "current_branch", "refreshed", "city", "branch", "rrs"),
}


def validate_sources(sources: dict[str, DataFrame]) -> None:
    """Fail fast, with every problem listed, when a relation or a column the
    job reads is missing (schema only; no data is read)."""
    problems = []
    for name, cols in REQUIRED_COLUMNS.items():
        if name not in sources:
            problems.append(f"relation {name!r} missing")
            continue
        missing = [c for c in cols if c not in sources[name].columns]
        if missing:
            problems.append(f"{name}: columns {missing} missing")
    if problems:
        raise KeyError("; ".join(problems))


def _grouped_text(df: DataFrame, cols: list[str], collation: str | None) -> DataFrame:
    """Text grouping keys compared under ``collation`` (as the source
    database compares them), e.g. case-insensitively; no-op when None."""
    if not collation:
        return df
    return df.withColumns({c: F.collate(F.col(c), collation) for c in cols})


def _plain_text(df: DataFrame, cols: list[str], collation: str | None) -> DataFrame:
    """Collated columns back to plain strings (one representative value per
    group, as the source database returns)."""
    if not collation:
        return df
    return df.withColumns({c: F.col(c).cast(T.StringType()) for c in cols})


def territory_map(sources: dict[str, DataFrame], cfg: JobConfig) -> DataFrame:
    """Distinct (territory, city_ref): cities -> firms -> hierarchy rows at
    the configured depth -> territory names (J3-J5, F5, A1)."""
    cities = sources["cities"].select("city_ref")
    firms = sources["firms"].select("firm_ref", "city_ref")
    hierarchy = sources["firm_territories"].where(F.col("depth") == cfg.territory_depth)
    territories = sources["territories"].select("territory_ref", "territory")
    joined = (
        cities.join(firms, "city_ref")
        .join(hierarchy.select("firm_ref", "territory_ref"), "firm_ref")
        .join(territories, "territory_ref")
    )
    joined = _grouped_text(joined, ["territory"], cfg.collation)
    return _plain_text(distinct_keys(joined, ["territory", "city_ref"]), ["territory"], cfg.collation)


def city_territories(sources: dict[str, DataFrame], cfg: JobConfig) -> DataFrame:
    """City names and codes with the territories of each city: the two small
    city-keyed relations meet first, so the pay rows meet them once."""
    cities = sources["cities"].select("city_ref", "city", "city_code")
    return cities.join(territory_map(sources, cfg), "city_ref")


def allowed_positions(positions: DataFrame, cfg: JobConfig) -> DataFrame:
    """Positions whose pay counts: prefix not excluded, name not the
    excluded one, name without the outsourced marker; NULLs fail all three
    (F1-F3)."""
    p = exclude_values(positions, "prefix", cfg.excluded_prefixes, cfg.collation)
    p = exclude_equal(p, "position", cfg.excluded_position, cfg.collation)
    return exclude_containing(p, "position", cfg.outsourced_marker, cfg.collation)


def latest_pay(sources: dict[str, DataFrame], strategy: str = "auto") -> DataFrame:
    """Register rows whose period is the latest of their (city, position,
    grade), ties kept (W1 + F4)."""
    register = sources["salary_register"].select("city_ref", "position_ref", "level", "salary", "period")
    # The key with the most values first: a window sorts by them in this order.
    return latest_per_group(register, ["position_ref", "city_ref", "level"], "period", strategy=strategy)


def salary_in_force(
    sources: dict[str, DataFrame],
    cfg: JobConfig,
    as_of: _dt.date | str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """G1: territory, city, city_code, position, level, salary, run_date,
    leader_level; one row per latest pay row and territory of its city."""
    positions = allowed_positions(sources["positions"], cfg).select("position_ref", "position", "leader_level")
    if strategy in MEASURED:
        latest, places = run_concurrently(
            lambda: latest_pay(sources, strategy),
            lambda: small_side(city_territories(sources, cfg), "city-territories"),
        )
    else:
        latest, places = latest_pay(sources, strategy), city_territories(sources, cfg)
    out = latest.join(places, "city_ref").join(positions, "position_ref")
    return out.select(
        "territory",
        "city",
        "city_code",
        "position",
        "level",
        "salary",
        run_date(as_of).alias("run_date"),
        "leader_level",
    )


def headcount(sources: dict[str, DataFrame], cfg: JobConfig) -> DataFrame:
    """Staff not outsourced, counted by seven keys of which ``refreshed``
    and ``rrs`` are hidden, so equal visible rows can repeat (F3, A4, P7).
    The display order of the source query is dropped: the merge that uses
    this relation does not keep it (see ``ordered_nulls_last``)."""
    # The staff list lives in the HR database, which compares text exactly:
    # the configured collation (of the ERP database) does not apply here.
    staff = exclude_containing(sources["actual_staff"], "position", cfg.outsourced_marker)
    # Grades keep their source type: a text grade must reach the merge and
    # be refused there, not be converted silently.
    visible = [k for k in STAFF_KEYS if k not in STAFF_HIDDEN]
    return count_by(staff, visible, STAFF_HIDDEN, name="headcount", output=STAFF_COLUMNS)


def approved_rows(
    sources: dict[str, DataFrame], strategy: str = "auto", broadcast_bytes: int | None = None
) -> DataFrame:
    """Distinct (firm_ref, position_ref, doc_ts) of lines in documents dated
    on the last document day of their firm-month (W3 + J8). Where it is
    measured, the documents are written first: they are broadcast under the
    cap, and beyond it a Bloom filter of their keys thins the lines."""
    approvals = sources["approvals"].select("doc_ref", "firm_ref", "doc_ts")
    big = not fits_one_task(approvals)
    if big and strategy in MEASURED:
        # Sketched, reduced to their maxima and filtered by them: the headers are made once.
        approvals = materialize(approvals, "approvals")
    final_docs = last_day_in_month(approvals, ["firm_ref"], "doc_ts", strategy=strategy)
    lines = sources["approval_lines"].select("doc_ref", "position_ref")
    if strategy == "maxima" or (strategy == "auto" and (big or not fits_one_task(final_docs))):
        final_docs, rows, size = materialize_measured(final_docs, "final-docs")
        final_docs, small = broadcast_if_small(final_docs, broadcast_bytes, size)
        if not small:  # most lines belong to other documents: they go before the shuffle
            lines = prefiltered(lines, ["doc_ref"], final_docs, ["doc_ref"], rows, broadcast_bytes)
    return final_docs.join(lines, "doc_ref").select("firm_ref", "position_ref", "doc_ts").distinct()


def approval_candidates(sources: dict[str, DataFrame], strategy: str = "auto") -> DataFrame:
    """Approved rows with firm, firm city and position names."""
    firms = sources["firms"].select("firm_ref", "firm_code", "firm", F.col("city_ref").alias("firm_city_ref"))
    positions = sources["positions"].select("position_ref", "position")
    cities = sources["cities"].select(F.col("city_ref").alias("firm_city_ref"), F.col("city").alias("firm_city"))
    return (
        approved_rows(sources, strategy)
        .join(firms, "firm_ref")
        .join(positions, "position_ref")
        .join(cities, "firm_city_ref")
    )


def position_base(sources: dict[str, DataFrame], cfg: JobConfig, strategy: str = "auto") -> DataFrame:
    """Distinct (firm, firm_city, position) approved in the latest final
    document per (firm code, position name) (W2 + F4 + A3).

    A position approved in an earlier month's final document stays even if
    the firm's latest document omits it: the maximum is per position.
    ``strategy`` applies to the last-document-day filter over the document
    headers; the per-position step runs on pre-aggregated rows (see the
    module notes) with a window, or ``agg_join`` when asked for."""
    names = ["position", "firm", "firm_city"]
    candidates = _grouped_text(approval_candidates(sources, strategy), names, cfg.collation)
    per_combo = candidates.groupBy("firm_code", "position", "firm", "firm_city").agg(
        F.max("doc_ts").alias("last_ts")
    )
    w2 = "agg_join" if strategy == "agg_join" else "window"
    latest = latest_per_group(per_combo, ["firm_code", "position"], "last_ts", strategy=w2)
    return _plain_text(distinct_keys(latest, ["firm", "firm_city", "position"]), names, cfg.collation)


def position_grid(sources: dict[str, DataFrame], cfg: JobConfig, strategy: str = "auto") -> DataFrame:
    """Firm, firm_city, position, level -- the base crossed with every
    configured grade (X1)."""
    return expand_levels(position_base(sources, cfg, strategy), cfg.levels, "level")


def staffed_grid(grid: DataFrame, staff: DataFrame, split_skew: bool | Written = False) -> DataFrame:
    """Grid rows left-merged with staff groups on (firm, position, level) =
    (branch, position, pay_level), NULL matching NULL (J12), then the staff
    city and branch filled from the firm's where missing (E4)."""
    main = left_merge(
        grid, staff, ["firm", "position", "level"], ["branch", "position", "pay_level"], split_skew=split_skew)
    main = fill_from(main, "city", "firm_city")
    return fill_from(main, "branch", "firm")


def merge_pay(salary: DataFrame, main: DataFrame, split_skew: bool | Written = False) -> DataFrame:
    """Pay rows left-merged with the staffed grid on (city, position, level),
    NULL matching NULL (J13); the eight published columns (P4), a missing
    head-count as 0 (E5). A pay row without any grid row keeps a NULL
    branch."""
    out = left_merge(salary, main, on=["city", "position", "level"], split_skew=split_skew)
    return out.select(
        "territory",
        "city",
        "branch",
        "position",
        "level",
        "salary",
        "leader_level",
        F.coalesce(F.col("headcount"), F.lit(0)).cast(T.LongType()).alias("headcount"),
    )


def measured_merges(salary, grid, staff: DataFrame) -> DataFrame:
    """J12, E4, J13, P4, E5 with both right sides written and measured. Under
    the cap a right side is broadcast and nothing is shuffled for its merge;
    over it, its hot keys are dealt into slices and AQE splits those of the
    left side (``left_merge``); either side is read once, and only the columns
    that the published ones need are written. ``salary`` and
    ``grid`` are callables, whose small jobs run beside each other and beside
    the measuring."""

    def staffed() -> tuple[DataFrame, Written | None]:
        counted = staff.select("position", "pay_level", "headcount", "city", "branch")
        approved, (counts, sketch) = run_concurrently(
            grid, lambda: sketched_side(counted, ["branch", "position", "pay_level"], "staff-counts"))
        main = staffed_grid(approved, counts, sketch or False).select(*MERGED_COLUMNS)
        return sketched_side(main, ["city", "position", "level"], "staffed-grid")

    pay, (main, sketch) = run_concurrently(salary, staffed)
    return merge_pay(pay, main, sketch or False)


def assemble(salary: DataFrame, staff: DataFrame, grid: DataFrame, strategy: str = "auto") -> DataFrame:
    """The staffed grid (J12, E4) merged into the pay rows.
    Only ``auto`` and ``maxima`` measure; the other strategies merge by joins that split a
    hot key on either side."""
    if strategy in MEASURED:
        return measured_merges(lambda: salary, lambda: grid, staff)
    return merge_pay(salary, staffed_grid(grid, staff, split_skew=True), split_skew=True)


def build_pay_grid(
    sources: dict[str, DataFrame],
    cfg: JobConfig,
    as_of: _dt.date | str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """The whole mart: G1, G2, G3 then G4. The result is lazy; one action
    (the publish write) runs it. Under ``auto`` small jobs run while the
    plan is built: they write to the shared folder, and measure, the
    per-group maxima of the pay register and of the document headers, the
    city and territory map, the staff counts and the staffed grid -- the
    relations that are broadcast when they fit under the cap. Independent ones are built
    concurrently."""
    validate_sources(sources)
    staff = headcount(sources, cfg)
    if strategy not in MEASURED:
        salary = salary_in_force(sources, cfg, as_of, strategy)
        return assemble(salary, staff, position_grid(sources, cfg, strategy), strategy)
    return measured_merges(
        lambda: salary_in_force(sources, cfg, as_of, strategy), lambda: position_grid(sources, cfg, strategy), staff)
