"""Publishing the mart.

Every publish writes a version beside what is served, commits it in the
relation's log (``gridwright.sinks.commits``), and then points the served name
at the newest commit with one catalog step. Readers see the old rows or the new
ones, never a part. A frame that fails, a writer that is late, and a catalog
step that fails leave the old rows served. The previous version stays for
readers that still use it (``keep_versions``); pinned ones stay longer.

The modes differ in the served object:

``swap`` (default)
    A view over the newest version: ``CREATE OR REPLACE VIEW``.
``truncate_insert``
    An existing table keeps its object and definition: its location is
    switched (``ALTER TABLE ... SET LOCATION``) to a version written in its
    format, with its column order and types. The first run creates the table.
    A table that the catalog holds partitioned or bucketed (made elsewhere) has
    no single step: it is overwritten in place from the committed version.
``replace``
    A table with the frame's own definition. With equal columns the location is
    switched; otherwise the old table is renamed, a new one created over the
    version already written, and the old one renamed back if that fails.

``Layout`` re-aims the source system's composite lookup indexes (K3).
Rows are clustered by territory with a ``REBALANCE`` hint -- AQE splits a
territory that holds a large share of the rows into several tasks and
merges small ones -- and sorted within each file by the first lookup's keys, so
the parquet min/max statistics let a lookup skip files and row groups. For
each lookup that this order does not serve, a sidecar index maps its keys to
the files and to the leading sort values of their rows; ``lookup`` turns these
into a predicate on the sort order. All columns are stored in the files with
their own types. Nothing is written as a folder name: a folder partition is
text that has to be guessed back (``'007'`` reads as 7, an empty text as NULL).
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridwright.operators.merge import check_key_types
from gridwright.operators.quality import null_counts
from gridwright.sinks.commits import Commit, CommitConflict, CommitLog

log = logging.getLogger(__name__)

MODES = ("swap", "truncate_insert", "replace")
# Formats whose tables are switched by their location.
FORMATS = ("parquet", "orc")
# Column of a sidecar index with the file, and how many places a lookup takes from it.
FILE = "__file"
INDEX_HITS = 1000
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


@dataclass(frozen=True)
class Layout:
    cluster_by: tuple[str, ...] = ("territory",)
    sort_by: tuple[str, ...] = ("territory", "city", "branch", "position")
    max_records_per_file: int | None = None
    # Key lists to look rows up by; those that sort_by does not begin with get an index.
    lookups: tuple[tuple[str, ...], ...] = ()
    row_group_bytes: int | None = None


# The three lookups served by the source table.
PAY_GRID_LAYOUT = Layout(lookups=(
    ("territory", "city", "position"),
    ("territory", "branch", "position"),
    ("territory", "city", "branch", "position"),
))


def _check_name(name: str) -> None:
    if not _NAME.match(name):
        raise ValueError(f"not a plain table name: {name!r}")


def _quote(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _arrange(df: DataFrame, layout: Layout | None) -> DataFrame:
    """Rows clustered and sorted for the layout (no-op without one)."""
    if layout is None:
        return df
    named = (*layout.cluster_by, *layout.sort_by, *(c for keys in layout.lookups for c in keys))
    missing = [c for c in named if c not in df.columns]
    if missing:
        raise KeyError(f"layout columns not in the frame: {missing}")
    cols = [F.col(_quote(c)) for c in layout.cluster_by]
    clustered = df.hint("rebalance", *cols) if cols else df
    if layout.sort_by:
        clustered = clustered.sortWithinPartitions(*layout.sort_by)
    return clustered


def _writer(df: DataFrame, layout: Layout | None):
    if layout is None:
        return df.write
    w = _arrange(df, layout).write
    if layout.max_records_per_file:
        w = w.option("maxRecordsPerFile", int(layout.max_records_per_file))
    if layout.row_group_bytes:
        w = w.option("parquet.block.size", int(layout.row_group_bytes))
    return w


def _version_folder() -> str:
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"v{stamp}-{uuid.uuid4().hex[:8]}"  # the stamp is for people; the log orders the versions


def list_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Folders of the committed versions of ``name`` under ``root``, in the
    order of their commits."""
    log = CommitLog(spark, root, name)
    return list(dict.fromkeys(log.storage.qualified(c.path) for c in log.commits()))


def prune_versions(spark: SparkSession, root: str, name: str, keep: int) -> list[str]:
    """Remove all but the newest ``keep`` versions (pinned ones stay)."""
    return CommitLog(spark, root, name).prune(keep)


def publish(
    df: DataFrame,
    name: str,
    root: str,
    mode: str = "swap",
    layout: Layout | None = PAY_GRID_LAYOUT,
    keep_versions: int = 2,
    base: int | None = None,
) -> str:
    """Publish ``df`` as ``name``; returns the data location now served.

    ``base`` is the commit that the caller's rows were computed from
    (``CommitLog.head`` before the sources were read; default: the newest when
    the call begins). If another writer commits in between, this call changes
    nothing and raises ``CommitConflict``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    _check_name(name)
    spark = df.sparkSession
    log_of = CommitLog(spark, root, name)
    if base is None:
        base = log_of.head()
    table = _table(spark, name) if mode != "swap" else None
    if table and mode == "truncate_insert":
        df = _as_defined(df, name, table)
    storage_format = table["format"] if table and mode == "truncate_insert" and table["switchable"] else "parquet"
    # Rows written and NULLs of each column, counted during the write itself (no extra job).
    written = Observation(f"publish-{name}-{uuid.uuid4().hex[:8]}")
    nulls = [c.alias(f"nulls_{k}") for k, c in enumerate(null_counts(df).values())]
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"), *nulls)
    folder = _version_folder()
    path = f"{log_of.base}/{folder}"
    try:
        _writer(counted, layout).format(storage_format).mode("errorifexists").save(path)
        indexes = _write_indexes(spark, df.schema, path, layout) if storage_format == "parquet" else []
        detail = {"mode": mode, "format": storage_format, "indexes": indexes,
                  "sort_by": list(layout.sort_by) if layout else [],
                  "nulls": {c: written.get[f"nulls_{k}"] for k, c in enumerate(df.columns)}}
        before = log_of.latest()
        commit = log_of.append(base, folder, written.get["rows"], df.schema, detail)
    except BaseException:
        log_of.storage.delete(path)  # nothing of a failed or late writer stays
        raise
    try:
        _serve(spark, name, log_of, commit, table)
    except BaseException:
        _undo(log_of, commit, before)
        raise
    if keep_versions:
        log_of.prune(keep_versions)
    log.info("published %s (%s) as commit %d: %d rows at %s", name, mode, commit.sequence, commit.rows, path)
    return path


def _undo(log_of: CommitLog, commit: Commit, before: Commit | None) -> None:
    """The catalog still serves what it served: the log says so too, by a
    commit that names the earlier version again (or none, if there is none)."""
    if before is None:
        log_of.withdraw(commit)
        return
    try:
        log_of.append(commit.sequence, before.folder, before.rows, before.schema, before.detail)
    except CommitConflict:
        pass  # a later writer serves its own version


def _catalog_step(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def _table(spark: SparkSession, name: str) -> dict | None:
    """Columns, format and location of an existing table; None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    found = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
    if found["type"] == "VIEW":
        raise ValueError(f"{name} is a view; publish it with mode='swap'")
    spread = bool(found.get("partition_columns")) or "num_buckets" in found
    return {"schema": spark.table(name).schema, "format": found.get("provider", "parquet"),
            "location": found["location"], "switchable": not spread and found.get("provider") in FORMATS}


def _as_defined(df: DataFrame, name: str, table: dict) -> DataFrame:
    """The frame's columns in the order and types of the table's definition."""
    schema = table["schema"]
    if sorted(schema.names) != sorted(df.columns):
        raise ValueError(f"columns differ from {name}: {sorted(df.columns)} vs {sorted(schema.names)}")
    check_key_types(df, df.sparkSession.createDataFrame([], schema), schema.names, schema.names)
    return df.select(*[
        F.col(_quote(f.name)).cast(f.dataType).alias(f.name) if df.schema[f.name].dataType != f.dataType
        else F.col(_quote(f.name)) for f in schema.fields])


def _serve(spark: SparkSession, name: str, log_of: CommitLog, commit: Commit, table: dict | None) -> None:
    """Point the served name at the newest commit: ``commit``, or one that
    another writer made after it."""
    while True:
        if commit.detail["mode"] == "swap":
            columns = ", ".join(map(_quote, commit.schema.names))
            _catalog_step(spark, f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{commit.path}`")
        else:
            _serve_table(spark, name, commit, table)
        newest = log_of.latest()
        if newest is None or newest.sequence == commit.sequence:
            return
        commit, table = newest, _table(spark, name) if newest.detail["mode"] != "swap" else None


def _create(spark: SparkSession, name: str, schema, fmt: str, location: str) -> None:
    columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    _catalog_step(spark, f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION {_text(location)}")


def _serve_table(spark: SparkSession, name: str, commit: Commit, table: dict | None) -> None:
    fmt = commit.detail["format"]
    if table is None:
        _create(spark, name, commit.schema, fmt, commit.path)
        return
    same = [(f.name, f.dataType) for f in table["schema"]] == [(f.name, f.dataType) for f in commit.schema]
    if same and table["switchable"] and table["format"] == fmt:
        _catalog_step(spark, f"ALTER TABLE {name} SET LOCATION {_text(commit.path)}")
        spark.catalog.refreshTable(name)
    elif commit.detail["mode"] == "truncate_insert":
        _overwrite_in_place(spark, name, commit)
    elif not table["switchable"]:
        raise ValueError(f"{name} is partitioned or bucketed; drop it before replacing it by a plain table")
    else:
        aside = f"{name}__{uuid.uuid4().hex[:8]}"
        _catalog_step(spark, f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            _create(spark, name, commit.schema, fmt, commit.path)
        except BaseException:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise
        _catalog_step(spark, f"DROP TABLE {aside}")


def _overwrite_in_place(spark: SparkSession, name: str, commit: Commit) -> None:
    """The whole table from the committed version, whatever the session's
    partitionOverwriteMode (set in a session of its own, so no other thread
    sees it)."""
    own = spark.newSession()
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    rows = own.read.schema(commit.schema).format(commit.detail["format"]).load(commit.path)
    rows.write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def read_published(spark: SparkSession, name: str) -> DataFrame:
    """The served relation (the catalog view or table of this session's
    metastore)."""
    _check_name(name)
    return spark.table(name)


def read_latest(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """The newest committed version of ``name`` under ``root``, for readers in
    any session. Names and types are those of the published frame, kept in its
    manifest; pass ``schema`` to require one. Use ``commits.pinned`` to keep
    the version while it is read."""
    commit = CommitLog(spark, root, name).latest()
    if commit is None:
        raise FileNotFoundError(f"no committed version of {name!r} under {root!r}")
    return spark.read.schema(schema or commit.schema).format(commit.detail["format"]).load(commit.path)


# ---------------------------------------------------------------- access paths


def _index_folder(keys: tuple[str, ...] | list[str]) -> str:
    return "_by-" + "-".join(re.sub(r"\W", lambda m: f"%{ord(m[0]):x}", k) for k in keys)


def _write_indexes(spark: SparkSession, schema, path: str, layout: Layout | None) -> list[list[str]]:
    """A sidecar for each lookup of which the sort order serves no more than
    the clustering columns. Its rows are the distinct (keys, leading sort columns, file) of the written rows,
    sorted by the keys; only those columns are read. It lies in a hidden folder
    of the version, so it lives and goes with it."""
    written = []
    for keys in layout.lookups if layout else ():
        if _prefix(layout.sort_by, keys) > len(layout.cluster_by):
            continue
        columns = list(dict.fromkeys([*keys, *_leading(layout.sort_by, keys)]))
        rows = spark.read.schema(schema).parquet(path).select(
            *[F.col(_quote(c)) for c in columns], F.col("_metadata.file_name").alias(FILE)).distinct()
        first = F.col(_quote(keys[0]))
        index = rows.hint("rebalance", first).sortWithinPartitions(*[F.col(_quote(k)) for k in keys])
        writer = index.write
        if layout.row_group_bytes:
            writer = writer.option("parquet.block.size", int(layout.row_group_bytes))
        writer.parquet(f"{path}/{_index_folder(keys)}")
        written.append(list(keys))
    return written


def _prefix(columns, given) -> int:
    """How many of ``columns``, from the first on, are among ``given``."""
    return next((k for k, c in enumerate(columns) if c not in given), len(columns))


def _leading(sort_by, keys) -> list[str]:
    """Sort columns up to the first one after which the keys narrow no further:
    what has to be known beside the keys to find their rows in the sort order."""
    out = []
    for c in sort_by:
        out.append(c)
        if not set(keys) - set(out) or c not in keys:
            break
    return out


def lookup(spark: SparkSession, root: str, name: str, **equals) -> DataFrame:
    """The rows of the newest version whose columns equal the given values
    (None: is NULL), by the access path that serves most of them: the sort
    order, or a sidecar index, which names the files and the leading sort
    values to look at. If it names more than ``INDEX_HITS`` of them, the rows
    are no small part of the sort range and are read by the sort order."""
    commit = CommitLog(spark, root, name).latest()
    if commit is None:
        raise FileNotFoundError(f"no committed version of {name!r} under {root!r}")
    unknown = set(equals) - set(commit.schema.names)
    if unknown:
        raise KeyError(f"no such columns: {sorted(unknown)}")

    def condition(columns):
        tests = [F.col(_quote(c)).eqNullSafe(F.lit(equals[c])) for c in columns]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def served(columns) -> int:
        return _prefix(columns, equals)

    reader = spark.read.schema(commit.schema).format(commit.detail["format"])
    best = max(commit.detail["indexes"], key=served, default=None)
    if best is None or served(best) <= served(commit.detail["sort_by"]):
        return reader.load(commit.path).where(condition(equals))
    index = spark.read.parquet(f"{commit.path}/{_index_folder(best)}")
    places = [c for c in index.columns if c not in equals and c != FILE]
    places = [c for c in _leading(commit.detail["sort_by"], best) if c in places]
    hits = index.where(condition([c for c in index.columns if c in equals])).select(FILE, *map(_quote, places)).distinct()
    found = hits.limit(INDEX_HITS + 1).collect()
    if not found:
        return reader.load(commit.path).where(F.lit(False))
    if len(found) > INDEX_HITS:
        return reader.load(commit.path).where(condition(equals))
    where = condition(equals)
    for c in places:
        values = {r[c] for r in found}
        some = F.col(_quote(c)).isin([v for v in values if v is not None])
        where = where & ((some | F.col(_quote(c)).isNull()) if None in values else some)
    return reader.load([f"{commit.path}/{f}" for f in sorted({r[FILE] for r in found})]).where(where)
