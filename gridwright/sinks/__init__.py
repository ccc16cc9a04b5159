"""Sinks: atomic publish of the mart, JDBC write options."""

from gridwright.sinks.commits import Commit, CommitConflict, CommitLog, pinned
from gridwright.sinks.jdbc import jdbc_write_options, write_jdbc
from gridwright.sinks.publish import (
    MODES,
    PAY_GRID_LAYOUT,
    Layout,
    list_versions,
    lookup,
    prune_versions,
    publish,
    read_latest,
    read_published,
)

__all__ = [
    "Commit",
    "CommitConflict",
    "CommitLog",
    "MODES",
    "PAY_GRID_LAYOUT",
    "Layout",
    "jdbc_write_options",
    "list_versions",
    "lookup",
    "pinned",
    "prune_versions",
    "publish",
    "read_latest",
    "read_published",
    "write_jdbc",
]
