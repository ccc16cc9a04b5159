"""Sources: parquet / catalog / JDBC readers and the test-data stand-ins."""

from gridwright.sources.erp import erp_sources, rename_source, served_names
from gridwright.sources.readers import (
    hash_predicates,
    jdbc_options,
    load_parquet_sources,
    load_tables,
    nan_to_null,
    quantile_query,
    range_predicates,
    read_jdbc,
    read_jdbc_parts,
    read_jdbc_split,
    require_kind,
    sql_with_external_tables,
)
from gridwright.sources.standins import STANDIN_SQL, standin_ctes, standin_sources

__all__ = [
    "STANDIN_SQL",
    "erp_sources",
    "rename_source",
    "served_names",
    "hash_predicates",
    "jdbc_options",
    "load_parquet_sources",
    "load_tables",
    "nan_to_null",
    "quantile_query",
    "range_predicates",
    "read_jdbc",
    "read_jdbc_parts",
    "read_jdbc_split",
    "require_kind",
    "sql_with_external_tables",
    "standin_ctes",
    "standin_sources",
]
