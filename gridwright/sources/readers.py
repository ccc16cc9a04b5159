"""Readers for the job's relations.

The source job pulled whole query results into single-process frames. Here
every source is a lazy DataFrame: parquet scans get column pruning and
predicate pushdown from Catalyst; JDBC scans can be split over executors by
a numeric column, or a column of any type by predicates (hash or quantiles),
and push filters into the remote ``WHERE``.
"""

from __future__ import annotations

import datetime as _dt
import math
import re
from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# URL scheme prefix per database kind, used by the type guard.
JDBC_PREFIXES = {
    "sqlserver": "jdbc:sqlserver:",
    "postgresql": "jdbc:postgresql:",
    "clickhouse": "jdbc:clickhouse:",
}
DEFAULT_QUERY_TIMEOUT_S = 1200


def load_parquet_sources(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """``{name: path}`` -> ``{name: DataFrame}`` (S6). Nothing is read until
    an action; unused columns are never read."""
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def load_tables(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """``{name: catalog table}`` -> ``{name: DataFrame}``."""
    return {name: spark.table(table) for name, table in names.items()}


def require_kind(url: str, kind: str) -> None:
    """Refuse a connection whose declared type is not ``kind`` (the source
    job's guard before each query)."""
    prefix = JDBC_PREFIXES.get(kind)
    if prefix is None:
        raise ValueError(f"unknown database kind {kind!r}; known: {sorted(JDBC_PREFIXES)}")
    if not url.startswith(prefix):
        raise ValueError(f"connection {redact_url(url)!r} is not a {kind} connection")


# Parameters that carry a secret, in any URL form (`;k=v`, `?k=v`, `&k=v`).
_SECRET = re.compile(r"(?i)([;?&]\s*[^=;?&]*(?:password|passwd|pwd|secret|token|passphrase)[^=;?&]*=)(\{[^}]*\}|[^;&]*)")


def redact_url(url: str) -> str:
    """A JDBC URL without its secrets, for messages: ``user:password@`` and
    every parameter that names a password, secret or token."""
    head, sep, rest = url.partition("//")
    if sep:
        # Everything up to the last @ before the path is user information.
        authority = re.split(r"[/?;]", rest, maxsplit=1)[0]
        at = rest.rfind("@", 0, len(authority)) if "@" in authority else re.split(r"[?;]", rest, maxsplit=1)[0].rfind("@")
        if at >= 0:
            user = rest[:at].split(":", 1)
            rest = user[0] + (":***" if len(user) > 1 else "") + rest[at:]
    return _SECRET.sub(r"\1***", head + sep + rest)


def jdbc_options(
    url: str,
    *,
    query: str | None = None,
    dbtable: str | None = None,
    kind: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    query_timeout: int = DEFAULT_QUERY_TIMEOUT_S,
    fetchsize: int = 10000,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    prefer_timestamp_ntz: bool = True,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    ``query`` keeps the work remote as one task; ``dbtable`` (a table or a
    parenthesised sub-query) together with ``partition_column``, bounds and
    ``num_partitions`` splits the scan into parallel range reads, and lets
    Catalyst push filters and column lists to the database.

    ``prefer_timestamp_ntz`` reads zone-less database timestamps as
    ``TIMESTAMP_NTZ``: their wall-clock value is kept, so year, month and day
    are those the source system sees, whatever the JVM or session zone.
    """
    if (query is None) == (dbtable is None):
        raise ValueError("give exactly one of query= or dbtable=")
    if kind is not None:
        require_kind(url, kind)
    opts: dict[str, str] = {
        "url": url,
        "queryTimeout": str(int(query_timeout)),
        "fetchsize": str(int(fetchsize)),
        "preferTimestampNTZ": str(bool(prefer_timestamp_ntz)).lower(),
    }
    if query is not None:
        if partition_column is not None:
            raise ValueError("a partitioned read needs dbtable=, not query=")
        opts["query"] = query
    else:
        opts["dbtable"] = dbtable
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(int(num_partitions)),
        )
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A JDBC relation as a lazy DataFrame; the schema comes from the result
    metadata, empty results keep their columns."""
    return spark.read.format("jdbc").options(**options).load()


# Hash of a column, whatever its type, as the database computes it.
_HASHES = {
    "sqlserver": "ABS(CAST(CHECKSUM({column}) AS BIGINT))",
    "postgresql": "ABS(CAST(HASHTEXT(CAST({column} AS TEXT)) AS BIGINT))",
}


def hash_predicates(kind: str, column: str, parts: int) -> list[str]:
    """One condition per part of a parallel read, by the remainder of the
    column's hash: for keys of any type, whose values have no useful order.
    Every row meets exactly one of them; a NULL key meets the first."""
    if parts < 1:
        raise ValueError("parts must be positive")
    if kind not in _HASHES:
        raise ValueError(f"no hash known for {kind!r}; known: {sorted(_HASHES)}")
    hashed = _HASHES[kind].format(column=column)
    out = [f"{hashed} % {parts} = {k}" for k in range(parts)]
    # Without the test of NULL itself, a database whose hash of NULL is a
    # number would give such a row to two parts.
    return [f"({column} IS NULL OR {out[0]})", *[f"({column} IS NOT NULL AND {x})" for x in out[1:]]]


def quantile_query(table: str, column: str, parts: int) -> str:
    """The query for the lowest value of each of ``parts`` equal shares of the
    rows: one sort in the database, one row per share."""
    if parts < 1:
        raise ValueError("parts must be positive")
    return (
        f"SELECT tile, MIN(v) AS low FROM (SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS tile "
        f"FROM {table} WHERE {column} IS NOT NULL) q GROUP BY tile"
    )


def sql_literal(kind: str, value) -> str:
    """A value as a literal of the database: text, numbers, dates, binary keys."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no bound: {value!r}")
    if isinstance(value, (bytes, bytearray)):
        return f"0x{value.hex().upper()}" if kind == "sqlserver" else f"'\\x{value.hex()}'::bytea"
    if isinstance(value, int) or (isinstance(value, Decimal) and value.is_finite()):
        return str(value)
    if isinstance(value, float) and math.isfinite(value):
        return repr(value)
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep="T" if kind == "sqlserver" else " ")
        return f"CAST('{text}' AS DATETIME2)" if kind == "sqlserver" else f"TIMESTAMP '{text}'"
    if isinstance(value, _dt.date):
        return f"CAST('{value.isoformat()}' AS DATE)"
    if isinstance(value, str):
        quoted = "'" + value.replace("'", "''") + "'"
        return "N" + quoted if kind == "sqlserver" else quoted
    raise ValueError(f"no literal for a {type(value).__name__}")


def range_predicates(kind: str, column: str, lows: Iterable) -> list[str]:
    """One condition per share between ascending lowest values, as
    ``quantile_query`` gives them. Every row meets exactly one, also rows
    written since with values beyond the bounds; NULL meets the first. Shares
    that begin with the same value (a hot key) are one."""
    cuts: list = []
    for low in list(lows)[1:]:
        if not cuts or low != cuts[-1]:
            cuts.append(low)
    at = [sql_literal(kind, c) for c in cuts]
    if not at:
        return ["1 = 1"]
    inner = [f"({column} >= {lo} AND {column} < {hi})" for lo, hi in zip(at[:-1], at[1:])]
    return [f"({column} IS NULL OR {column} < {at[0]})", *inner, f"({column} >= {at[-1]})"]


def read_jdbc_parts(spark: SparkSession, options: Mapping[str, str], predicates: list[str]) -> DataFrame:
    """A JDBC table read by one task per predicate (``options`` as
    ``jdbc_options`` gives them for a ``dbtable``)."""
    opts = dict(options)
    if "partitionColumn" in opts or "query" in opts:
        raise ValueError("a read by predicates takes dbtable and no partition column")
    url, table = opts.pop("url"), opts.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=opts)


def read_jdbc_split(
    spark: SparkSession, options: Mapping[str, str], kind: str, column: str, parts: int, by: str = "hash"
) -> DataFrame:
    """A JDBC table read in ``parts`` by a column of any type: by its ``hash``,
    or by ``quantile`` (bounds from one aggregate query; ranges use an index
    of the column and stay equal where its values are uneven)."""
    if by not in ("hash", "quantile"):
        raise ValueError("by is hash or quantile")
    if by == "hash":
        return read_jdbc_parts(spark, options, hash_predicates(kind, column, parts))
    asked = {k: v for k, v in options.items() if k != "dbtable"}
    asked["query"] = quantile_query(options["dbtable"], column, parts)
    found = read_jdbc(spark, asked).collect()  # a row per part
    lows = [low for _, low in sorted(((r[0], r[1]) for r in found), key=lambda x: x[0])]
    return read_jdbc_parts(spark, options, range_predicates(kind, column, lows))


def sql_with_external_tables(
    spark: SparkSession, query: str, external_tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Run ``query`` with extra relations under names of the query's own
    (S4's "external tables" shipped with a query): ``{name}`` in the query
    stands for the relation of that name.

    No catalog name is touched: a caller's view of the same name stays as it
    is. The relations are DataFrames, so they can be as large as any other
    input; the planner broadcasts one only when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE may do so from runtime
    sizes.
    """
    return spark.sql(query, **(external_tables or {}))


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN in float/double columns turned into NULL, so one missing-value
    marker is used throughout (the source frames did not distinguish them)."""
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and (columns is None or f.name in columns)
    ]
    if not floats:
        return df
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c in floats})
