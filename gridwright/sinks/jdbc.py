"""Writing the mart to a relational database over JDBC (K1, K4).

Spark writes from every executor in parallel, ``batchsize`` rows per
round trip. ``truncate=True`` with overwrite keeps the table object and its
definition (the source job's truncate + append); ``create_column_types``
plays the role of its optional column types.

Not atomic: during the write, readers of the database table can see it
empty or partly filled, and a failed write leaves it so. Swapping a staging
table into place needs DDL run by the database itself, which a Spark writer
cannot issue; where readers must never see a partial table, publish to files
with ``publish(mode="swap")``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

PUBLISH_BATCH_ROWS = 1024
REPLACE_BATCH_ROWS = 10240


def jdbc_write_options(
    url: str,
    table: str,
    *,
    batchsize: int = PUBLISH_BATCH_ROWS,
    truncate: bool = True,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    create_column_types: Mapping[str, str] | None = None,
    isolation_level: str | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(int(batchsize)), "truncate": str(bool(truncate)).lower()}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if create_column_types:
        opts["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in create_column_types.items())
    if isolation_level is not None:
        opts["isolationLevel"] = isolation_level
    if num_partitions is not None:
        # Caps concurrent connections: Spark coalesces to this many writers.
        opts["numPartitions"] = str(int(num_partitions))
    return opts


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "overwrite") -> None:
    """Write ``df`` with the given options (``overwrite`` + ``truncate`` =
    truncate then append, ``append``, ``errorifexists``)."""
    df.write.format("jdbc").options(**options).mode(mode).save()
