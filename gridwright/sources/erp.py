"""The nine relations read from the source systems under their own names.

The pay register, the dimensions and the approval documents live in an ERP
reporting database (SQL Server); the current staff list lives in an HR
database (PostgreSQL). ``erp_sources`` reads each relation over JDBC as a
table (not a query string), so Catalyst pushes the column list and any
filters into the remote ``SELECT``, and renames the columns to the English
names the operators use. ``served_names`` renames the published columns
back to the names readers of the served table expect.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.operators.sizing import materialize
from gridwright.session import run_concurrently
from gridwright.sources.readers import jdbc_options, nan_to_null, read_jdbc, read_jdbc_split

# Source object names and column names (source name -> ours).
ERP_TABLES = {
    "salary_register": (
        "dwh.[РегистрСведений.УровеньЗаработнойПлаты]",
        {"Город": "city_ref", "Должность": "position_ref", "Уровень": "level", "Значение": "salary",
         "Период": "period"},
    ),
    "cities": (
        "dwh.[Справочник.Города]",
        {"Ссылка": "city_ref", "Наименование": "city", "Код": "city_code"},
    ),
    "positions": (
        "dwh.[Справочник.ШтатноеРасписание]",
        {"Ссылка": "position_ref", "Наименование": "position", "ЛидерскийУровень": "leader_level",
         "ПрефиксКДолжности": "prefix"},
    ),
    "firms": (
        "dwh.[Справочник.Фирмы]",
        {"Ссылка": "firm_ref", "Код": "firm_code", "Наименование": "firm", "Город": "city_ref"},
    ),
    "firm_territories": (
        "dwh.[Справочник.Фирмы.ИерархияТерриторий]",
        {"Ссылка": "firm_ref", "Уровень": "depth", "Территория": "territory_ref"},
    ),
    "territories": (
        "dwh.[Справочник.Территории]",
        {"Ссылка": "territory_ref", "Наименование": "territory"},
    ),
    "approvals": (
        "dwh.[Документ.УтверждениеШтатногоРасписания]",
        {"Ссылка": "doc_ref", "Фирма": "firm_ref", "Дата": "doc_ts"},
    ),
    "approval_lines": (
        "dwh.[Документ.УтверждениеШтатногоРасписания.Состав]",
        {"Ссылка": "doc_ref", "Должность": "position_ref", "КоличествоСтавок": "rate"},
    ),
}
HR_TABLES = {
    "actual_staff": (
        "actual_staff",
        {"Должность": "position", "УровеньОплаты": "pay_level", "ТекущийФилиал": "current_branch",
         "ДатаОбновления": "refreshed", "Город": "city", "Филиал": "branch", "РРС": "rrs"},
    ),
}
# Column names of the served table, in order (ours -> served).
SERVED_COLUMNS = {
    "territory": "Территория",
    "city": "Город",
    "branch": "Филиал",
    "position": "Должность",
    "level": "Уровень",
    "salary": "Зарплата",
    "leader_level": "ЛидерскийУровень",
    "headcount": "КоличествоСотрудников",
}


def served_layout():
    """The publish layout expressed in the served column names."""
    from gridwright.sinks.publish import PAY_GRID_LAYOUT, Layout

    rename = SERVED_COLUMNS.get
    return Layout(
        cluster_by=tuple(rename(c, c) for c in PAY_GRID_LAYOUT.cluster_by),
        sort_by=tuple(rename(c, c) for c in PAY_GRID_LAYOUT.sort_by),
        lookups=tuple(tuple(rename(c, c) for c in keys) for keys in PAY_GRID_LAYOUT.lookups),
    )


def rename_source(name: str, df: DataFrame) -> DataFrame:
    """Select and rename one relation's source columns to our names. Other
    columns are dropped, so they are never read."""
    table = {**ERP_TABLES, **HR_TABLES}.get(name)
    if table is None:
        raise KeyError(f"unknown relation {name!r}")
    mapping = table[1]
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"{name}: source columns missing: {missing}")
    return df.select(*[F.col(f"`{src}`").alias(ours) for src, ours in mapping.items()])


def erp_sources(
    spark: SparkSession,
    erp_url: str,
    hr_url: str,
    *,
    erp_auth: Mapping[str, str] | None = None,
    hr_auth: Mapping[str, str] | None = None,
    partitioning: Mapping[str, Mapping] | None = None,
) -> dict[str, DataFrame]:
    """The nine relations as lazy JDBC DataFrames with our column names.

    ``partitioning`` optionally maps a relation to ``partition_column``,
    ``lower_bound``, ``upper_bound`` and ``num_partitions`` for a parallel
    range read (a numeric column of the remote table), or to ``column``,
    ``parts`` and ``by`` ("hash" or "quantile") for one by a column of any
    type, as the keys of most relations are references."""
    partitioning = partitioning or {}
    out = {}
    for tables, url, kind, auth in (
        (ERP_TABLES, erp_url, "sqlserver", erp_auth or {}),
        (HR_TABLES, hr_url, "postgresql", hr_auth or {}),
    ):
        for name, (table, _) in tables.items():
            split = dict(partitioning.get(name, {}))
            by_column = {k: split.pop(k) for k in ("column", "parts", "by") if k in split}
            if by_column and not {"column", "parts"} <= set(by_column):
                raise ValueError(f"{name}: a read by predicates needs column and parts")
            opts = jdbc_options(url, dbtable=table, kind=kind, **dict(auth), **split)
            frame = read_jdbc_split(spark, opts, kind, **by_column) if by_column else read_jdbc(spark, opts)
            out[name] = rename_source(name, frame)
    return out


def land_sources(spark: SparkSession, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every relation read once, into parquet under the shared checkpoint
    folder (inside a ``scratch_scope`` it is removed with the scope).

    The plan reads the register and the documents more than once; over JDBC a
    second read could see other rows than the first, and would load the source
    system again. Relations are landed concurrently, NaN becomes NULL on the
    way (the one missing-value marker used from here on)."""
    names = list(sources)
    stored = run_concurrently(*[
        lambda n=n: materialize(nan_to_null(sources[n]), f"landed-{n}") for n in names
    ])
    return dict(zip(names, stored))


@dataclass(frozen=True)
class ConnectionOptions:
    """What a production read needs beyond the two URLs.

    ``erp`` and ``hr`` hold user, password, driver (and any other argument of
    ``jdbc_options``); ``partitioning`` maps a relation to its range read.
    """

    erp: Mapping = field(default_factory=dict)
    hr: Mapping = field(default_factory=dict)
    partitioning: Mapping[str, Mapping] = field(default_factory=dict)


def load_connection_options(path: str) -> ConnectionOptions:
    """Options from a JSON file::

        {"erp": {"user": "u", "password_env": "ERP_PASSWORD", "driver": "..."},
         "hr": {"user": "u", "password_file": "/run/secrets/hr"},
         "partitioning": {"approval_lines": {"partition_column": "...", "lower_bound": 0,
                                             "upper_bound": 1000000, "num_partitions": 64}}}

    A password is named by an environment variable or a file, never written
    in the options or on the command line."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    unknown = set(given) - {"erp", "hr", "partitioning"}
    if unknown:
        raise ValueError(f"unknown options: {sorted(unknown)}")
    wrong = set(given.get("partitioning", {})) - set(ERP_TABLES) - set(HR_TABLES)
    if wrong:
        raise ValueError(f"partitioning of unknown relations: {sorted(wrong)}")
    return ConnectionOptions(
        _with_password("erp", given.get("erp", {})), _with_password("hr", given.get("hr", {})),
        given.get("partitioning", {}),
    )


def _with_password(system: str, given: Mapping) -> dict:
    out = dict(given)
    if "password" in out:
        raise ValueError(f"{system}: name the password by password_env or password_file")
    env, path = out.pop("password_env", None), out.pop("password_file", None)
    if env is not None:
        if env not in os.environ:
            raise ValueError(f"{system}: environment variable {env} is not set")
        out["password"] = os.environ[env]
    elif path is not None:
        with open(path, encoding="utf-8") as f:
            out["password"] = f.read().rstrip("\r\n")
    return out


def served_names(df: DataFrame) -> DataFrame:
    """The published frame with the served table's column names."""
    missing = [c for c in SERVED_COLUMNS if c not in df.columns]
    if missing:
        raise KeyError(f"columns missing: {missing}")
    return df.select(*[F.col(ours).alias(served) for ours, served in SERVED_COLUMNS.items()])
