"""Job configuration: the constants the pay-grid job filters and expands by.

The production values are fixed by the source system and must stay exactly
as written; the stand-in values map the same roles onto the synthetic test
tables (see FIXTURES.md).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobConfig:
    """Constants of the pay-grid job.

    excluded_prefixes   position prefixes whose pay rows are ignored
    excluded_position   one position name whose pay rows are ignored
    outsourced_marker   substring marking outsourced positions (pay and staff)
    territory_depth     level of the firm territory hierarchy that names a territory
    levels              pay grades every approved position is expanded to
    """

    excluded_prefixes: tuple[str, ...]
    excluded_position: str
    outsourced_marker: str
    territory_depth: int = 3
    levels: tuple[int, ...] = (1, 2, 3)
    # Text comparison of the ERP database: None = binary (default), else a
    # Spark collation such as "UTF8_LCASE" or "UNICODE_CI", applied where that
    # database compared text (pay exclusions, territory and grid grouping).
    # "UTF8_LCASE_RTRIM" also ignores trailing blanks, as that database's
    # "=" does. The HR database and the merges compare exactly and never use it.
    collation: str | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)


# These must equal the source system's for right results.
# Excluded position prefixes: ДОМ, ГРП
# Excluded position: 2.03. Фед.развитие сайта
# Outsourced marker: (на аутсорсе)
# Territory hierarchy depth: 3
# Pay grades: 1, 2, 3
PRODUCTION = JobConfig(
    excluded_prefixes=("ДОМ", "ГРП"),
    excluded_position="2.03. Фед.развитие сайта",
    outsourced_marker="(на аутсорсе)",
    territory_depth=3,
    levels=(1, 2, 3),
)

# Fixed values of the stand-in data (FIXTURES.md part B).
# Excluded prefixes: PROMO, ECONOMY
# Excluded position: red widget
# Outsourced marker: anvil
STANDIN = JobConfig(
    excluded_prefixes=("PROMO", "ECONOMY"),
    excluded_position="red widget",
    outsourced_marker="anvil",
    territory_depth=3,
    levels=(1, 2, 3),
)
