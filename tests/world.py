"""A miniature source system in literal rows, with the production constants,
covering the cases listed in FIXTURES.md part A. Expected results are worked
out by hand in test_pay_grid.py."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

SCHEMAS = {
    "salary_register": "city_ref string, position_ref string, level int, salary decimal(15,2), period timestamp",
    "cities": "city_ref string, city string, city_code string",
    "positions": "position_ref string, position string, leader_level string, prefix string",
    "firms": "firm_ref string, firm_code string, firm string, city_ref string",
    "firm_territories": "firm_ref string, depth int, territory_ref string",
    "territories": "territory_ref string, territory string",
    "approvals": "doc_ref string, firm_ref string, doc_ts timestamp",
    "approval_lines": "doc_ref string, position_ref string, rate decimal(10,2)",
    "actual_staff": (
        "position string, pay_level int, current_branch string, refreshed date, "
        "city string, branch string, rrs string"
    ),
}


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


EXCLUDED_NAME = "2.03. Фед.развитие сайта"
OUTSOURCED = "Курьер (на аутсорсе)"

DATA = {
    "cities": [
        ("C1", "Moscow", "001"),
        ("C2", "Kazan", "002"),
        ("C3", None, "003"),  # NULL city name
        ("C4", "Omsk", "004"),  # no firm -> no territory
    ],
    "territories": [("T1", "Center"), ("T2", "Volga"), ("T3", "East")],
    "firms": [
        ("F1", "K1", "Moscow-1", "C1"),
        ("F2", "K2", "Kazan-1", "C2"),
        ("F3", "K3", None, "C3"),  # NULL firm name
    ],
    "firm_territories": [
        ("F1", 3, "T1"),
        ("F1", 2, "T3"),  # depth 2: ignored
        ("F2", 3, "T2"),
        ("F2", 3, "T3"),  # Kazan has two territories
        ("F3", 3, "T1"),
    ],
    "positions": [
        ("P1", "Cashier", "L1", "ABC"),
        ("P2", "Seller", "L1", None),  # NULL prefix
        ("P3", "Loader", "L1", "ДОМ"),  # excluded prefix
        ("P4", EXCLUDED_NAME, "L1", "XYZ"),  # excluded position
        ("P5", OUTSOURCED, "L1", "XYZ"),  # outsourced marker
        ("P6", None, "L1", "XYZ"),  # NULL position name
        ("P7", "Manager", "L2", "XYZ"),
        ("P8", "Driver", "L3", "XYZ"),
    ],
    "salary_register": [
        ("C1", "P1", 1, money(100), ts("2024-01-01 00:00:00")),
        ("C1", "P1", 1, money(110), ts("2024-03-01 00:00:00")),  # tie on the latest period
        ("C1", "P1", 1, money(120), ts("2024-03-01 00:00:00")),  # tie on the latest period
        ("C1", "P1", 2, money(200), None),  # NULL period
        ("C1", "P1", 2, money(210), ts("2024-02-01 00:00:00")),
        ("C1", "P2", 1, money(300), ts("2024-01-01 00:00:00")),  # NULL prefix
        ("C1", "P3", 1, money(310), ts("2024-01-01 00:00:00")),  # excluded prefix
        ("C1", "P4", 1, money(320), ts("2024-01-01 00:00:00")),  # excluded name
        ("C1", "P5", 1, money(330), ts("2024-01-01 00:00:00")),  # outsourced
        ("C1", "P6", 1, money(340), ts("2024-01-01 00:00:00")),  # NULL name
        ("C2", "P7", 1, money(500), ts("2024-01-01 00:00:00")),  # two territories
        ("C2", "P1", 1, money(550), ts("2024-01-01 00:00:00")),
        ("C3", "P7", 1, money(600), ts("2024-01-01 00:00:00")),  # NULL city name
        ("C4", "P7", 1, money(700), ts("2024-01-01 00:00:00")),  # city without firm
        ("C1", "P7", 3, money(800), ts("2024-01-01 00:00:00")),
    ],
    "approvals": [
        ("D1", "F1", ts("2024-03-10 09:00:00")),  # earlier in the month: dropped
        ("D2", "F1", ts("2024-03-31 08:00:00")),  # last day
        ("D3", "F1", ts("2024-03-31 17:00:00")),  # last day, later
        ("D4", "F1", ts("2024-02-15 12:00:00")),  # only February document
        ("D5", "F2", ts("2024-03-05 10:00:00")),
        ("D6", "F3", ts("2024-03-07 10:00:00")),
        ("D7", None, ts("2024-03-31 10:00:00")),  # NULL firm: dropped
    ],
    "approval_lines": [
        ("D1", "P2", money(1)),  # only in the earlier document: absent
        ("D2", "P1", money(1)),
        ("D3", "P1", money(2)),  # same firm and position, another time
        ("D3", "P7", money(1)),
        ("D4", "P8", money(1)),  # older month only: still in the grid
        ("D4", "P7", money(1)),
        ("D5", "P1", money(1)),
        ("D5", "P7", money(1)),
        ("D6", "P7", money(1)),
        ("D7", "P1", money(1)),
    ],
    "actual_staff": [
        ("Cashier", 1, "b", d("2024-05-01"), "Moscow", "Moscow-1", "r1"),
        ("Cashier", 1, "b", d("2024-05-01"), "Moscow", "Moscow-1", "r1"),
        ("Cashier", 1, "b", d("2023-05-01"), "Moscow", "Moscow-1", "r1"),  # other refreshed
        ("Cashier", 1, "b", d("2024-05-01"), "Moscow", "Moscow-1", "r2"),  # other rrs
        (OUTSOURCED, 1, "b", d("2024-05-01"), "Moscow", "Moscow-1", "r1"),  # not counted
        (None, 1, "b", d("2024-05-01"), "Moscow", "Moscow-1", "r1"),  # not counted
        ("Manager", 1, "b", d("2024-05-01"), "Innopolis", "Kazan-1", "r1"),  # staff city wins
        ("Cashier", 1, "b", d("2024-05-01"), None, "Kazan-1", "r1"),  # firm city used
        ("Manager", 1, "b", d("2024-05-01"), None, None, "r1"),  # NULL branch and city
        ("Driver", 2, "b", d("2024-05-01"), "Moscow", "Unknown", "r1"),  # no grid row
    ],
}


def sources(spark, empty: set[str] = frozenset()) -> dict:
    return {
        name: spark.createDataFrame([] if name in empty else DATA[name], SCHEMAS[name]) for name in SCHEMAS
    }
