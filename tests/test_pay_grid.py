from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from world import money, sources

from conftest import bag
from gridwright.config import PRODUCTION
from gridwright.plans import pay_grid as pg

AS_OF = dt.date(2024, 6, 30)
CFG = PRODUCTION


@pytest.fixture(scope="module")
def src(spark):
    return sources(spark)


EXPECTED_SALARY = Counter(
    {
        ("Center", "Moscow", "001", "Cashier", 1, money(110), AS_OF, "L1"): 1,
        ("Center", "Moscow", "001", "Cashier", 1, money(120), AS_OF, "L1"): 1,
        ("Center", "Moscow", "001", "Cashier", 2, money(210), AS_OF, "L1"): 1,
        ("Volga", "Kazan", "002", "Manager", 1, money(500), AS_OF, "L2"): 1,
        ("East", "Kazan", "002", "Manager", 1, money(500), AS_OF, "L2"): 1,
        ("Volga", "Kazan", "002", "Cashier", 1, money(550), AS_OF, "L1"): 1,
        ("East", "Kazan", "002", "Cashier", 1, money(550), AS_OF, "L1"): 1,
        ("Center", None, "003", "Manager", 1, money(600), AS_OF, "L2"): 1,
        ("Center", "Moscow", "001", "Manager", 3, money(800), AS_OF, "L2"): 1,
    }
)

EXPECTED_STAFF = Counter(
    {
        ("Cashier", 1, "b", 2, "Moscow", "Moscow-1"): 1,
        ("Cashier", 1, "b", 1, "Moscow", "Moscow-1"): 2,  # refreshed / rrs hidden
        ("Manager", 1, "b", 1, "Innopolis", "Kazan-1"): 1,
        ("Cashier", 1, "b", 1, None, "Kazan-1"): 1,
        ("Manager", 1, "b", 1, None, None): 1,
        ("Driver", 2, "b", 1, "Moscow", "Unknown"): 1,
    }
)

EXPECTED_BASE = Counter(
    {
        ("Moscow-1", "Moscow", "Cashier"): 1,
        ("Moscow-1", "Moscow", "Manager"): 1,
        ("Moscow-1", "Moscow", "Driver"): 1,
        ("Kazan-1", "Kazan", "Cashier"): 1,
        ("Kazan-1", "Kazan", "Manager"): 1,
        (None, None, "Manager"): 1,
    }
)

EXPECTED_PAY_GRID = Counter(
    {
        ("Center", "Moscow", "Moscow-1", "Cashier", 1, money(110), "L1", 2): 1,
        ("Center", "Moscow", "Moscow-1", "Cashier", 1, money(110), "L1", 1): 2,
        ("Center", "Moscow", "Moscow-1", "Cashier", 1, money(120), "L1", 2): 1,
        ("Center", "Moscow", "Moscow-1", "Cashier", 1, money(120), "L1", 1): 2,
        ("Center", "Moscow", "Moscow-1", "Cashier", 2, money(210), "L1", 0): 1,  # grid without staff
        ("Volga", "Kazan", None, "Manager", 1, money(500), "L2", 0): 1,  # no grid row left for Kazan
        ("East", "Kazan", None, "Manager", 1, money(500), "L2", 0): 1,
        ("Volga", "Kazan", "Kazan-1", "Cashier", 1, money(550), "L1", 1): 1,  # firm city used
        ("East", "Kazan", "Kazan-1", "Cashier", 1, money(550), "L1", 1): 1,
        ("Center", None, None, "Manager", 1, money(600), "L2", 1): 1,  # NULL city matches NULL city
        ("Center", "Moscow", "Moscow-1", "Manager", 3, money(800), "L2", 0): 1,
    }
)


@pytest.mark.parametrize("strategy", ["auto", "maxima", "agg_join", "window"])
def test_salary_in_force(spark, src, strategy):
    out = pg.salary_in_force(src, CFG, as_of=AS_OF, strategy=strategy)
    assert out.columns == pg.SALARY_COLUMNS
    assert bag(out) == EXPECTED_SALARY


def test_territory_map(src):
    assert bag(pg.territory_map(src, CFG)) == Counter(
        {("Center", "C1"): 1, ("Volga", "C2"): 1, ("East", "C2"): 1, ("Center", "C3"): 1}
    )


def test_headcount(src):
    out = pg.headcount(src, CFG)
    assert out.columns == pg.STAFF_COLUMNS
    assert dict(out.dtypes)["headcount"] == "bigint"
    assert bag(out) == EXPECTED_STAFF


@pytest.mark.parametrize("strategy", ["auto", "maxima", "agg_join", "window"])
def test_position_base(src, strategy):
    assert bag(pg.position_base(src, CFG, strategy)) == EXPECTED_BASE


def test_position_grid_expands_levels(src):
    out = pg.position_grid(src, CFG)
    assert out.columns == pg.GRID_COLUMNS
    assert dict(out.dtypes)["level"] == "int"
    expected = Counter({(*k, lvl): 1 for k in EXPECTED_BASE for lvl in (1, 2, 3)})
    assert bag(out) == expected


def test_staffed_grid_fills(src):
    grid = pg.position_grid(src, CFG)
    main = pg.staffed_grid(grid, pg.headcount(src, CFG))
    got = bag(main.select("firm", "position", "level", "city", "branch", "headcount"))
    # grid row without staff: branch = firm, city = firm city, head-count NULL
    assert got[("Moscow-1", "Driver", 3, "Moscow", "Moscow-1", None)] == 1
    # staff city wins over the firm city
    assert got[("Kazan-1", "Manager", 1, "Innopolis", "Kazan-1", 1)] == 1
    # staff city NULL: firm city used
    assert got[("Kazan-1", "Cashier", 1, "Kazan", "Kazan-1", 1)] == 1
    # NULL firm matched NULL branch
    assert got[(None, "Manager", 1, None, None, 1)] == 1
    # staff without a grid row is absent
    assert not any(k[4] == "Unknown" for k in got)


@pytest.mark.parametrize("strategy", ["auto", "maxima", "agg_join", "window"])
def test_pay_grid(src, strategy):
    out = pg.build_pay_grid(src, CFG, as_of=AS_OF, strategy=strategy)
    assert out.columns == pg.PAY_GRID_COLUMNS
    assert dict(out.dtypes)["headcount"] == "bigint"
    assert bag(out) == EXPECTED_PAY_GRID


def test_pay_grid_at_least_as_many_rows_as_salary(src):
    salary = pg.salary_in_force(src, CFG, as_of=AS_OF)
    assert pg.build_pay_grid(src, CFG, as_of=AS_OF).count() >= salary.count()


def test_no_staff_gives_zero_headcount(spark):
    src = sources(spark, empty={"actual_staff"})
    out = pg.build_pay_grid(src, CFG, as_of=AS_OF)
    assert {r.headcount for r in out.collect()} == {0}


@pytest.mark.parametrize("name", sorted(sources.__globals__["SCHEMAS"]))
def test_empty_input_keeps_schema(spark, name):
    src = sources(spark, empty={name})
    out = pg.build_pay_grid(src, CFG, as_of=AS_OF)
    assert out.columns == pg.PAY_GRID_COLUMNS
    if name in ("salary_register", "cities", "positions", "firms", "firm_territories", "territories"):
        assert out.count() == 0
    else:
        assert out.count() >= 0


def test_current_date_when_no_as_of(src):
    out = pg.salary_in_force(src, CFG).select("run_date").distinct().collect()
    assert len(out) == 1 and isinstance(out[0][0], dt.date)


def test_text_grade_in_staff_is_refused(spark):
    from world import DATA, SCHEMAS

    src = sources(spark)
    src["actual_staff"] = spark.createDataFrame(
        [tuple(str(v) if i == 1 and v is not None else v for i, v in enumerate(r)) for r in DATA["actual_staff"]],
        SCHEMAS["actual_staff"].replace("pay_level int", "pay_level string"),
    )
    with pytest.raises(TypeError):
        pg.build_pay_grid(src, CFG, as_of=AS_OF)


@pytest.mark.parametrize("strategy", ["auto", "window"])
def test_collation_groups_case_variants(spark, strategy):
    import dataclasses

    from world import DATA, SCHEMAS, money, ts

    data = {k: list(v) for k, v in DATA.items()}
    data["positions"].append(("P9", "CASHIER", "L1", "дом"))  # case variants
    data["approval_lines"].append(("D4", "P9", money(1)))  # February only
    data["salary_register"].append(("C1", "P9", 1, money(999), ts("2024-01-01 00:00:00")))
    src = {n: spark.createDataFrame(data[n], SCHEMAS[n]) for n in SCHEMAS}

    binary = bag(pg.position_base(src, CFG, strategy))
    assert binary[("Moscow-1", "Moscow", "CASHIER")] == 1  # its own group, own latest date
    ci_cfg = dataclasses.replace(CFG, collation="UTF8_LCASE")
    ci = pg.position_base(src, ci_cfg, strategy)
    assert dict(ci.dtypes)["position"] == "string"
    got = bag(ci)
    # one group (K1, cashier): a single row, spelled by one of its members
    # (which one is arbitrary, as in the source database)
    assert got[("Moscow-1", "Moscow", "CASHIER")] + got[("Moscow-1", "Moscow", "Cashier")] == 1
    assert sum(got.values()) == sum(binary.values()) - 1
    # the lower-case excluded prefix is excluded only under the collation
    assert any(r.salary == money(999) for r in pg.salary_in_force(src, CFG, as_of=AS_OF).collect())
    assert not any(r.salary == money(999) for r in pg.salary_in_force(src, ci_cfg, as_of=AS_OF).collect())


def test_missing_relation_or_column_is_reported_up_front(spark):
    src = sources(spark)
    src.pop("territories")
    src["approvals"] = src["approvals"].drop("doc_ts")
    with pytest.raises(KeyError) as err:
        pg.build_pay_grid(src, CFG, as_of=AS_OF)
    assert "territories" in str(err.value) and "doc_ts" in str(err.value)
