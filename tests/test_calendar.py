import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.calendar import allocate, fiscal_period, fiscal_window, fiscal_year, period_rollup, split_by_month
from tidemark.operators.clean import active_only

D = dt.date
SEGMENT = "id int, s date, e date, unit string, a decimal(18,2), b double"


def largest_remainder(cents, weights):
    if cents is None:
        return [None] * len(weights)
    total, sign, cents = sum(weights), (cents > 0) - (cents < 0), abs(cents)
    out = [cents * w // total for w in weights]
    order = sorted(range(len(weights)), key=lambda i: (-(cents * weights[i] % total), i))
    for i in order[:cents - sum(out)]:
        out[i] += 1
    return [sign * x for x in out]


def test_allocation(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 0, 1, -1, 7, -100, rnd.randrange(-10 ** 9, 10 ** 9), 10 ** 17]), [rnd.randrange(1, 32) for _ in range(rnd.randrange(0, 30))]) for _ in range(300)]
    rows += [(5, [1, 1, 1]), (-5, [1, 1, 1]), (10 ** 17 + 1, [31] * 1200)]
    df = spark.createDataFrame(rows, "c long, w array<long>").withColumn("c", F.col("c").cast("decimal(20,0)"))
    got = [[None if x is None else int(x) for x in r.got] for r in df.select(allocate(F.col("c"), F.col("w")).alias("got")).collect()]
    assert got == [largest_remainder(c, w) for c, w in rows]
    assert all(c is None or not w or sum(g) == c for (c, w), g in zip(rows, got))


def _segments(rnd, n):
    rows = []
    for i in range(n):
        s = D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(800))
        e = s + dt.timedelta(days=rnd.choice([0, 1, rnd.randrange(500)]))
        rows.append((i, s, e, rnd.choice(["u", "v", None]), rnd.choice([None, Decimal(rnd.randrange(-10 ** 6, 10 ** 6)) / 100]), rnd.choice([None, rnd.randrange(10 ** 5) / 100])))
    return rows + [(n, None, D(2020, 1, 1), "u", Decimal("1.00"), 1.0), (n + 1, D(2020, 1, 2), D(2020, 1, 1), "u", Decimal("2.00"), 2.0), (n + 1, D(2020, 1, 2), D(2020, 1, 1), "u", Decimal("2.00"), 2.0)]


def test_parts_are_months_and_add_up(spark):
    rows = _segments(random.Random(3), 200)
    parts = split_by_month(spark.createDataFrame(rows, SEGMENT), "s", "e", ["a", "b"])
    got = {}
    for r in parts.collect():
        got.setdefault((r.id, r.s, r.e), []).append(r)
    for i, s, e, unit, a, b in rows[:200]:
        own = sorted(got[i, s, e], key=lambda r: r.part_start)
        assert own[0].part_start == s and own[-1].part_end == e and all(r.unit == unit for r in own)
        assert all((x.part_end + dt.timedelta(days=1)) == y.part_start and y.part_start.day == 1 for x, y in zip(own, own[1:]))
        assert [r.part_days for r in own] == [(r.part_end - r.part_start).days + 1 for r in own] and sum(r.part_days for r in own) == (e - s).days + 1
        for name, amount in (("a", a), ("b", None if b is None else Decimal(str(b)))):
            want = largest_remainder(None if amount is None else int(amount * 100), [r.part_days for r in own])
            assert [None if r[name] is None else int(r[name] * 100) for r in own] == want
    assert [(r.part_days, r.a) for r in got[200, None, D(2020, 1, 1)]] == [(0, Decimal("1.00"))]
    assert len(got[201, D(2020, 1, 2), D(2020, 1, 1)]) == 2
    assert split_by_month(spark.createDataFrame([], SEGMENT), "s", "e", ["a"]).collect() == []


def test_roll_up_keeps_every_cent_and_day(spark):
    rows = _segments(random.Random(4), 300)
    df = spark.createDataFrame(rows, SEGMENT)
    for month in (1, 7):
        got = period_rollup(df, "s", "e", "unit", "a", month).collect()
        assert sum(r.total_cost or 0 for r in got) == sum(r[4] or 0 for r in rows)
        assert sum(r.days for r in got) == sum((r[2] - r[1]).days + 1 for r in rows[:300])
        one = {(r.fiscal_year, r.period, r.org_unit): r for r in got}
        assert len(one) == len(got) and all(1 <= p <= 12 for _, p, _ in one if p is not None)


def test_fiscal_years(spark):
    days = [D(1996, 6, 30), D(1996, 7, 1), D(1997, 6, 30), D(1997, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [tuple(r) for r in df.select(fiscal_year("d", 7), fiscal_period("d", 7), fiscal_year("d"), fiscal_period("d")).collect()]
    assert got == [(1995, 12, 1996, 6), (1996, 1, 1996, 7), (1996, 12, 1997, 6), (1996, 7, 1997, 1), (None, None, None, None)]
    assert fiscal_window(1996, 7) == (D(1996, 7, 1), D(1997, 6, 30)) and fiscal_window(2020) == (D(2020, 1, 1), D(2020, 12, 31))
    with pytest.raises(ValueError):
        fiscal_window(2020, 13)


def test_active_rows(spark):
    rows = [(1, "Active", None), (2, " Active ", ""), (3, "Active", "X"), (4, "Left", None), (5, None, None), (6, "active", " ")]
    df = spark.createDataFrame(rows, "id int, status_flag string, del string")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(active_only(df, "status_flag", ["Active"], "del")) == [1, 2]
    assert ids(active_only(df, "status_flag", ["Active"])) == [1, 2, 3]
    assert ids(active_only(df, deleted="del")) == [1, 2, 4, 5, 6]
    for bad in ({}, {"status": "status_flag"}):
        with pytest.raises(ValueError):
            active_only(df, **bad)
