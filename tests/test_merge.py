import datetime as dt
import random

import pytest
from conftest import day, number
from pyspark.sql import functions as F

from ratepanel.operators import calendar as C
from ratepanel.operators import merge as M
from ratepanel.schemas import DATE, FX

START = dt.date(2024, 1, 1)


def walk_back(stored, start, end, refetch_end):
    """The rule as told: from the end, delete stored days without data up to the first with data."""
    kept, at = dict(stored), end
    while at >= start:
        if at in kept:
            if kept[at]:
                break
            del kept[at]
            if refetch_end == at:
                refetch_end -= dt.timedelta(days=1)
        at -= dt.timedelta(days=1)
    return kept, refetch_end


def test_trimming_follows_the_walk_back(spark):
    random.seed(7)
    for _ in range(12):
        stored = {START + dt.timedelta(days=i): random.random() < 0.3 for i in range(20) if random.random() < 0.7}
        start = START + dt.timedelta(days=random.randrange(10))
        end = start + dt.timedelta(days=random.randrange(15))
        refetch_end = start + dt.timedelta(days=random.randrange((end - start).days + 1))
        lines = [(d, c, "tc_local", number("1.5") if has and c == "a" else None) for d, has in stored.items() for c in "ab"]
        panel = spark.createDataFrame(lines, FX.panel_schema)
        kept, expected_end = walk_back(stored, start, end, refetch_end)
        trimmed = M.trim_trailing_empty(panel, start, end, "value")
        assert {r[0] for r in trimmed.select(DATE).collect()} == set(kept)
        trailing = M.trailing_dates(panel, start, end, "value")
        assert {r[0] for r in trailing.collect()} == set(stored) - set(kept)
        assert M.shrink_refetch_end(trailing, start, refetch_end).first().refetch_end == expected_end
        assert M.trim_trailing_empty(trimmed, start, end, "value").count() == trimmed.count()


def panel(spark, *lines):
    data = [(day(d), c, t, number(v)) for d, c, t, v in lines]
    return spark.createDataFrame(data, FX.panel_schema)


def test_upsert_replaces_whole_dates_of_a_coin_and_can_be_repeated(spark, rows):
    base = panel(spark, ("2024-01-01", "a", "x", "1"), ("2024-01-01", "a", "y", "2"), ("2024-01-01", "b", "x", "3"))
    new = panel(spark, ("2024-01-01", "a", "x", "9"), ("2024-01-02", "b", "x", None))
    once = M.upsert_by_date(base, new, FX.page_key)
    expected = panel(spark, ("2024-01-01", "a", "x", "9"), ("2024-01-01", "b", "x", "3"), ("2024-01-02", "b", "x", None))
    assert rows(once) == rows(expected)
    assert rows(M.upsert_by_date(once, new, FX.page_key)) == rows(expected)


def test_dates_to_load(spark, rows):
    stored = panel(spark, ("2024-01-02", "a", "x", None), ("2024-02-01", "a", "x", "1"))
    loaded = panel(spark, ("2024-01-03", "b", "x", None))
    span = (day("2024-01-01"), day("2024-01-04"))
    assert rows(M.panel_hits(stored, *span)) == [(day("2024-01-02"),)]
    assert rows(M.dates_to_load(stored, *span, loaded)) == [(day("2024-01-01"),), (day("2024-01-04"),)]
    assert rows(M.dates_to_load(stored, span[1], span[0])) == []


def test_data_means_neither_null_nor_zero(spark, rows):
    df = panel(spark, ("2024-01-01", "a", "x", None), ("2024-01-01", "b", "x", "0"), ("2024-01-02", "a", "x", "-1"))
    assert rows(M.date_has_data(df, "value")) == [(day("2024-01-01"), False), (day("2024-01-02"), True)]


def test_latest_cell_may_be_null(spark, rows):
    df = spark.createDataFrame([(1, 1, number("5")), (1, 2, None), (2, 1, number("7"))], "k int, o int, value decimal(24,10)")
    assert rows(M.latest_cells(df, ["k"], ["o"], "value")) == [(1, None), (2, number("7"))]


def test_calendar_and_grid(spark, rows):
    assert C.calendar(spark, day("2024-02-28"), day("2024-03-01")).count() == 3
    assert C.calendar(spark, day("2024-03-01"), day("2024-02-28")).count() == 0
    members = spark.createDataFrame([("a",), ("b",)], "coin string")
    assert C.grid(members, day("2024-01-01"), day("2024-01-03")).count() == 6
    assert C.grid(members, day("2024-01-03"), day("2024-01-01")).count() == 0
    assert C.calendar_of(panel(spark, ("2024-01-01", "a", "x", None), ("2024-01-04", "a", "x", None))).count() == 4
    assert C.calendar_of(panel(spark)).count() == 0
    dense = C.densify(panel(spark, ("2024-01-02", "a", "x", "1")), C.calendar(spark, day("2024-01-01"), day("2024-01-02")))
    assert rows(dense, DATE, "coin") == [(day("2024-01-01"), None), (day("2024-01-02"), "a")]


def test_rules_on_ranges(spark, rows):
    today = day("2024-01-31")
    C.check_range(day("2024-01-01"), today, today, (day("2024-01-01"), today))
    for start, end, refetch in [
        ("2024-01-02", "2024-01-01", None),
        ("2024-01-02", "2024-02-01", None),
        ("2024-01-02", "2024-01-05", ("2024-01-01", "2024-01-03")),
        ("2024-01-02", "2024-01-05", ("2024-01-03", "2024-01-06")),
    ]:
        with pytest.raises(ValueError):
            C.check_range(day(start), day(end), today, refetch and tuple(map(day, refetch)))
    requests = spark.createDataFrame(
        [("2024-01-02", "2024-01-01"), ("2024-01-01", "2024-02-01"), ("2024-01-01", "2024-01-02")], "s string, e string"
    ).select(F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"))
    assert sorted(r.error for r in C.range_violations(requests, today).collect()) == ["end_after_today", "start_after_end"]


def test_snap_start(spark, rows):
    requests = spark.createDataFrame(
        [(1, day("2024-01-01"), day("2024-01-05")), (2, day("2024-01-02"), day("2024-01-05")), (3, day("2024-01-02"), day("2024-01-02"))],
        "id int, start_date date, end_date date",
    )
    offered = spark.createDataFrame([(day("2024-01-01"),), (day("2024-01-01"),)], f"{DATE} date")
    got = rows(C.snap_start(requests, offered), "id", "snapped_start", "error")
    assert got == [(1, day("2024-01-01"), None), (2, day("2024-01-03"), None), (3, None, "start_not_before_end")]
