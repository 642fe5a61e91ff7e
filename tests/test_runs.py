"""Whole runs, in batch and as a stream."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import day, number

from ratepanel.plans import incremental
from ratepanel.plans.incremental import incremental_run, update_store
from ratepanel.plans.series import daily_series, wide_series
from ratepanel.schemas import DATE, FX, HOURS, LIBOR, PAGES, SML, TCE
from ratepanel.sources import panel as PN
from ratepanel.sources import store
from ratepanel.sources.config import Dims
from ratepanel.sources.store import StoreConflict, manifest
from ratepanel.streaming import pages as ST

RATES = Dims(LIBOR, rates={"30": "libor_30_dias", "60": "libor_60_dias"})
START, END = day("2024-01-01"), day("2024-01-06")


def rate_html(thirty, sixty="1,0"):
    return f"<table><tbody><tr><td>30</td><td>{thirty}</td></tr><tr><td>60</td><td>{sixty}</td></tr></tbody></table>"


def pages(spark, *lines):
    return spark.createDataFrame([("libor", None, day(d), html) for d, html in lines], PAGES)


def stored(spark, *lines):
    return spark.createDataFrame([(day(d), t, number(v)) for d, t, v in lines], LIBOR.panel_schema)


def thirty(panel):
    return {r[0].day: r[1] and str(r[1].normalize()) for r in panel.where("type = '30'").select(DATE, "value").collect()}


PAGES_IN = [(f"2024-01-0{d}", rate_html(f"{d},0")) for d in (1, 2, 3, 5)] + [("2024-01-04", ""), ("2024-02-01", rate_html("9,0"))]
STORED = [("2023-12-31", "30", "7"), ("2024-01-01", "30", "7"), ("2024-01-01", "60", None), ("2024-01-02", "30", None)]


def test_run(spark):
    run = incremental_run(pages(spark, *PAGES_IN), stored(spark, *STORED), RATES, START, END)
    # The 1st is stored, the 2nd was trimmed, the 4th is an empty page, the 6th has none.
    assert thirty(run.published) == {1: "7", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: None}
    assert thirty(run.panel) == {31: "7", **thirty(run.published)}
    assert run.published.count() == 12
    wide = daily_series(run.published, RATES, START, END)
    assert wide.columns == ["indice_tiempo", "libor_30_dias", "libor_60_dias"]
    assert wide.count() == 6


def test_switches(spark):
    inputs = (pages(spark, *PAGES_IN), stored(spark, *STORED), RATES, START, END)
    assert thirty(incremental_run(*inputs, skip_trim=True).published)[2] is None
    fresh = incremental_run(*inputs, skip_panel=True)
    assert thirty(fresh.panel) == {1: "0.01", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: None}
    without = incremental_run(pages(spark, *PAGES_IN), None, RATES, START, END)
    assert thirty(without.panel) == thirty(fresh.panel)


def test_refetch_replaces_stored_dates(spark):
    held = stored(spark, ("2024-01-01", "30", "7"), ("2024-01-02", "30", "8"), ("2024-01-03", "30", "9"), ("2024-01-06", "30", "9"))
    inputs = (pages(spark, *PAGES_IN), held, RATES, START, END)
    got = thirty(incremental_run(*inputs, refetch=(day("2024-01-02"), day("2024-01-06"))).panel)
    # The 6th has no page to fetch again; the 4th and 5th were misses anyway.
    assert got == {1: "7", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: "9"}
    again = thirty(incremental_run(*inputs).panel)
    assert again == {1: "7", 2: "8", 3: "9", 4: None, 5: "0.05", 6: "9"}


def test_reversed_range_loads_nothing(spark):
    run = incremental_run(pages(spark, *PAGES_IN), stored(spark, *STORED), RATES, END, START)
    assert run.published.count() == 0
    assert run.panel.count() == len(STORED)


def test_stored_runs_build_on_each_other(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    first = update_store(pages(spark, *PAGES_IN[:2]), root, RATES, START, day("2024-01-03"))
    assert thirty(first) == {1: "0.01", 2: "0.02", 3: None}
    later = update_store(pages(spark, *PAGES_IN), root, RATES, START, END)
    assert thirty(later) == {1: "0.01", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: None}
    repeated = update_store(pages(spark, *PAGES_IN), root, RATES, START, END)
    assert rows(repeated) == rows(later)
    # The second run and the third had days without data at the end to load again.
    assert manifest(spark, root).version == 3


def months_of(root):
    return sorted(p.name for p in (root / "data").glob("*/month=*"))


def test_only_the_months_of_loaded_days_are_written(spark, tmp_path):
    root = tmp_path / "store"
    held = [(f"{y}-{m:02d}-15", "30", "7") for y in (2022, 2023) for m in range(1, 13)] + STORED
    first = PN.write_snapshot(stored(spark, *held), str(root), LIBOR)
    assert len(months_of(root)) == len(first.parts) == 25
    update_store(pages(spark, *PAGES_IN), str(root), RATES, START, END)
    assert len(months_of(root)) == 26
    later = manifest(spark, str(root))
    assert {m for m, w in later.parts.items() if first.parts.get(m) != w} == {"2024-01"}
    panel = PN.read_snapshot(spark, str(root), LIBOR, day("2023-12-20"), END)
    assert thirty(panel) == {31: "7", 1: "7", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: None}
    assert {f.split("month=")[1][:7] for f in panel.inputFiles()} == {"2023-12", "2024-01"}
    assert PN.read_snapshot(spark, str(root), LIBOR).count() == 24 + 2 + 12 - 1


def test_a_run_without_days_to_load_writes_nothing(spark, rows, tmp_path):
    root = tmp_path / "store"
    update_store(pages(spark, *PAGES_IN), str(root), RATES, START, day("2024-01-03"))
    before = months_of(root)
    again = update_store(pages(spark, *PAGES_IN), str(root), RATES, START, day("2024-01-03"))
    assert months_of(root) == before
    assert manifest(spark, str(root)).version == 1
    assert again.count() == 6


def test_runs_side_by_side_lose_nothing(spark, tmp_path, monkeypatch):
    """Another run commits between this one's reading and writing: first another month, then the same one."""
    root = str(tmp_path / "store")
    lines = [*PAGES_IN, ("2024-02-02", rate_html("8,0"))]
    feb = (day("2024-02-01"), day("2024-02-02"))
    others = [lambda: update_store(pages(spark, *lines), root, RATES, *feb), lambda: update_store(pages(spark, *lines), root, RATES, START, START)]
    write = incremental.write_parts

    def late(panel, *args):
        written = write(panel, *args)
        if others:
            other = others.pop(0)
            other()
        return written

    monkeypatch.setattr(incremental, "write_parts", late)
    got = update_store(pages(spark, *lines), root, RATES, START, END)
    assert not others
    assert thirty(got) == {1: "0.01", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: None}
    both = PN.read_snapshot(spark, root, LIBOR)
    assert thirty(both.where("month(indice_tiempo) = 2")) == {1: "0.09", 2: "0.08"}
    assert both.count() == 16


def test_conflicts_over_the_same_month(spark, tmp_path):
    root = str(tmp_path / "store")
    base = PN.write_snapshot(stored(spark, *STORED), root, LIBOR)
    january = stored(spark, ("2024-01-09", "30", "1"))
    assert PN.write_snapshot(january, root, LIBOR, ["2024-01"], base).version == 2
    # Another month than the one changed since: carried over. The same month, or all: a conflict.
    march = PN.write_snapshot(stored(spark, ("2024-03-09", "30", "1")), root, LIBOR, ["2024-03"], base)
    assert sorted(march.parts) == ["2023-12", "2024-01", "2024-03"] and march.version == 3
    for months in (["2024-01"], None):
        with pytest.raises(StoreConflict):
            PN.write_snapshot(january, root, LIBOR, months, base)
    assert manifest(spark, root) == march
    assert not [n for n in (tmp_path / "store" / "log").iterdir() if not n.name.lstrip(".")[0].isdigit()]
    assert store.put_if_absent(spark, f"{root}/log/{3:010d}.json", "{}") is False


def test_old_versions_are_dropped(spark, rows, tmp_path):
    root = tmp_path / "store"
    PN.write_snapshot(stored(spark, *STORED), str(root), LIBOR)
    for value in "345":
        PN.write_snapshot(stored(spark, ("2024-01-09", "30", value)), str(root), LIBOR, ["2024-01"])
    before = rows(PN.read_snapshot(spark, str(root), LIBOR))
    assert store.drop_old(spark, str(root)) == []
    gone = store.drop_old(spark, str(root), keep=2, hours=0)
    assert len([g for g in gone if "/data/" in g]) == 1
    assert rows(PN.read_snapshot(spark, str(root), LIBOR)) == before
    # The first write still holds December.
    assert len(list((root / "data").iterdir())) == 3
    assert PN.write_snapshot(stored(spark, ("2024-01-09", "30", "9")), str(root), LIBOR, ["2024-01"]).version == 5


def test_one_scan_tells_all_days(spark):
    states = {day("2024-01-01"): True, day("2024-01-02"): False, day("2024-01-04"): True, day("2024-01-05"): False, day("2024-01-06"): False}
    d = lambda *days: tuple(day(f"2024-01-{n:02d}") for n in days)
    end = day("2024-01-07")
    assert incremental.plan_days(states, START, end) == incremental.Days(d(3, 5, 6, 7), (), d(5, 6))
    assert incremental.plan_days(states, START, end, skip_trim=True) == incremental.Days(d(3, 7), (), ())
    refetch = (day("2024-01-04"), day("2024-01-06"))
    assert incremental.plan_days(states, START, end, refetch) == incremental.Days(d(3, 5, 6, 7), d(4), d(5, 6))
    assert incremental.plan_days(states, START, end, refetch, skip_trim=True).again == d(4, 5, 6)
    assert incremental.plan_days({}, START, START).misses == d(1)
    assert incremental.plan_days(states, end, START) == incremental.Days((), (), ())


def test_a_start_that_is_not_offered_moves_by_a_day(spark, tmp_path):
    dims = Dims(FX, coins={"euro": "Euro", "yen": "Yen"})
    lines = [fx_page(day(f"2024-01-0{n}"), f"{n},0", coin=c) for n in (1, 2, 5) for c in ("euro", "yen")]
    df = spark.createDataFrame(lines, PAGES)

    def form(*days, coins="<option>Euro</option>"):
        listed = "".join(f"<option>{d}</option>" for d in days)
        html = f"<form><select name='Moneda'>{coins}</select><select id=f name=\"Fecha\">{listed}</select>03/01/2024</form>"
        return spark.createDataFrame([(html,)], "html string")

    def run(name, listed, start=START, end=day("2024-01-05")):
        panel = update_store(df, str(tmp_path / name), dims, start, end, form=listed)
        return {(r.coin, r.indice_tiempo.day): r.value and int(r.value) for r in panel.where("type = 'tp_usd'").collect()}

    offered = ("01/01/2024", "02/01/2024", "05/01/2024")
    assert run("all", form(*offered)) == {("euro", 1): 1, ("euro", 2): 2, ("euro", 3): None, ("euro", 4): None, ("euro", 5): 5} | {("yen", n): None for n in range(1, 6)}
    # In a gap the start moves by one day only, offered or not.
    assert min(d for _, d in run("gap", form("01/01/2024", "05/01/2024"), day("2024-01-02"))) == 3
    with pytest.raises(ValueError, match="offered"):
        run("end", form("01/01/2024"), day("2024-01-05"))
    assert {k[0] for k, v in run("both", form(*offered, coins="<option>Yen</option><option>Euro</option>")).items() if v} == {"euro", "yen"}


def test_other_years_are_not_read(spark, tmp_path):
    root = str(tmp_path / "store")
    PN.write_snapshot(stored(spark, *STORED), root, LIBOR)
    assert len(PN.read_snapshot(spark, root, LIBOR, START, END).inputFiles()) == 1


def test_skipped_panel_is_neither_read_nor_written(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    PN.write_snapshot(stored(spark, *STORED), root, LIBOR)
    got = update_store(pages(spark, *PAGES_IN), root, RATES, START, END, skip_panel=True)
    assert thirty(got) == {1: "0.01", 2: "0.02", 3: "0.03", 4: None, 5: "0.05", 6: None}
    assert manifest(spark, root).version == 1
    assert rows(PN.read_snapshot(spark, root, LIBOR)) == rows(stored(spark, *STORED))


def test_stored_runs_check_their_ranges(spark, tmp_path):
    inputs = (pages(spark, *PAGES_IN), str(tmp_path / "store"), RATES)
    for start, end, refetch in ((END, START, None), (START, day("2024-01-08"), None), (START, END, (START, day("2024-01-07")))):
        with pytest.raises(ValueError, match="range|date"):
            update_store(*inputs, start, end, refetch, today=day("2024-01-07"))
    assert not (tmp_path / "store").exists()


def test_blank_cells_are_those_of_each_coin(spark):
    dims = Dims(SML, coins={"a": "A", "b": "B", "c": "C"}, types=(("a", "L", "x"), ("b", "L", "y"), ("b", "M", "z")))
    run = incremental_run(spark.createDataFrame([], PAGES), None, dims, START, START)
    assert sorted((r.coin, r.type, r[SML.value]) for r in run.panel.collect()) == [("a", "x", None), ("b", "y", None), ("b", "z", None)]


def test_coins_of_a_hit_date_stay_null(spark):
    """A date counts as stored when any coin has it; the other coin's series still lists the date."""
    dims = Dims(SML, coins={"a": "A", "b": "B"}, types=(("a", "L", "x"), ("b", "L", "x")))
    held = spark.createDataFrame([(START, "a", "x", number("1"))], SML.panel_schema)
    run = incremental_run(spark.createDataFrame([], PAGES), held, dims, START, START)
    assert run.panel.count() == 1
    assert [tuple(r) for r in daily_series(run.published, dims, START, START, "b").collect()] == [(START, None)]


def test_inactive_quotes_are_stored_but_not_published(spark):
    quotes = tuple(("dolar", "x", h, c, c == "mostrador") for h in HOURS for c in ("mostrador", "electronico"))
    dims = Dims(TCE, coins={"dolar": "DOLAR"}, entities=(("x", "BANCO X S.A.", "X"),), quotes=quotes)
    cells = "".join(f"<td>{i},5</td>" for i in range(1, 13))
    html = f"<table><tbody><tr><td>BANCO X S.A.</td>{cells}</tr></tbody></table>"
    df = spark.createDataFrame([("tce", "dolar", START, html)], PAGES)
    run = incremental_run(df, None, dims, START, START)
    assert run.panel.where("valor IS NOT NULL").count() == 12
    wide = wide_series(run.published, dims, "dolar")
    assert len(wide.columns) == 7
    assert wide.first()["tc_ars_dolar_x_mostrador_venta_15hs"] == Decimal("10.5")


FX_DIMS = Dims(FX, coins={"euro": "Euro"})


def fx_page(date, usd, source="exchange-rates", coin="euro"):
    rows = f"<tr><td>{date:%d/%m/%Y}</td><td>{usd}</td><td>2,0</td></tr>"
    return (source, coin, date, f"<table><thead></thead><tbody>{rows}</tbody></table>")


def test_stream(spark, tmp_path):
    inbox, store, state = (str(tmp_path / n) for n in ("inbox", "store", "state"))

    def arrive(name, age, *lines):
        target = tmp_path / "inbox" / name
        spark.createDataFrame(list(lines), PAGES).coalesce(1).write.parquet(str(tmp_path / name))
        (tmp_path / "inbox").mkdir(exist_ok=True)
        part = next((tmp_path / name).glob("part-*.parquet"))
        os.utime(part, (1_700_000_000 - age, 1_700_000_000 - age))
        part.rename(target.with_suffix(".parquet"))

    def run():
        ST.store_pages(ST.page_stream(spark, inbox), store, FX_DIMS, state, available_now=True).awaitTermination()
        panel = ST.read_store(spark, store, FX_DIMS).where("type = 'tp_usd'")
        return {r.indice_tiempo.day: r.value for r in panel.collect()}

    one, two = day("2024-01-01"), day("2024-01-02")
    # Two pages of one date in a batch: the newer file wins. Other sources and coins are left out.
    arrive("old", 50, fx_page(one, "1,0"))
    arrive("new", 10, fx_page(one, "3,0"), fx_page(two, "4,0"), fx_page(two, "9,0", source="sml"), fx_page(two, "9,0", coin="yen"))
    assert run() == {1: Decimal(3), 2: Decimal(4)}
    # A later batch replaces whole dates, also by a page without values.
    arrive("later", 5, fx_page(two, "--------"))
    assert run() == {1: Decimal(3), 2: None}
    assert run() == {1: Decimal(3), 2: None}
    assert isinstance(one, dt.date)


def test_many_batches_are_merged_by_month(spark, tmp_path):
    store_path = str(tmp_path / "store")
    extra = "loaded_at timestamp, loaded_from string"

    def batch(n, *lines):
        df = spark.createDataFrame([(*line, dt.datetime(2024, 1, 1), "f") for line in lines], f"source string, coin string, {DATE} date, html string, {extra}")
        ST.store_batch(df, n, store_path, FX_DIMS, gather=20)

    want = {}
    for n in range(50):
        days = [day("2024-01-01") + dt.timedelta(days=n), day("2024-06-30")]
        batch(n, *[fx_page(d, f"{n + 1},0") for d in days])
        want.update({d: Decimal(n + 1) for d in days})
    panel = ST.read_store(spark, store_path, FX_DIMS)
    assert {r.indice_tiempo: r.value for r in panel.where("type = 'tp_usd'").collect()} == want
    held = manifest(spark, store_path)
    assert (held.version, held.merged) == (2, 39)
    # Folders of the first merge are gone; those of the second stay for readers of the version before.
    assert len(list((tmp_path / "store" / "batches").iterdir())) == 30
    january = ST.read_store(spark, store_path, FX_DIMS, day("2024-01-10"), day("2024-01-12"))
    assert {r.indice_tiempo.day: int(r.value) for r in january.where("type = 'tp_usd'").collect()} == {10: 10, 11: 11, 12: 12}
    assert {f.split("month=")[1][:7] for f in january.inputFiles()} == {"2024-01"}
    assert len(january.inputFiles()) == 1
    # A batch that was merged and is run again changes nothing.
    batch(39, fx_page(day("2024-06-30"), "40,0"))
    ST.compact_store(spark, store_path, FX_DIMS)
    last = ST.read_store(spark, store_path, FX_DIMS, day("2024-06-30"), day("2024-06-30"))
    assert [int(r.value) for r in last.where("type = 'tp_usd'").collect()] == [50]
    assert len(last.inputFiles()) == 1
