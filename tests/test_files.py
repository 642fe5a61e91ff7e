import json
from decimal import Decimal

import pytest
from conftest import day, number

from ratepanel.schemas import FX, LIBOR, PAGES
from ratepanel.sources import pages as PG
from ratepanel.sources import panel as PN
from ratepanel.sources import parsed_json as PJ
from ratepanel.sources import series as SR
from ratepanel.sources import shared
from ratepanel.sources.store import manifest


def rates(spark, *lines):
    return spark.createDataFrame([(day(d), t, number(v)) for d, t, v in lines], LIBOR.panel_schema)


def test_panel_csv(spark, rows, tmp_path):
    path = tmp_path / "panel.csv"
    path.write_text("indice_tiempo,type,value\n2019-04-11,30,0.0247263\n2019-04-11,60,\n")
    panel = PN.read_panel(spark, str(path), LIBOR)
    assert panel.schema == LIBOR.panel_schema
    expected = [(day("2019-04-11"), "30", Decimal("0.0247263000")), (day("2019-04-11"), "60", None)]
    assert rows(panel) == expected
    PN.write_panel(panel, str(tmp_path / "out"), LIBOR)
    assert rows(PN.read_panel(spark, str(tmp_path / "out"), LIBOR)) == expected


def test_broken_number_in_a_panel_is_an_error(spark, tmp_path):
    path = tmp_path / "panel.csv"
    path.write_text("indice_tiempo,type,value\n2019-04-11,30,abc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        PN.read_panel(spark, str(path), LIBOR).collect()


def test_missing_panel_is_empty(spark, tmp_path):
    panel = PN.read_panel_or_empty(spark, str(tmp_path / "none.csv"), FX)
    assert panel.schema == FX.panel_schema
    assert panel.count() == 0


def test_snapshots(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    assert PN.read_snapshot(spark, root, LIBOR).count() == 0
    first = rates(spark, ("2019-12-31", "30", "1"), ("2020-01-01", "30", None))
    assert PN.write_snapshot(first, root, LIBOR).version == 1
    stored = PN.read_snapshot(spark, root, LIBOR)
    assert rows(stored) == rows(first)
    assert PN.write_snapshot(stored.where("type = '30' AND value IS NOT NULL"), root, LIBOR).version == 2
    assert rows(stored) == rows(first)
    assert rows(PN.read_snapshot(spark, root, LIBOR)) == [(day("2019-12-31"), "30", Decimal(1))]
    # Folders that no manifest names were never finished.
    first.write.parquet(f"{root}/data/unfinished/month=2019-12")
    assert rows(PN.read_snapshot(spark, root, LIBOR)) == [(day("2019-12-31"), "30", Decimal(1))]
    assert sorted(manifest(spark, root).parts) == ["2019-12"]


def test_snapshots_of_single_months(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    days = ["2018-05-05", "2019-05-05", "2020-05-05"]
    PN.write_snapshot(rates(spark, *[(d, "30", "1") for d in days]), root, LIBOR)
    # 2019 gets another value, 2020 loses its only date.
    PN.write_snapshot(rates(spark, (days[1], "30", "2")), root, LIBOR, ["2019-05", "2020-05"])
    assert rows(PN.read_snapshot(spark, root, LIBOR)) == [(day(days[0]), "30", Decimal(1)), (day(days[1]), "30", Decimal(2))]
    assert sorted(manifest(spark, root).parts) == ["2018-05", "2019-05"]
    first, second = manifest(spark, root, 1).parts, manifest(spark, root, 2).parts
    assert first["2018-05"] == second["2018-05"] != second["2019-05"]
    PN.write_snapshot(rates(spark, (days[2], "30", "5")), root, LIBOR)
    assert rows(PN.read_snapshot(spark, root, LIBOR)) == [(day(days[2]), "30", Decimal(5))]


def test_series_csv(spark, rows, tmp_path):
    wide = spark.sql("SELECT DATE '2019-01-02' AS indice_tiempo, 2.5 AS b, 1 AS extra UNION ALL SELECT DATE '2019-01-01', NULL, 1")
    path = str(tmp_path / "series")
    SR.write_series(wide, ["indice_tiempo", "absent", "b"], path)
    text = "".join(p.read_text() for p in sorted((tmp_path / "series").glob("part-*.csv")))
    body = [line for line in text.splitlines() if not line.startswith("indice_tiempo")]
    assert text.startswith("indice_tiempo,absent,b")
    assert body == ["2019-01-01,,", "2019-01-02,,2.5"]
    typed = SR.read_series(spark, path, ["indice_tiempo", "absent", "b"])
    assert rows(typed) == [(day("2019-01-01"), None, None), (day("2019-01-02"), None, Decimal("2.5"))]
    assert SR.read_series(spark, path).columns == ["indice_tiempo", "absent", "b"]


def test_parsed_json(spark, rows, tmp_path):
    path = tmp_path / "parsed.json"
    records = [{"indice_tiempo": "2019-01-01", "tc_ars_dolar_x_mostrador_compra_11hs": "1.5"}, {"indice_tiempo": "2019-01-02"}]
    path.write_text(json.dumps({"parsed": records}, indent=1))
    got = PJ.read_parsed_json(spark, str(path))
    assert rows(got) == [("2019-01-01", "1.5"), ("2019-01-02", None)]


def test_page_files_and_tables(spark, rows, tmp_path):
    file = tmp_path / "html" / "sml" / "peso_uruguayo" / "2019-04-24.html"
    file.parent.mkdir(parents=True)
    file.write_text("<p>a\nb</p>", encoding="utf8")
    got = PG.load_page_files(spark, str(tmp_path / "html"))
    expected = [("sml", "peso_uruguayo", day("2019-04-24"), "<p>a\nb</p>")]
    assert rows(got) == expected
    spark.createDataFrame(expected, PAGES).write.parquet(str(tmp_path / "table"))
    assert rows(PG.load_pages(spark, str(tmp_path / "table"))) == expected


def test_shared_folder_is_the_sessions(spark):
    folder = shared.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder == named.rstrip("/")
    assert shared.fresh_path(spark, "a") != shared.fresh_path(spark, "a")


def test_columns_are_read_by_name(spark, tmp_path, rows):
    (tmp_path / "panel.csv").write_text("value,type,coin,indice_tiempo\n1.5,tc_local,real,2020-01-02\n,tp_usd,real,2020-01-02\n")
    panel = PN.read_panel(spark, str(tmp_path / "panel.csv"), FX)
    assert rows(panel, "coin", "type", "value") == [("real", "tc_local", number("1.5000000000")), ("real", "tp_usd", None)]
    (tmp_path / "series.csv").write_text("b,a,indice_tiempo\n2,1,2020-01-02\n")
    series = SR.read_series(spark, str(tmp_path / "series.csv"), ["indice_tiempo", "a", "b"])
    assert rows(series, "a", "b") == [(number("1.0000000000"), number("2.0000000000"))]


def test_rows_without_date_stay_in_the_store(spark, tmp_path):
    root = str(tmp_path / "store")
    panel = spark.createDataFrame([(None, "real", "tc_local", number("1")), (day("2020-01-02"), "real", "tc_local", number("2"))], FX.panel_schema)
    PN.write_snapshot(panel, root, FX)
    later = panel.where("indice_tiempo is not null")
    PN.write_snapshot(later, root, FX, ["2020-01"])
    assert PN.read_snapshot(spark, root, FX).count() == 2
