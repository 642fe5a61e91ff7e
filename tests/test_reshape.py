from decimal import Decimal

import pytest
from conftest import day, number
from pyspark.sql import functions as F

from ratepanel.operators import quality as Q
from ratepanel.operators import reshape as R
from ratepanel.schemas import FX, LIBOR, SML, TCE, VALUE
from ratepanel.sources import parsed_json as PJ

RATES = {"30": "0.0247263", "60": "0.0253675", "90": "0.0259675", "180": "0.0263125", "360": "0.0273413"}
TERMS = {t: f"libor_{t}_dias" for t in RATES}


def panel(spark, family, *lines):
    data = [(day(line[0]), *line[1:-1], number(line[-1])) for line in lines]
    return spark.createDataFrame(data, family.panel_schema)


def test_rates_both_ways(spark, rows):
    long = panel(spark, LIBOR, *[("2019-04-11", t, v) for t, v in RATES.items()])
    wide = R.panel_to_rates(long, TERMS)
    assert wide.columns == ["indice_tiempo", *TERMS.values()]
    assert wide.schema["libor_30_dias"].dataType == VALUE
    assert rows(wide) == [(day("2019-04-11"), *[Decimal(v).quantize(Decimal("1e-10")) for v in RATES.values()])]
    assert rows(R.rates_to_panel(wide)) == rows(long)


def test_duplicates_add_up_and_zero_is_no_data(spark, rows):
    long = panel(spark, LIBOR, ("2019-01-01", "30", "1"), ("2019-01-01", "30", "2"), ("2019-01-01", "60", "0"), ("2019-01-02", "90", None))
    got = rows(R.panel_to_rates(long, {"30": "a", "60": "b"}))
    assert got == [(day("2019-01-01"), Decimal(3), None), (day("2019-01-02"), None, None)]


def test_many_columns_give_the_same_as_few(spark, rows, monkeypatch):
    lines = [(f"2019-01-{d:02}", f"c{c}", str((d * c) % 7)) for d in range(1, 12) for c in range(30) for _ in range(2)]
    long = panel(spark, LIBOR, *lines, ("2019-02-01", "other", "5"))
    members = {f"c{c}": f"col_{c}" for c in range(30)}
    wide = rows(R.pivot_sum(long, F.col("type"), members, "value"))
    monkeypatch.setattr(R, "CONDITIONAL_COLUMNS", 100)
    assert wide == rows(R.pivot_sum(long, F.col("type"), members, "value"))
    assert len(wide) == 12


def test_both_plans_agree_where_they_meet(spark, rows):
    most = R.CONDITIONAL_COLUMNS
    lines = [(f"2019-01-{d:02}", f"c{c}", str((d * c) % 5)) for d in range(1, 6) for c in range(most + 2)]
    long = panel(spark, LIBOR, *lines)
    few, many = (R.pivot_sum(long, F.col("type"), {f"c{c}": f"c{c}" for c in range(n)}, "value") for n in (most, most + 1))
    assert rows(few) == rows(many.drop(f"c{most}"))


def test_fx_both_ways(spark, rows):
    long = panel(
        spark, FX, ("2019-03-06", "bolivar_venezolano", "tc_local", "0.0123560"), ("2019-03-06", "bolivar_venezolano", "tp_usd", "0.0003030")
    )
    local, usd = (R.panel_to_fx(long, t, ["bolivar_venezolano"]) for t in ("tc_local", "tp_usd"))
    assert rows(local) == [(day("2019-03-06"), Decimal("0.0123560000"))]
    assert rows(R.fx_to_panel(local, usd)) == rows(long)
    assert rows(R.fx_to_panel(local, usd.where("false"))) == []


def test_sml_with_one_coin_only(spark, rows):
    lines = [("2019-05-06", "real", "tipo_cambio_ptax", "3.96210"), ("2019-05-06", "real", "tipo_cambio_real_peso", "0.08825")]
    long = panel(spark, SML, *lines)
    types = ["tipo_cambio_ptax", "tipo_cambio_real_peso"]
    series = {c: R.panel_to_sml(long, c, types) for c in ("peso_uruguayo", "real")}
    assert rows(series["peso_uruguayo"]) == []
    assert rows(R.sml_to_panel(series)) == rows(long)


QUOTES = [
    ("2019-04-22", "dolar", "galicia", "mostrador", "compra", "11hs", "41.800"),
    ("2019-04-22", "dolar", "frances", "electronico", "venta", "13hs", "43.900"),
    ("2019-04-22", "euro", "galicia", "electronico", "compra", "11hs", "0.0"),
]


def test_quotes_have_the_full_product_of_what_occurs(spark, rows):
    long = panel(spark, TCE, *QUOTES)
    wide = R.panel_to_quotes(long, "dolar")
    assert len(wide.columns) == 1 + 2**4
    assert "tc_ars_dolar_frances_mostrador_venta_11hs" in wide.columns
    back = R.quotes_to_panel(wide)
    assert back.count() == 16
    assert rows(back.where("valor is not null")) == rows(long.where("moneda = 'dolar'"))
    euro = R.panel_to_quotes(long, "euro")
    assert rows(euro) == [(day("2019-04-22"), None)]


def test_quote_titles_must_have_seven_parts(spark):
    with pytest.raises(ValueError, match="title parts"):
        R.quotes_to_panel(spark.sql("SELECT DATE '2019-01-01' AS indice_tiempo, 1.0 AS tc_ars_dolar_el_banco_mostrador_compra_11hs"))


def test_means_leave_out_what_has_no_value(spark, rows):
    long = panel(spark, LIBOR, ("2019-01-01", "30", "1"), ("2019-01-01", "30", "4"), ("2019-01-02", "60", None), ("2019-01-03", "30", None), ("2019-01-03", "90", "2"))
    wide = R.panel_to_series_mean(long, F.col("type"), "value")
    assert wide.columns == ["indice_tiempo", "30", "90"]
    assert rows(wide) == [(day("2019-01-01"), Decimal("2.5"), None), (day("2019-01-03"), None, Decimal(2))]


def test_negative_values_are_not_kept_in_a_panel(spark):
    wide = spark.sql("SELECT DATE '2019-01-01' AS indice_tiempo, -1.0 AS libor_30_dias, 0.0 AS libor_60_dias, 2.0 AS libor_90_dias")
    assert {r.type: r.value for r in R.rates_to_panel(wide).collect()} == {"30": None, "60": None, "90": Decimal(2)}


def test_checks_on_series(spark, rows):
    wide = spark.sql("SELECT DATE '2019-01-01' AS indice_tiempo, 1 AS a, CAST(NULL AS INT) AS b UNION ALL SELECT DATE '2019-01-02', NULL, NULL")
    assert rows(Q.null_columns(wide)) == [("b",)]
    assert rows(Q.cell_count(wide)) == [(2, 2, 4)]
    long = panel(spark, TCE, *QUOTES, ("2019-04-23", "dolar", "galicia", "mostrador", "compra", "11hs", None))
    table = Q.coverage(R.by_member(long, "entidad_bancaria", "galicia"), ["entidad_bancaria", "moneda", "hora", "canal"], "valor")
    assert [tuple(r)[1:] for r in table.collect()] == [("dolar", "11hs", "mostrador", 2, 1), ("euro", "11hs", "electronico", 1, 1)]
    renamed = R.rename_panel(long.withColumnsRenamed({v: k for k, v in R.QUOTE_NAMES.items()}), R.QUOTE_NAMES, TCE)
    assert renamed.columns == TCE.columns


def scans_and_shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan parquet"), plan.count("Exchange hashpartitioning")


def test_all_coins_take_one_scan(spark, rows, tmp_path):
    lines = [(f"2019-01-{d:02}", f"c{c}", f"t{t}", str(d + c * t)) for d in range(1, 9) for c in range(12) for t in range(5) if (d + c + t) % 3]
    panel(spark, SML, *lines).write.parquet(str(tmp_path / "panel"))
    stored = spark.read.parquet(str(tmp_path / "panel"))
    types = {f"c{c}": [f"t{t}" for t in range(c % 5 + 1)] for c in range(12)}
    one = R.all_to_panel(R.panel_to_all(stored, SML, types), SML, types)
    apart = R.concat_panels([R.sml_to_panel({c: R.panel_to_sml(stored, c, own)}) for c, own in types.items()])
    assert scans_and_shuffles(one) == (1, 1)
    assert rows(one) == rows(apart)
    two = {c: types[c] for c in ("c1", "c2")}
    assert scans_and_shuffles(R.all_to_panel(R.panel_to_all(stored, SML, two), SML, two)) == (1, 1)
    assert rows(R.series_of(R.panel_to_all(stored, SML, types), SML, "c3", types["c3"])) == rows(R.panel_to_sml(stored, "c3", types["c3"]))


def test_all_coins_quotes_and_their_titles(spark, rows):
    long = panel(spark, TCE, *QUOTES)
    columns = {"dolar": ["galicia_mostrador_compra_11hs", "frances_electronico_venta_13hs"], "euro": ["galicia_electronico_compra_11hs"]}
    wide = R.panel_to_all(long, TCE, columns)
    assert R.series_of(wide, TCE, "dolar", columns["dolar"]).columns == ["indice_tiempo", *[f"tc_ars_dolar_{c}" for c in columns["dolar"]]]
    back = R.all_to_panel(wide, TCE, columns)
    assert rows(back) == rows(R.concat_panels([R.quotes_to_panel(R.series_of(wide, TCE, c, own)) for c, own in columns.items()]))
    with pytest.raises(ValueError, match="title parts"):
        R.all_to_panel(wide, TCE, {"dolar": ["a_b"]})


def test_more_levels_than_the_bound(spark, rows, monkeypatch):
    long = panel(spark, TCE, *QUOTES, ("2019-04-22", "dolar", None, "mostrador", "compra", "11hs", "1"))
    wide = R.panel_to_quotes(long, "dolar")
    assert R.observed_levels(long, ["entidad_bancaria", "hora"], most=2) == [["frances", "galicia"], ["11hs", "13hs"]]
    assert R.observed_levels(long, ["moneda", "hora"], most=1) is None
    monkeypatch.setattr(R, "COLUMNS", 15)
    cells = R.panel_to_quotes(long, "dolar")
    assert cells.columns == ["indice_tiempo", "title", "valor"]
    melted = wide.selectExpr("indice_tiempo", f"stack(16, {', '.join(f'{chr(39)}{c}{chr(39)}, {c}' for c in wide.columns[1:])}) AS (title, valor)")
    assert rows(cells.where("title IS NOT NULL")) == rows(melted.where("valor IS NOT NULL"))


def test_more_titles_than_the_bound(spark, rows, monkeypatch):
    long = panel(spark, LIBOR, *[("2019-01-01", f"t{i}", str(i + 1)) for i in range(5)])
    assert len(R.panel_to_series_mean(long, F.col("type"), "value").columns) == 6
    monkeypatch.setattr(R.observed_titles, "__defaults__", (4,))
    means = R.panel_to_series_mean(long, F.col("type"), "value")
    assert rows(means) == [(day("2019-01-01"), f"t{i}", Decimal(i + 1)) for i in range(5)]


def test_values_of_ragged_records(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('{"parsed": [{"indice_tiempo": "2019-01-01", "a": "1", "b": null}, {},\n {"c": 2.5}]}')
    (tmp_path / "b.json").write_text('{"parsed": [], "other": 1}')
    (tmp_path / "c.json").write_text("broken")
    records = PJ.read_ragged(spark, str(tmp_path))
    assert rows(Q.value_count(records)) == [(3, 4, 3)]
    assert rows(Q.value_count(records.where("false"))) == [(0, 0, 0)]
