import json

import pytest

from ratepanel.sources import config as C

FLAGS = lambda m, e: {"channels": {"mostrador": m, "electronico": e}}
CONFIG = {
    "libor": {"url": "x", "tries": "3", "rates": {t: f"libor_{t}_dias" for t in ("30", "180", "60", "7", "360", "90")}},
    "exchange-rates": {"coins": {"euro": "Euro", "dong_vietnam_1000_c_u": "Dong Vietnam (c/1.000 u.)"}},
    "sml": {"coins": {"real": "Real"}, "types": {"real": {"PTAX": "tipo_cambio_ptax", "Referencia": "tipo_cambio_referencia"}}},
    "tce": {
        "coins": {"dolar": "DOLAR", "euro": "EURO"},
        "entities": {
            "zeta": {
                "name": "BANCO Z S.A.",
                "title": "Zeta",
                "coins": {"dolar": {"11": FLAGS(True, True), "13": FLAGS(False, True)}, "euro": {"11": FLAGS(False, False)}},
            },
            "alfa": {"name": "BANCO A S.A.", "title": "Alfa", "coins": {"dolar": {"15": FLAGS(True, False)}}},
        },
    },
}


def load(spark, config, section):
    text = config if isinstance(config, str) else json.dumps(config)
    return C.dims_of(spark.createDataFrame([(text,)], "json string"), section)


def test_sections(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps(CONFIG, indent=2), encoding="utf8")
    libor = C.load_dims(spark, str(path), "libor")
    assert libor.header() == ["indice_tiempo", *[f"libor_{t}_dias" for t in ("30", "180", "60", "7", "360", "90")]]
    assert libor.members() == [("30",), ("180",), ("60",), ("7",), ("360",), ("90",)]
    fx = C.load_dims(spark, str(path), "exchange-rates")
    assert fx.header("tc_local") == ["indice_tiempo", "euro", "dong_vietnam_1000_c_u"]
    assert len(fx.members()) == 4
    sml = C.load_dims(spark, str(path), "sml")
    assert sml.header("real") == ["indice_tiempo", "tipo_cambio_ptax", "tipo_cambio_referencia"]
    assert sml.members_frame(spark).count() == 2


def test_quote_header_lists_active_series_in_file_order(spark):
    tce = load(spark, CONFIG, "tce")
    assert tce.header("dolar") == [
        "indice_tiempo",
        "tc_ars_dolar_zeta_mostrador_compra_11hs",
        "tc_ars_dolar_zeta_mostrador_venta_11hs",
        "tc_ars_dolar_zeta_electronico_compra_11hs",
        "tc_ars_dolar_zeta_electronico_venta_11hs",
        "tc_ars_dolar_zeta_electronico_compra_13hs",
        "tc_ars_dolar_zeta_electronico_venta_13hs",
        "tc_ars_dolar_alfa_mostrador_compra_15hs",
        "tc_ars_dolar_alfa_mostrador_venta_15hs",
    ]
    assert tce.header("euro") == ["indice_tiempo"]
    assert len(tce.members()) == 2 * 2 * 12
    assert tce.entities[0] == ("zeta", "BANCO Z S.A.", "Zeta")
    frame = C.parse_config(spark.createDataFrame([(json.dumps(CONFIG),)], "json string"), "tce")
    titles = C.active_columns(C.dim_quote(frame)).orderBy("ord").collect()
    assert [t.title for t in titles] == tce.series("dolar")
    assert [tuple(r) for r in C.dim_entity(frame).collect()] == [(0, "zeta", "BANCO Z S.A.", "Zeta"), (1, "alfa", "BANCO A S.A.", "Alfa")]


@pytest.mark.parametrize(
    ("config", "section"),
    [
        ('{"libor": {', "libor"),
        ({"sml": {}}, "libor"),
        ({"libor": {"foo": "bar"}}, "libor"),
        ({"libor": {"rates": {}}}, "libor"),
        ({"libor": {"rates": {"30": "otra"}}}, "libor"),
        ({"exchange-rates": {"foo": "bar"}}, "exchange-rates"),
        ({"exchange-rates": {"coins": {}}}, "exchange-rates"),
        ({"sml": {"coins": {"real": "Real"}}}, "sml"),
        ({"tce": {"coins": {"dolar": "DOLAR"}}}, "tce"),
        ({"tce": {"coins": {"dolar": "DOLAR"}, "entities": {}}}, "tce"),
        (CONFIG, "other"),
    ],
)
def test_errors(spark, config, section):
    with pytest.raises(ValueError):
        load(spark, config, section)
