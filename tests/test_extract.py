from decimal import Decimal

import pytest
from conftest import day
from pyspark.sql import functions as F

from ratepanel.functions import html as H
from ratepanel.operators import extract as X
from ratepanel.plans.pages import pages_to_panel
from ratepanel.schemas import FX, HOURS, LIBOR, SML, TCE
from ratepanel.sources.config import Dims

# Terms, labels, names and numbers here are goldens of the page formats.
TERMS = {"30": "2,481750", "60": "2,558380", "90": "2,625250", "180": "2,671750", "360": "2,840500"}
RATES = Dims(LIBOR, rates={t: f"libor_{t}_dias" for t in TERMS})


def body(*lines):
    return "".join("<tr>" + "".join(f"<td>{c}</td>" for c in line) + "</tr>\n" for line in lines)


def page(spark, html, date="2019-04-24", coin=None):
    return spark.createDataFrame([(coin, day(date), html)], "coin string, indice_tiempo date, html string")


def values(df):
    return {tuple(r)[1:-1]: r[-1] for r in df.collect()}


def test_rate_page(spark):
    html = f"<table><thead><tr><th>Plazo</th></tr></thead><tbody>{body(*TERMS.items())}</tbody></table>"
    raw = X.parse_rate_page(page(spark, html, "2019-03-15").drop("coin"), list(TERMS))
    assert {r.type: r.raw for r in raw.collect()} == TERMS
    panel = values(pages_to_panel(page(spark, html, "2019-03-15"), RATES))
    assert panel[("30",)] == Decimal("0.0248175")
    assert panel[("360",)] == Decimal("0.028405")


def test_rate_page_keeps_known_terms_and_the_last_row(spark):
    html = f"<table><tbody>{body(('30', '1,0'), ('45', '9,0'), ('30', '2,0'), ('60',))}</tbody></table>"
    raw = {r.type: r.raw for r in X.parse_rate_page(page(spark, html), ["30", "60"]).collect()}
    assert raw == {"30": "2,0", "60": None}


FX_HEAD = "<thead><tr><td><b>FECHA</b></td><td>PASE</td><td>CAMBIO</td></tr></thead>"
COINS = Dims(FX, coins={"bolivar_venezolano": "Bolívar Venezolano"})


def fx(spark, *lines, head=FX_HEAD):
    html = f'<table colspan="3">{head}<tbody>{body(*lines)}</tbody></table>'
    return values(pages_to_panel(page(spark, html, "2019-04-08", "bolivar_venezolano"), COINS))


def test_fx_page(spark):
    indent = "\n      "
    got = fx(spark, ("07/04/2019", "1", "2"), [indent + c for c in ("08/04/2019", "0,0003030", "0,0132500")])
    assert got[("bolivar_venezolano", "tp_usd")] == Decimal("0.0003030")
    assert got[("bolivar_venezolano", "tc_local")] == Decimal("0.0132500")


@pytest.mark.parametrize(
    "lines",
    [
        [("09/04/2019", "1", "2")],
        [("al 08/04/2019", "1", "2"), ("08/04/2019", "3", "4")],
        [("08/04/2019", "--------", "--------")],
        [("08/04/2019",)],
    ],
)
def test_fx_page_without_values(spark, lines):
    assert set(fx(spark, *lines).values()) == {None}


def test_fx_page_needs_a_head(spark):
    assert set(fx(spark, ("08/04/2019", "1", "2"), head="").values()) == {None}


LABELS = {
    "Tipo de cambio de Referencia": ("tipo_cambio_referencia", "43,47830"),
    "Tipo de cambio URINUSCA": ("tipo_cambio_urinusca", "34,51000"),
    "Tipo de cambio SML Peso Uruguayo": ("tipo_cambio_sml_peso_urguayo", "1,25990"),
    "Tipo de cambio SML Uruguayo Peso": ("tipo_cambio_sml_uruguayo_peso", "0,79375"),
}
SML_DIMS = Dims(
    SML,
    coins={"peso_uruguayo": "Peso Uruguayo", "real": "Real"},
    types=tuple(("peso_uruguayo", label, c) for label, (c, _) in LABELS.items()) + (("real", "PTAX", "ptax"),),
)


def sml_html(*labels, cells):
    heads = "".join(f"<th>{x}</th>" for x in ("Fecha", *labels))
    return f"<table><thead><tr>{heads}</tr></thead><tbody>{body(('23/04/2019', '1'), cells)}</tbody></table>"


def test_sml_page_follows_its_labels(spark):
    names = list(reversed(LABELS))
    html = sml_html(*names, cells=["24/04/2019", *[LABELS[n][1] for n in names]])
    got = values(pages_to_panel(page(spark, html, coin="peso_uruguayo"), SML_DIMS))
    expected = {("peso_uruguayo", c): Decimal(v.replace(",", ".")) for c, v in LABELS.values()}
    assert got == expected


def test_sml_page_with_a_short_row_or_another_date(spark):
    names = list(LABELS)
    short = sml_html(*names, cells=["24/04/2019", "43,47830"])
    got = values(pages_to_panel(page(spark, short, coin="peso_uruguayo"), SML_DIMS))
    assert got[("peso_uruguayo", "tipo_cambio_referencia")] == Decimal("43.4783")
    assert list(got.values()).count(None) == 3
    other = sml_html(*names, cells=["25/04/2019", "1", "2", "3", "4"])
    assert set(values(pages_to_panel(page(spark, other, coin="peso_uruguayo"), SML_DIMS)).values()) == {None}


BANKS = (("galicia", "BANCO DE GALICIA Y BUENOS AIRES S.A.U.", "Galicia"), ("nadie", "BANCO (X) S.A.", "X"))
CELLS = ["41,800", "43,800", "41,801", "43,801", "41,900", "43,900", "41,901", "43,901", "41,950", "43,950", "41,951", "43,951"]


def quote_dims(channels=("mostrador", "electronico")):
    quotes = tuple(("dolar", b, h, c, True) for b, _, _ in BANKS for h in HOURS for c in channels)
    return Dims(TCE, coins={"dolar": "DOLAR"}, entities=BANKS, quotes=quotes, table_class="table table-x wide")


def quote_html(name=BANKS[0][1]):
    heads = body(["<b>Entidades</b>"], ["11:00 hs.", "13:00 hs.", "15:00 hs."])
    rows = heads + body([f"  {name} ", *CELLS], [name, *["9,9"] * 12])
    first = f"<table class='nav'><tbody>{body([name, *['1,1'] * 12])}</tbody></table>"
    return f"{first}<table class=\"table table-x\n   wide\"><tbody>{rows}</tbody></table>"


def test_quote_page_positions(spark):
    got = values(pages_to_panel(page(spark, quote_html(), "2019-04-22", "dolar"), quote_dims()))
    at = lambda c, f, h: got[("dolar", "galicia", c, f, h)]
    assert len(got) == 24
    assert at("mostrador", "compra", "11hs") == Decimal("41.8")
    assert at("mostrador", "venta", "13hs") == Decimal("43.9")
    assert at("electronico", "compra", "13hs") == Decimal("41.901")
    assert at("electronico", "venta", "15hs") == Decimal("43.951")
    assert {v for k, v in got.items() if k[1] == "nadie"} == {None}


def test_quote_page_reads_configured_channels_only(spark):
    got = values(pages_to_panel(page(spark, quote_html(), coin="dolar"), quote_dims(("mostrador",))))
    channels = {k[2] for k, v in got.items() if v is not None}
    assert len(got) == 24
    assert channels == {"mostrador"}


@pytest.mark.parametrize(
    "html",
    [
        "",
        None,
        "<p>No existen registros</p>",
        "<table><thead><tr><th>No existen registros</th></tr></thead></table>",
        "<table><thead></thead><tbody></tbody></table>",
        "<thead></thead><tbody><tr><td>30</td><td>1,0</td></tr></tbody>",
    ],
)
@pytest.mark.parametrize(
    ("dims", "coin", "cells"), [(RATES, None, 5), (COINS, "bolivar_venezolano", 2), (SML_DIMS, "real", 1), (quote_dims(), "dolar", 24)]
)
def test_damaged_pages_give_null_cells(spark, html, dims, coin, cells):
    got = pages_to_panel(page(spark, html, coin=coin), dims).collect()
    assert len(got) == cells
    assert {r[-1] for r in got} == {None}
    assert {r.indice_tiempo for r in got} == {day("2019-04-24")}


def test_table_text(spark):
    html = (
        "<!-- <table><tbody><tr><td>no</td></tr></tbody></table> --><script>'<table>'</script>"
        "<TABLE><TBODY><TR><TD>a &amp; b</TD><th>&ntilde;&#233;&#xE9;&amp;lt;</th></TR>"
        "<tr class=x><td>\n <b>1</b>,5&nbsp;</td><td>open</tr></TBODY></TABLE><table><tbody><tr><td>2</td></tr></tbody></table>"
    )
    cells = X.html_table_cells(page(spark, html)).select("row_idx", "col_idx", "text").collect()
    assert [tuple(c) for c in cells] == [(0, 0, "a & b"), (0, 1, "ñéé&lt;"), (1, 0, "1,5"), (1, 1, "open")]


def test_long_pages_do_not_overflow_the_matcher(spark):
    lines = "<tr><td><i>x</i> <b>1</b></td></tr>" * 60_000
    count = F.size(F.expr(H.row_texts(H.section(H.first_table("html"), "tbody"))))
    long = page(spark, f"<table><tbody>{lines}</tbody></table>")
    assert long.select(count.alias("n")).first().n == 60_000


def test_offered_coins(spark):
    form = "<select><option>Seleccione Moneda</option><option value=1> Bol&iacute;var Venezolano</option></select>"
    coins = {"bolivar_venezolano": "Bolívar Venezolano", "x": "Boenezol", "y": "Bolívar"}
    assert [r.key for r in X.offered_coins(page(spark, form), coins).collect()] == ["bolivar_venezolano"]


def test_quote_positions_are_the_twelve_cells(spark):
    axes = [(h, c, f) for h in HOURS for c in ("mostrador", "electronico") for f in ("compra", "venta")]
    df = spark.createDataFrame(axes, "h int, c string, f string")
    got = [r.p for r in df.selectExpr(f"{X.quote_position('h', 'c', 'f')} AS p").collect()]
    assert got == list(range(1, 13))


@pytest.mark.parametrize(
    ("raw", "shown"),
    [
        ("&#039;&ordm;&euro;&ccedil;&iquest;", "'º€ç¿"),
        ("&#128512;&#x1F600;&#57344;", "\U0001f600\U0001f600\ue000"),
        ("&#38;lt; &amp;lt; &amp;amp;", "&lt; &lt; &amp;"),
        ("&#0;&#55296;&#99999999999;&#x80;", "\ufffd\ufffd\ufffd€"),
        ("&unknown; & &copy", "&unknown; & &copy"),
        ('<td title="a > b">30</td>', "30"),
    ],
)
def test_clean_text(spark, raw, shown):
    row = spark.createDataFrame([(raw,)], "raw string").selectExpr(f"{H.clean_text('raw')} AS shown").first()
    assert row.shown == shown


def test_open_marks_take_time_in_proportion(spark):
    for mark in ("<!-- x ", "<script> ", "<a ", "<a b='"):
        row = spark.createDataFrame([(mark * 100_000,)], "raw string").selectExpr(f"length({H.clean_text(H.visible('raw'))}) AS n").first()
        assert row.n is not None



INNER = "<table class=in><tbody><tr><td>08/04/2019</td><td>in</td></tr></tbody></table>"


def cells_of(spark, html):
    found = X.html_table_cells(page(spark, html)).select("row_idx", "col_idx", "text").collect()
    return [tuple(c) for c in found]


def test_rows_after_an_inner_table_and_its_own(spark):
    html = f"<table><tbody><tr><td>a</td><td>{INNER}</td><td>b</td></tr><tr><td>c</td></tr></tbody></table>"
    outer = [(0, 0, "a"), (0, 1, "08/04/2019in"), (0, 2, "08/04/2019"), (0, 3, "in"), (0, 4, "b")]
    assert cells_of(spark, html) == [*outer, (1, 0, "08/04/2019"), (1, 1, "in"), (2, 0, "c")]


def test_tables_in_tables_in_tables(spark):
    html = "x"
    for depth in range(6):
        html = f"<TABLE><tbody><tr><td>{depth}</td><td>{html}</td></tr><tr><td>end {depth}</td></tr></tbody></TABLE>"
    rows = [t for _, c, t in cells_of(spark, f"{html}<table><tbody><tr><td>other</td></tr></tbody></table>") if c == 0]
    assert rows == [str(d) for d in range(5, -1, -1)] + [f"end {d}" for d in range(6)]


def test_inner_tables_that_never_end(spark):
    html = "<table><tbody><tr><td>a</td><td><table><tr><td>b</td></tr></td></tr><tr><td>c</td></tr></tbody></table>"
    assert [t for *_, t in cells_of(spark, html)] == ["a", "b", "b", "b", "c"]
    assert cells_of(spark, "</table></tr><table><tbody><tr><td>1</td></tr></tbody><table>") == [(0, 0, "1")]


def test_a_sign_in_a_quoted_attribute_ends_no_tag(spark):
    html = "<table title='a>b'><tbody data-x=\"c>d\"><tr class='e>f'><td title='g>h'>30</td><td id=\"i>\"><b title='>'>x</b></td></tr></tbody></table>"
    assert cells_of(spark, html) == [(0, 0, "30"), (0, 1, "x")]
    nested = html.replace("x</b>", "x</b><table id='>'><tr id='>'><td id='>'>y</td></tr></table>")
    assert [t for *_, t in cells_of(spark, nested)] == ["30", "xy", "y", "y"]
    option = "<select><option label='a>b' value=1>Real</option></select>"
    assert [r.key for r in X.offered_coins(page(spark, option), {"real": "Real"}).collect()] == ["real"]


def test_a_date_is_sought_in_the_rows_own_cells(spark):
    # The outer row only holds the date through its inner table, so the inner row is read.
    outer = f"<tr><td>first</td><td>{INNER.replace('>in<', '>1,5</td><td>2,5<')}</td></tr>"
    html = f"<table>{FX_HEAD}<tbody>{outer}{body(('08/04/2019', '7', '8'))}</tbody></table>"
    got = values(pages_to_panel(page(spark, html, "2019-04-08", "bolivar_venezolano"), COINS))
    assert got[("bolivar_venezolano", "tp_usd")] == Decimal("1.5")
    assert got[("bolivar_venezolano", "tc_local")] == Decimal("2.5")


def test_rates_after_an_inner_table(spark):
    rows = body(("30", "1,0"), (INNER, "9"), ("60", "2,0"))
    raw = X.parse_rate_page(page(spark, f"<table><tbody>{rows}</tbody></table>"), ["30", "60"])
    assert {r.type: r.raw for r in raw.collect()} == {"30": "1,0", "60": "2,0"}


def test_quotes_inside_a_table_for_layout(spark):
    html = f"<table id=layout><tr><td title=\"class='table table-x wide'\">{quote_html()}</td></tr></table>"
    got = values(pages_to_panel(page(spark, html, "2019-04-22", "dolar"), quote_dims()))
    assert got[("dolar", "galicia", "mostrador", "compra", "11hs")] == Decimal("41.8")


@pytest.mark.parametrize(
    ("tag", "found"),
    [
        ("<table class=x>", True),
        ("<TABLE id='class=\"y\"' CLASS = ' x ' data-class=z>", True),
        ("<table disabled class='x'/>", True),
        ("<table data-class='x'>", False),
        ("<table title=' class=x '>", False),
        ("<table class='x y'>", False),
        ("<table classic=x>", False),
    ],
)
def test_class_of_a_table(spark, tag, found):
    row = page(spark, f"<table><tr></tr></table>{tag}<tr>1</tr></table>").selectExpr(f"{H.table_with_class('html', 'x')} AS t").first()
    assert row.t == ("<tr>1</tr>" if found else "")


def test_names_of_all_characters(spark):
    from html import unescape
    from html.entities import html5

    names = [f"&{n}" for n in html5 if n.endswith(";")]
    rows = spark.createDataFrame([(n,) for n in names], "raw string").selectExpr("raw", f"{H.unescape('raw')} AS shown").collect()
    assert {r.raw: r.shown for r in rows} == {n: unescape(n) for n in names}


def test_many_names_in_one_pass(spark):
    """Names that hold, begin or overlap each other, against one search per name."""
    names = ["BANCO A", "BANCO A S.A.", "A S.A. PLUS", "BANCO (X) S.A.", "X", "BANCO A", "S.A."]
    entities = [(f"k{i}", n) for i, n in enumerate(names)]
    lines = [["x"], ["** BANCO A S.A. PLUS", "1"], ["BANCO (X) S.A.", "2"], ["BANCO A", "3"], ["BANCO", "A"], ["a X", "4"], []]
    own = f"transform(array({', '.join('array(' + ', '.join(map(repr, l)) + ')' if l else 'CAST(array() AS ARRAY<STRING>)' for l in lines)}), c -> named_struct('own', c, 'cells', c))"
    got = {r.key: r.cells for r in spark.range(1).selectExpr(f"inline({X.entity_rows(own, entities)})").collect()}
    want = {k: next((line for line in lines if any(n in c for c in line)), None) for k, n in entities}
    assert got == want
    assert spark.range(1).selectExpr(f"size({X.entity_rows(own, [])}) AS n").first().n == 0
