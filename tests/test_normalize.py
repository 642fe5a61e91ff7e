from decimal import Decimal

import pytest
from conftest import day
from pyspark.sql import functions as F

from ratepanel.functions import normalize as N
from ratepanel.functions import titles as T
from ratepanel.schemas import FX, LIBOR, TCE, VALUE


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "expected"),
    [("43,47830", "43.47830"), ("40.48170", "40.48170"), ("41.500", "41.5"), ("0.0", "0"), ("", None), ("n/d", None)],
)
def test_comma_decimals(spark, text, expected):
    got = one(spark, N.parse_decimal_comma(F.lit(text)))
    assert got == (Decimal(expected) if expected else None)


@pytest.mark.parametrize(
    ("text", "expected"),
    [("0,0003040", "0.0003040"), ("1.289,6300000", "1289.63"), ("--------", None), ("-1,5", None), ("", None), (None, None)],
)
def test_grouped_decimals_without_dashes(spark, text, expected):
    got = one(spark, N.parse_decimal_grouped(N.dash_to_null(F.lit(text).cast("string"))))
    assert got == (Decimal(expected) if expected else None)


@pytest.mark.parametrize(("text", "expected"), [("1.234,5", "1234.5"), ("1234.5", "1234.5"), ("41,800", "41.8")])
def test_mixed_decimals(spark, text, expected):
    assert one(spark, N.parse_decimal_mixed(F.lit(text))) == Decimal(expected)


def test_percent_is_exact_and_keeps_the_type(spark):
    ratio = N.percent_to_ratio(N.parse_decimal_comma(F.lit("2,472630")))
    df = spark.range(1).select(ratio.alias("x"))
    assert df.first().x == Decimal("0.0247263")
    assert df.schema["x"].dataType == VALUE


@pytest.mark.parametrize(("value", "panel", "cell"), [("0", None, None), ("-2", None, "-2"), ("3", "3", "3")])
def test_values_without_data(spark, value, panel, cell):
    number = F.lit(Decimal(value))
    as_text = lambda x: None if x is None else str(int(x))
    assert as_text(one(spark, N.nonpositive_to_null(number))) == panel
    assert as_text(one(spark, N.zero_to_null(number))) == cell


@pytest.mark.parametrize(
    ("text", "expected"),
    [("01/04/2019", "2019-04-01"), ("2019-04-01", "2019-04-01"), ("31/02/2019", None), ("hoy", None)],
)
def test_dates_in_both_spellings(spark, text, expected):
    assert one(spark, N.parse_date_any(F.lit(text))) == (day(expected) if expected else None)


def test_date_text(spark):
    assert one(spark, N.format_date(F.lit(day("2019-04-01")))) == "01/04/2019"


@pytest.mark.parametrize(
    ("given", "expected"),
    [("2019-03-18", "2019-03-15"), ("2019-03-19", "2019-03-18"), ("2019-03-24", "2019-03-22"), ("2019-03-23", "2019-03-22")],
)
def test_previous_business_day(spark, given, expected):
    assert one(spark, N.previous_business_day(F.lit(day(given)))) == day(expected)


def test_titles_and_their_parts(spark):
    title = "tc_ars_dolar_galicia_mostrador_compra_11hs"
    dims = {"moneda": "dolar", "entidad_bancaria": "galicia", "canal": "mostrador", "flujo": "compra", "hora": "11hs"}
    assert T.parts_of(TCE, title) == dims
    assert T.title_of(TCE, tuple(dims.values())) == title
    assert T.parts_of(LIBOR, "libor_30_dias") == {"type": "30"}
    assert T.parts_of(FX, "bolivar_venezolano") == {"coin": "bolivar_venezolano"}
    columns = [F.lit(v).alias(k) for k, v in dims.items()]
    assert spark.range(1).select(*columns).select(T.compose_title(TCE).alias("t")).first().t == title
    with pytest.raises(ValueError, match="7 title parts"):
        T.parts_of(TCE, "tc_ars_dolar")
    with pytest.raises(ValueError, match="3 title parts"):
        T.parts_of(LIBOR, "libor_30")


def test_split_title_rejects_another_count(spark):
    titles = spark.createDataFrame([("a_b_c",), ("a_b",)], "t string")
    assert titles.where("t = 'a_b_c'").select(T.split_title("t", 3).alias("p")).first().p == ["a", "b", "c"]
    with pytest.raises(Exception, match="expected 3 title parts"):
        titles.select(T.split_title("t", 3).alias("p")).collect()
