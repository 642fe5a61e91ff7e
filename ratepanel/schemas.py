"""Column layouts, and the few things in which the four families differ."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DATE = "indice_tiempo"
VALUE = T.DecimalType(24, 10)

PAGES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("coin", T.StringType()),
        T.StructField(DATE, T.DateType()),
        T.StructField("html", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Family:
    """One family of rates.

    ``dims`` are the panel's columns between the date and the value, in file
    order. ``page_dim`` is the dimension a page is published for (none when one
    page covers all). ``member`` is the dimension whose members get a series
    table each, and ``title_dims`` name the columns of that table.
    """

    name: str
    dims: tuple[str, ...]
    value: str
    page_dim: str | None
    member: str | None
    title_dims: tuple[str, ...]
    prefix: tuple[str, ...] = ()
    suffix: tuple[str, ...] = ()
    #: The name of the form's field that lists the days with pages, where a run's start depends on it.
    form_dates: str | None = None

    @property
    def page_key(self) -> list[str]:
        return [DATE] + ([self.page_dim] if self.page_dim else [])

    @property
    def columns(self) -> list[str]:
        return [DATE, *self.dims, self.value]

    @property
    def panel_schema(self) -> T.StructType:
        fields = [T.StructField(DATE, T.DateType())]
        fields += [T.StructField(d, T.StringType()) for d in self.dims]
        return T.StructType(fields + [T.StructField(self.value, VALUE)])


# Family names, panel column names, title affixes and the form field are the
# published file formats.
LIBOR = Family(
    name="libor",
    dims=("type",),
    value="value",
    page_dim=None,
    member=None,
    title_dims=("type",),
    prefix=("libor",),
    suffix=("dias",),
)
FX = Family(
    name="exchange-rates",
    dims=("coin", "type"),
    value="value",
    page_dim="coin",
    member="type",
    title_dims=("coin",),
    form_dates="Fecha",
)
SML = Family(
    name="sml",
    dims=("coin", "type"),
    value="value",
    page_dim="coin",
    member="coin",
    title_dims=("type",),
)
TCE = Family(
    name="tce",
    dims=("moneda", "entidad_bancaria", "canal", "flujo", "hora"),
    value="valor",
    page_dim="moneda",
    member="moneda",
    title_dims=("moneda", "entidad_bancaria", "canal", "flujo", "hora"),
    prefix=("tc", "ars"),
)

FAMILIES = {f.name: f for f in (LIBOR, FX, SML, TCE)}

# The two measures of an FX page and the axes of a quote table.
FX_TYPES = ("tc_local", "tp_usd")
HOURS = (11, 13, 15)
CHANNELS = ("mostrador", "electronico")
FLOWS = ("compra", "venta")
