"""Configuration JSON to dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.functions.titles import title_of
from ratepanel.schemas import CHANNELS, DATE, FAMILIES, FLOWS, FX_TYPES, HOURS, Family

_SECTION = """
    rates: MAP<STRING, STRING>,
    coins: MAP<STRING, STRING>,
    types: MAP<STRING, MAP<STRING, STRING>>,
    entities: MAP<STRING, STRUCT<
        name: STRING,
        title: STRING,
        coins: MAP<STRING, MAP<STRING, STRUCT<channels: MAP<STRING, BOOLEAN>>>>
    >>,
    table_class: STRING
"""

# Parts each family's section must have, with at least one entry.
REQUIRED = {
    "libor": ("rates",),
    "exchange-rates": ("coins",),
    "sml": ("coins", "types"),
    "tce": ("coins", "entities"),
}


def parse_config(configs: DataFrame, section: str) -> DataFrame:
    """One section of a ``json`` text column as typed maps; null when it is malformed."""
    kind = f"MAP<STRING, STRUCT<{_SECTION}>>"
    parsed = configs.select(F.from_json("json", kind).alias("_all"))
    return parsed.select(F.try_element_at("_all", F.lit(section)).alias("section")).select("section.*")


def dim_rate(config: DataFrame) -> DataFrame:
    """``ord``, ``term``, ``column``."""
    return config.select(F.posexplode("rates").alias("ord", "term", "column"))


def dim_coin(config: DataFrame) -> DataFrame:
    """``ord``, ``key``, ``label``."""
    return config.select(F.posexplode("coins").alias("ord", "key", "label"))


def dim_type(config: DataFrame) -> DataFrame:
    """``coin``, ``ord``, ``label``, ``column``."""
    return config.select(F.explode("types").alias("coin", "_types")).select(
        "coin", F.posexplode("_types").alias("ord", "label", "column")
    )


def dim_entity(config: DataFrame) -> DataFrame:
    """``ord``, ``key``, ``name``, ``title``."""
    return config.select(F.posexplode("entities").alias("ord", "key", "_e")).select(
        "ord", "key", F.col("_e.name").alias("name"), F.col("_e.title").alias("title")
    )


def dim_quote(config: DataFrame) -> DataFrame:
    """Configured quotes in file order: ``coin``, ``entity``, ``hour``, ``channel``, ``flow``, ``active``, ``ord``."""
    entities = config.select(F.posexplode("entities").alias("_i", "entity", "_e"))
    coins = entities.select("_i", "entity", F.explode("_e.coins").alias("coin", "_hours"))
    hours = coins.select("_i", "entity", "coin", F.posexplode("_hours").alias("_j", "hour", "_h"))
    channels = hours.select(
        "_i", "entity", "coin", "_j", "hour", F.posexplode("_h.channels").alias("_k", "channel", "active")
    )
    flows = F.array(*[F.lit(f) for f in FLOWS])
    return channels.select("*", F.posexplode(flows).alias("_l", "flow")).select(
        "coin", "entity", "hour", "channel", "flow", "active", F.struct("_i", "_j", "_k", "_l").alias("ord")
    )


def active_columns(quotes: DataFrame) -> DataFrame:
    """Titles of the quotes that are switched on: ``coin``, ``title``, ``ord``."""
    hour = F.concat("hour", F.lit("hs"))
    parts = ["coin", "entity", "channel", "flow"]
    title = F.concat_ws("_", F.lit("tc"), F.lit("ars"), *parts, hour)
    return quotes.where("active").select("coin", title.alias("title"), "ord")


@dataclass(frozen=True)
class Dims:
    """One family's configuration, in file order.

    It names columns and plan constants, so it lives on the driver; its size is
    that of a hand-written file.
    """

    family: Family
    rates: dict[str, str] = field(default_factory=dict)
    coins: dict[str, str] = field(default_factory=dict)
    types: tuple[tuple[str, str, str], ...] = ()
    entities: tuple[tuple[str, str, str], ...] = ()
    quotes: tuple[tuple[str, str, int, str, bool], ...] = ()
    table_class: str | None = None

    @property
    def page_coins(self) -> list[str | None]:
        return list(self.coins) if self.family.page_dim else [None]

    def only(self, coins: dict[str, str]) -> Dims:
        """The same with these coins only."""
        return replace(self, coins=coins)

    def members(self) -> list[tuple[str, ...]]:
        """Dimension values of every cell a full set of pages holds for one date."""
        match self.family.name:
            case "libor":
                return [(t,) for t in self.rates]
            case "exchange-rates":
                return [(c, t) for c in self.coins for t in FX_TYPES]
            case "sml":
                return [(c, column) for c, _, column in self.types if c in self.coins]
            case _:
                return [
                    (coin, key, channel, flow, f"{hour}hs")
                    for coin in self.coins
                    for key, _, _ in self.entities
                    for hour in HOURS
                    for channel in CHANNELS
                    for flow in FLOWS
                ]

    def series(self, member: str | None = None) -> list[str]:
        """Series columns of one member in file order; switched-off quotes are left out."""
        match self.family.name:
            case "libor":
                return list(self.rates.values())
            case "exchange-rates":
                return list(self.coins)
            case "sml":
                return [column for c, _, column in self.types if c == member]
            case _:
                return [
                    title_of(self.family, (coin, entity, channel, flow, f"{hour}hs"))
                    for coin, entity, hour, channel, active in self.quotes
                    if active and coin == member
                    for flow in FLOWS
                ]

    def header(self, member: str | None = None) -> list[str]:
        return [DATE, *self.series(member)]

    def members_frame(self, spark: SparkSession) -> DataFrame:
        """``members`` as a table of known size."""
        columns = list(zip(*self.members(), strict=True)) or [[] for _ in self.family.dims]
        arrays = [pa.array(list(c), pa.string()) for c in columns]
        return spark.createDataFrame(pa.table(dict(zip(self.family.dims, arrays, strict=True))))

    def rate_frame(self, spark: SparkSession) -> DataFrame:
        terms = pa.array(list(self.rates), pa.string())
        columns = pa.array(list(self.rates.values()), pa.string())
        return spark.createDataFrame(pa.table({"term": terms, "column": columns}))


def check_rates(rates: dict[str, str]) -> None:
    """Each term's column must carry the published name."""
    family = FAMILIES["libor"]
    for term in rates:
        if title_of(family, (term,)) not in rates.values():
            raise ValueError(f"rates: no column named {title_of(family, (term,))}")


def load_dims(spark: SparkSession, path: str, section: str) -> Dims:
    """Read and check one section of a configuration file."""
    text = spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")
    return dims_of(text, section)


def dims_of(configs: DataFrame, section: str) -> Dims:
    """``load_dims`` for a table with one ``json`` text."""
    if section not in FAMILIES:
        raise ValueError(f"unknown section: {section}")
    config = parse_config(configs, section)
    # Maps lose their order on the way to the driver, arrays of entries do not.
    row = config.selectExpr(
        "map_entries(rates) AS rates",
        "map_entries(coins) AS coins",
        "flatten(transform(map_entries(types), t -> transform(map_entries(t.value),"
        " c -> struct(t.key AS coin, c.key AS label, c.value AS column)))) AS types",
        "transform(map_entries(entities), e -> struct(e.key, e.value.name, e.value.title)) AS entities",
        "table_class",
    ).first()
    if row is None or all(part is None for part in row):
        raise ValueError(f"the configuration is malformed or has no section {section}")
    for part in REQUIRED[section]:
        if row[part] is None:
            raise ValueError(f"the section {section} has no {part}")
        if not row[part]:
            raise ValueError(f"the section {section} has empty {part}")
    rates = dict(row.rates or ())
    if section == "libor":
        check_rates(rates)
    quotes = dim_quote(config).where(F.col("flow") == FLOWS[0]).orderBy("ord").collect() if row.entities else []
    return Dims(
        family=FAMILIES[section],
        rates=rates,
        coins=dict(row.coins or ()),
        types=tuple(tuple(t) for t in row.types or ()),
        entities=tuple(tuple(e) for e in row.entities or ()),
        quotes=tuple((q.coin, q.entity, int(q.hour), q.channel, q.active) for q in quotes),
        table_class=row.table_class,
    )
