"""Long panels to wide series and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratepanel.functions.normalize import zero_to_null
from ratepanel.functions.sql import name, struct, text
from ratepanel.functions.titles import compose_title, join_title, parts_of, title_of
from ratepanel.schemas import DATE, FX, FX_TYPES, LIBOR, SML, TCE, Family

# Up to this many series one pass of conditional sums is the smallest shuffle;
# beyond it rows are first reduced to cells, then laid out.
CONDITIONAL_COLUMNS = 16


def columns_except(df: DataFrame, key: str = DATE) -> list[str]:
    """All columns but the date."""
    return [c for c in df.columns if c != key]


def concat_panels(panels: Sequence[DataFrame]) -> DataFrame:
    """Stack the panels of several coins or types."""
    return reduce(DataFrame.unionByName, panels)


def by_member(panel: DataFrame, dim: str, member: str) -> DataFrame:
    return panel.where(F.col(dim) == member)


def rename_panel(panel: DataFrame, names: Mapping[str, str], family: Family) -> DataFrame:
    """Other column names to the published ones, in file order."""
    return panel.withColumnsRenamed(dict(names)).select(*family.columns)


# English column names of older quote panels.
QUOTE_NAMES = {
    "coin": "moneda",
    "entity": "entidad_bancaria",
    "channel": "canal",
    "flow": "flujo",
    "hour": "hora",
    "value": "valor",
}


def keep_columns(series: DataFrame, header: Sequence[str]) -> DataFrame:
    """Drop the series that are not in the header; the header's order wins."""
    present = set(series.columns)
    return series.select(*[c for c in header if c in present])


def wide_to_long(
    series: DataFrame, columns: Mapping[str, Mapping[str, str]], family: Family
) -> DataFrame:
    """One row per date and column, nulls kept, values that are not positive nulled.

    ``columns`` gives the dimension values of each column. They are plan
    constants, so no title is taken apart per row, and nothing is shuffled.
    """
    def cell(column: str, dims: Mapping[str, str]) -> str:
        value = f"CASE WHEN {name(column)} > 0 THEN {name(column)} END"
        return struct({**{d: text(dims[d]) for d in family.dims}, family.value: value})

    cells = ", ".join(cell(column, dims) for column, dims in columns.items())
    return series.selectExpr(DATE, f"inline(array({cells}))")


def rates_to_panel(series: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``libor_{term}_dias`` columns to (date, type, value)."""
    names = columns or columns_except(series)
    return wide_to_long(series, {c: parts_of(LIBOR, c) for c in names}, LIBOR)


def fx_to_panel(tc_local: DataFrame, tp_usd: DataFrame) -> DataFrame:
    """Coin columns of both measures to (date, coin, type, value).

    Empty unless both measures have rows.
    """
    both = tc_local.exists() & tp_usd.exists()
    panels = [
        wide_to_long(df, {c: {"coin": c, "type": measure} for c in columns_except(df)}, FX)
        for measure, df in zip(FX_TYPES, (tc_local, tp_usd), strict=True)
    ]
    return concat_panels(panels).where(both)


def sml_to_panel(series: Mapping[str, DataFrame]) -> DataFrame:
    """Type columns of each coin's series to (date, coin, type, value)."""
    return concat_panels(
        [
            wide_to_long(df, {c: {"coin": coin, "type": c} for c in columns_except(df)}, SML)
            for coin, df in series.items()
        ]
    )


def quotes_to_panel(series: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quote columns to the seven-column panel, dimensions taken from the titles."""
    names = columns or columns_except(series)
    return wide_to_long(series, {c: parts_of(TCE, c) for c in names}, TCE)


def _index(index: str | Sequence[str]) -> list[str]:
    return [index] if isinstance(index, str) else list(index)


def pivot_sum(
    cells: DataFrame, key: Column, members: Mapping[str, str], value: str, index: str | Sequence[str] = DATE
) -> DataFrame:
    """Sum per date and member, one column per member; zero and no data are null.

    ``members`` maps the key's value to a column name. Every date (or other
    index) of ``cells`` keeps its row, also when none of its members is asked for. The value type
    is kept. Both plans combine before they shuffle, so a date or member with a
    large share of the rows costs no more than another.
    """
    kind, rows = cells.schema[value].dataType, _index(index)
    if len(members) <= CONDITIONAL_COLUMNS:
        keyed = cells.select(*rows, key.alias("_key"), value)

        def total(member: str) -> str:
            summed = f"sum({name(value)}) FILTER (WHERE _key = {text(member)})"
            return f"CAST(nullif({summed}, 0) AS {kind.simpleString()})"

        sums = [F.expr(total(m)).alias(column) for m, column in members.items()]
        return keyed.groupBy(*rows).agg(*sums)
    listed = f"CASE WHEN _key IN ({', '.join(map(text, members))}) THEN _key END AS _key"
    summed = (
        cells.select(*rows, key.alias("_key"), value)
        .selectExpr(*map(name, rows), listed, name(value))
        .groupBy(*rows, "_key")
        .agg(zero_to_null(F.sum(value)).cast(kind).alias("_cell"))
    )
    return _lay_out(summed, members, rows)


def _lay_out(cells: DataFrame, members: Mapping[str, str], rows: Sequence[str]) -> DataFrame:
    """One row per date from unique (date, ``_key``, ``_cell``) rows.

    Moving the cells to their date first lets both steps of the pivot run in
    place; otherwise each task would ship a full-width partial row per date.
    """
    return (
        cells.repartition(*rows)
        .groupBy(*rows)
        .pivot("_key", list(members))
        .agg(F.max("_cell"))
        .withColumnsRenamed({m: column for m, column in members.items() if m != column})
    )


def panel_to_rates(panel: DataFrame, terms: Mapping[str, str]) -> DataFrame:
    """Term panel to wide; ``terms`` maps a term to its column."""
    return pivot_sum(panel, F.col("type"), terms, LIBOR.value)


def panel_to_fx(panel: DataFrame, measure: str, coins: Sequence[str]) -> DataFrame:
    """One measure to wide, one column per coin."""
    one = by_member(panel, "type", measure)
    return pivot_sum(one, F.col("coin"), {c: c for c in coins}, FX.value)


def panel_to_sml(panel: DataFrame, coin: str, types: Sequence[str]) -> DataFrame:
    """One coin to wide, one column per type."""
    one = by_member(panel, "coin", coin)
    return pivot_sum(one, F.col("type"), {t: t for t in types}, SML.value)


def other_dims(family: Family) -> list[str]:
    """What a family's titles name besides the member that has a table of its own."""
    return [d for d in family.title_dims if d != family.member]


def panel_to_all(panel: DataFrame, family: Family, members: Mapping[str, Sequence[str]]) -> DataFrame:
    """The series of all members in one table: a row per date and member.

    ``members`` lists the columns of each, named by ``other_dims``. The member is
    part of the index, so the panel is read and moved once however many there are.
    """
    columns = dict.fromkeys(c for own in members.values() for c in own)
    own = panel.where(F.col(family.member).isin(list(members)))
    return pivot_sum(own, join_title(other_dims(family)), {c: c for c in columns}, family.value, [DATE, family.member])


def series_of(series: DataFrame, family: Family, member: str, columns: Sequence[str]) -> DataFrame:
    """One member's table out of ``panel_to_all``, under its titles."""
    titled = family.member in family.title_dims
    titles = {c: title_of(family, (member, *c.split("_"))) if titled else c for c in columns}
    return by_member(series, family.member, member).select(DATE, *[F.col(c).alias(t) for c, t in titles.items()])


def all_to_panel(series: DataFrame, family: Family, members: Mapping[str, Sequence[str]]) -> DataFrame:
    """``panel_to_all`` back to the panel, each member with its own columns only, nulls kept."""
    dims = other_dims(family)

    def cell(column: str) -> str:
        parts = [column] if len(dims) == 1 else column.split("_")
        if len(parts) != len(dims):
            raise ValueError(f"expected {len(dims)} title parts: {column}")
        value = f"CASE WHEN {name(column)} > 0 THEN {name(column)} END"
        return struct({"_column": text(column), **{d: text(v) for d, v in zip(dims, parts, strict=True)}, family.value: value})

    columns = dict.fromkeys(c for own in members.values() for c in own)
    known = ", ".join(f"{text(m)}, array({', '.join(map(text, own))})" for m, own in members.items())
    own = f"array_contains(try_element_at(map({known}), {name(family.member)}), cell._column)"
    cells = f"filter(array({', '.join(map(cell, columns))}), cell -> {own})"
    return series.selectExpr(DATE, name(family.member), f"inline({cells})").select(*family.columns)


#: Values of a dimension, and columns, up to which a wide form is made of what occurs.
LEVELS, COLUMNS = 2000, 10_000


def observed_levels(panel: DataFrame, dims: Sequence[str], most: int = LEVELS) -> list[list[str]] | None:
    """Sorted distinct values of each dimension, from one pass over the panel; None when one has more than ``most``.

    Only distinct values are moved, whatever their share of the rows, and no
    more reach the driver than the bound allows.
    """
    pairs = ", ".join(struct({"dim": text(d), "level": f"CAST({name(d)} AS STRING)"}) for d in dims)
    found = panel.selectExpr(f"inline(array({pairs}))").where("level IS NOT NULL").distinct()
    seen: dict[str, list[str]] = {d: [] for d in dims}
    for row in found.limit(most * len(dims) + 1).collect():
        seen[row.dim].append(row.level)
    return None if any(len(levels) > most for levels in seen.values()) else [sorted(seen[d]) for d in dims]


def product_titles(family: Family, member: str, levels: Sequence[Sequence[str]]) -> dict[str, str]:
    """Titles of the full product of dimension values for one coin."""
    titles = [title_of(family, (member, *combo)) for combo in product(*levels)]
    return {t: t for t in titles}


def panel_to_quotes(
    panel: DataFrame, coin: str, levels: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """One coin's quotes to wide.

    Columns are the full product of entities, channels, flows and hours, as
    given or as observed for the coin; combinations never seen are all null.
    When more than ``COLUMNS`` would come of what is observed, the cells stay
    long: date, ``title`` and value.
    """
    one = by_member(panel, "moneda", coin)
    if levels is None:
        levels = observed_levels(one, TCE.title_dims[1:])
        if levels is None or prod(map(len, levels)) > COLUMNS:
            return long_sums(one, compose_title(TCE), TCE.value)
    return pivot_sum(one, compose_title(TCE), product_titles(TCE, coin, levels), TCE.value)


def long_sums(panel: DataFrame, title: Column, value: str) -> DataFrame:
    """What ``pivot_sum`` holds, one row per cell: date, ``title`` and value, without null cells."""
    kind = panel.schema[value].dataType
    summed = panel.groupBy(DATE, title.alias("title")).agg(zero_to_null(F.sum(value)).cast(kind).alias(value))
    return summed.where(F.col(value).isNotNull())


def observed_titles(panel: DataFrame, title: Column, value: str, most: int = COLUMNS) -> list[str] | None:
    """Sorted titles that have at least one value; None when there are more than ``most``."""
    seen = panel.where(F.col(value).isNotNull()).select(title.alias("title")).distinct().limit(most + 1).collect()
    return None if len(seen) > most else sorted(r.title for r in seen)


def panel_to_series_mean(
    panel: DataFrame,
    title: Column,
    value: str,
    titles: Sequence[str] | None = None,
    index: str = DATE,
) -> DataFrame:
    """Mean per date and title; dates and titles without any value are left out.

    Titles are those given or those that occur; when more than ``COLUMNS`` do,
    the means stay long: date, ``title`` and value.
    """
    valued = panel.where(F.col(value).isNotNull())
    cells = valued.select(index, title.alias("_key"), value).groupBy(index, "_key").agg(F.avg(value).alias("_cell"))
    titles = titles or observed_titles(panel, title, value)
    if titles is None:
        return cells.select(index, F.col("_key").alias("title"), F.col("_cell").alias(value))
    return _lay_out(cells, {t: t for t in titles}, [index])
