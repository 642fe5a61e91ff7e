"""Series column names, their parts, and the metadata made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratepanel.schemas import Family

# Currency codes in series identifiers.
ISO_CODES = {"dolar": "usd", "euro": "eur"}


def join_title(parts: Sequence[Column | str]) -> Column:
    """Parts joined by ``_``; null when any part is null."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    spaced = [cols[0]]
    for c in cols[1:]:
        spaced += [F.lit("_"), c]
    return F.concat(*spaced)


def compose_title(family: Family) -> Column:
    """The series column a panel row belongs to."""
    affix = lambda words: [F.lit(w) for w in words]
    return join_title(affix(family.prefix) + list(family.title_dims) + affix(family.suffix))


def title_of(family: Family, values: Sequence[str]) -> str:
    """``compose_title`` for known dimension values."""
    return "_".join([*family.prefix, *values, *family.suffix])


def split_title(title: Column | str, count: int) -> Column:
    """Title parts as an array; a title with another number of parts fails."""
    title = F.col(title) if isinstance(title, str) else title
    parts = F.split(title, "_", -1)
    problem = F.concat(F.lit(f"expected {count} title parts: "), title)
    return F.when(F.size(parts) == count, parts).when(title.isNotNull(), F.raise_error(problem))


def parts_of(family: Family, title: str) -> dict[str, str]:
    """Dimension values in a column name, checked against the family's form."""
    parts = title.split("_")
    lead, tail = len(family.prefix), len(family.suffix)
    expected = lead + len(family.title_dims) + tail
    if len(family.title_dims) == 1 and not lead and not tail:
        return {family.title_dims[0]: title}
    if len(parts) != expected:
        raise ValueError(f"expected {expected} title parts: {title}")
    return dict(zip(family.title_dims, parts[lead : lead + len(family.title_dims)], strict=True))


def iso_code(coin: Column, codes: Mapping[str, str] = ISO_CODES) -> Column:
    """Currency code of a coin; null for a coin without one."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), coin)


def series_id(iso: Column, entity: Column, channel: Column, flow: Column, hour: Column) -> Column:
    """``tc_usd_galicia_mc11``: initials of channel and flow, two digits of hour."""
    tail = F.concat(F.substring(channel, 1, 1), F.substring(flow, 1, 1), F.substring(hour, 1, 2))
    return join_title([F.lit("tc"), iso, entity, tail])


def series_description(
    iso: Column, entity_title: Column, channel: Column, flow: Column, hour: Column
) -> Column:
    """One sentence per part, as published in the series catalogue."""
    return F.concat(
        F.lit("Tipo de cambio ARS/"),
        F.upper(iso),
        F.lit(". "),
        entity_title,
        F.lit(". "),
        F.initcap(channel),
        F.lit(". "),
        F.initcap(flow),
        F.lit(". "),
        hour,
        F.lit("."),
    )
