"""Where a posting is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L
from .identity import literal_map
from .text import any_of, text

_PLACE = rf"(?i)(?<![a-z])(?:{any_of(L.PLACES)})(?![a-z])"


def country_code(name: Column | str) -> Column:
    return F.coalesce(F.try_element_at(literal_map(L.COUNTRY_CODES), F.lower(F.trim(text(name)))), F.lit(""))


def code_is_israel(code: Column | str) -> Column:
    return F.upper(F.trim(text(code))).isin("IL", "ISR")


def names_israel(*columns: Column | str) -> Column:
    found = [text(c).rlike(_PLACE) for c in columns]
    return F.array_contains(F.array(*found), True) if len(found) > 1 else found[0]


def is_israel(code: Column | str = "country_code", location: Column | str = "location", url: Column | str = "url") -> Column:
    """A country code decides alone; without one the location, then the url, is searched for places."""
    return F.when(code_is_israel(code), True).when(F.trim(text(code)) != "", False).when(names_israel(location), True).otherwise(names_israel(url))


def city(location: Column | str) -> Column:
    """One label for a place: the first part that is no region, under its usual name."""
    parts = F.filter(F.transform(F.split(text(location), r"\s[-/]\s|,"), lambda x: F.trim(x)), lambda x: x != "")
    kept = F.filter(parts, lambda x: ~F.lower(x).isin(*L.REGIONS_DROPPED))
    first = F.coalesce(F.try_element_at(kept, F.lit(1)), F.try_element_at(parts, F.lit(1)), F.lit(""))
    return F.when(F.lower(first).isin("", "israel", "isr", "il"), "Israel (unspecified)").otherwise(F.coalesce(F.try_element_at(literal_map(L.CITY_NAMES), F.lower(first)), first))
