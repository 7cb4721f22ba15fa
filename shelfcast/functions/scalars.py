"""Scalar expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.fixed_values import FEATURE_FAMILIES


def at_least(value: Column, bound: float) -> Column:
    """Lower clamp that keeps null; ``greatest`` alone would skip it."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(bound)))


def round_price(price: Column, floor: float | None = None) -> Column:
    """Price in cents, optionally with a lowest price; decimal rounding, half up."""
    cents = F.round(price.cast("decimal(20,6)"), 2).cast("double")
    return cents if floor is None else at_least(cents, floor)


def log_sales(sales: Column) -> Column:
    return F.log1p(at_least(sales, 0.0))


def unlog_sales(value: Column) -> Column:
    return at_least(F.expm1(value), 0.0)


def series_id(item: Column, store: Column, suffix: str | None = None) -> Column:
    parts = [item, store] + ([F.lit(suffix)] if suffix else [])
    return F.concat_ws("_", *parts)


def state_of_store(store: Column) -> Column:
    return F.split(store, "_").getItem(0)


def has_event(event_name: Column, encoded: bool = False) -> Column:
    """1 on a day with an event; an encoded column marks "none" by -1."""
    present = event_name.isNotNull()
    if encoded:
        present = present & (event_name != -1)
    return F.coalesce(present, F.lit(False)).cast("int")


def feature_family(name: Column) -> Column:
    """Family of a model input by the first word list that matches its name."""

    def matches(words: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [name.contains(w) for w in words])

    (first, words), *rest = FEATURE_FAMILIES
    family = F.when(matches(words), first)
    for label, words in rest:
        family = family.when(matches(words), label)
    return family.otherwise("other")


def percent_change(new: Column, old: Column) -> Column:
    """Change against ``old`` in percent; 0 when ``old`` is 0 or missing."""
    usable = old.isNotNull() & (old != 0)
    return F.when(usable, (new - old) * 100 / F.abs(F.when(usable, old))).otherwise(F.lit(0.0))
