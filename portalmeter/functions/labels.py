"""Labels and fixed row orders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed


def label_of(value: Column, labels: Mapping[str, str]) -> Column:
    """The label of ``value``, NULL where it has none."""
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.create_map(*pairs)[value]


def place_of(value: Column, order: Iterable[str]) -> Column:
    """Position in a fixed order, from 1; values outside it come after all others."""
    places = list(order)
    position = F.array_position(F.array(*[F.lit(v) for v in places]), value)
    return F.when(position > 0, position).otherwise(F.lit(len(places) + 1))


def level_label(org_code: Column, missing: str | None = None) -> Column:
    """Administration level from the first letter of an organisation's code."""
    label = label_of(F.substring(org_code, 1, 1), fixed.LEVEL_LABELS)
    return label if missing is None else F.coalesce(label, F.lit(missing))
