"""Codes to labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Device codes and the two robot labels.
DEVICE_LABELS = {"1": "десктоп", "2": "мобильные телефоны", "3": "планшеты", "4": "TV"}
ROBOT_LABELS = {"Люди": 0, "Роботы": 1}


def _lookup(c: Column, table: dict) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def device_label(c: Column) -> Column:
    """Label of a device code; other codes stay as they are."""
    code = c.cast("string")
    return F.coalesce(_lookup(code, DEVICE_LABELS), code)


def robot_flag(c: Column) -> Column:
    return F.coalesce(_lookup(c, ROBOT_LABELS), F.lit(0))
