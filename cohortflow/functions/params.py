"""Extractors for ``ARRAY<STRUCT<key, value STRUCT<...>>>`` parameter bags.

The bag is an array, not a map: the first entry with the key wins, duplicate
keys are allowed, and an empty or missing bag yields NULL. ``get`` returns NULL
for an out-of-range index, where ``[0]`` / ``element_at`` raise under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_entry(bag: Column | str, key: str) -> Column:
    bag = F.col(bag) if isinstance(bag, str) else bag
    return F.get(F.filter(bag, lambda x: x["key"] == F.lit(key)), 0)


def param_int(bag: Column | str, key: str) -> Column:
    return _first_entry(bag, key)["value"]["int_value"]


def param_string(bag: Column | str, key: str) -> Column:
    return _first_entry(bag, key)["value"]["string_value"]


def param_number(bag: Column | str, key: str) -> Column:
    """A key whose value lands in the int slot for some rows and the float /
    double slots for others, folded to one DOUBLE."""
    v = _first_entry(bag, key)["value"]
    return F.coalesce(v["int_value"].cast("double"), v["double_value"], v["float_value"])


def user_property(bag: Column | str, key: str, slot: str = "string_value") -> Column:
    """Same extraction over ``user_properties`` (slot: string/int/float/double
    value or ``set_timestamp_micros``)."""
    return _first_entry(bag, key)["value"][slot]
