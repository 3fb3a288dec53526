"""Keyed lookups in the ``event_params`` array of structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _params(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def param_lookup(key: str, params: str | Column = "event_params") -> Column:
    """The first element whose key equals ``key`` (NULL when absent or when
    the array is NULL).

    A plain projection: no unnest, no join. ``event_params.key`` is the array
    of keys, ``array_position`` finds the first match (0 when absent) and
    ``get`` returns NULL for the resulting -1; all three are generated code,
    unlike a lambda ``filter``."""
    arr = _params(params)
    return F.get(arr, (F.array_position(arr["key"], F.lit(key)) - 1).cast("int"))


def param_value(key: str, slot: str, params: str | Column = "event_params") -> Column:
    """The typed slot (``int_value``, ``string_value``) of a keyed param."""
    return param_lookup(key, params)["value"][slot]


def param_key_count(key: str, params: str | Column = "event_params") -> Column:
    """How often ``key`` occurs in one event's params (0 when the array is NULL)."""
    keys = _params(params)["key"]
    return F.coalesce(F.size(keys) - F.size(F.array_remove(keys, F.lit(key))), F.lit(0))
