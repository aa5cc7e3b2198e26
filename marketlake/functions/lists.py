"""List and text helpers; a place outside a list or text gives NULL, as does a NULL input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_len(items: Column) -> Column:
    """Length as BIGINT; NULL for a NULL list."""
    return F.array_size(items).cast("bigint")


def first_item(items: Column) -> Column:
    """First element, NULL for an empty or NULL list."""
    return F.get(items, F.lit(0))


def key_values(text: Column, pair_sep: str = "/", kv_sep: str = "=") -> Column:
    """Map of the ``key=value`` pieces of a path-like text."""
    pieces = F.filter(F.split(text, pair_sep), lambda p: p.contains(kv_sep))
    return F.map_from_entries(
        F.transform(
            pieces,
            lambda p: F.struct(
                F.substring_index(p, kv_sep, 1).alias("key"),
                F.substr(p, F.instr(p, kv_sep) + 1).alias("value"),
            ),
        )
    )
