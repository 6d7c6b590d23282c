"""JSON, map and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_json_map(text: Column) -> Column:
    """JSON object as a map of texts; NULL when the text is not an object."""
    return F.from_json(text, "MAP<STRING,STRING>")


def json_path_text(document: Column, path: str) -> Column:
    """Value at ``path`` as JSON text, so a string keeps its quotes."""
    return F.to_json(F.variant_get(F.try_parse_json(document), path, "variant"))


def map_value(mapping: Column, key: str, default: str) -> Column:
    """Value of ``key`` or the default."""
    return F.coalesce(F.try_element_at(mapping, F.lit(key)), F.lit(default))


def merge_maps(left: Column, right: Column) -> Column:
    """Both maps in one; the right side wins on a shared key."""
    kept = F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key))
    return F.map_concat(kept, right)


def head(array: Column, n: int) -> Column:
    """First ``n`` elements."""
    return F.slice(array, 1, n)


def tail(array: Column, n: int) -> Column:
    """Last ``n`` elements, all of them when there are fewer."""
    return F.when(F.size(array) <= n, array).otherwise(F.slice(array, -n, n))
