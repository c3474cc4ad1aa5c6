"""Nested rows to flat tables: structs become ``parent__child`` columns, lists child tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake_case(name: str) -> str:
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"\W+", "_", name).lower()


def _leaves(schema: T.StructType, source: tuple[str, ...], target: str) -> list[tuple[Column, str]]:
    out: list[tuple[Column, str]] = []
    for f in schema.fields:
        path = (*source, f.name)
        name = f"{target}__{snake_case(f.name)}" if target else snake_case(f.name)
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, path, name)
        else:
            column = F.col(".".join(f"`{p}`" for p in path))
            out.append((column, name))
    return out


def flatten_struct(df: DataFrame) -> DataFrame:
    """Every leaf of the nested structs as a column; arrays stay arrays."""
    return df.select(*[c.alias(n) for c, n in _leaves(df.schema, (), "")])


def child_rows(df: DataFrame, column: str, key: Sequence[str], outer: bool = False) -> DataFrame:
    """Rows of a list column with the parent's key and the position ``list_idx``.

    ``outer`` keeps parents with a missing or empty list as one row of NULLs.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    rows = df.select(*key, explode(column).alias("list_idx", "item"))
    if isinstance(rows.schema["item"].dataType, T.StructType):
        return flatten_struct(rows.select(*key, "list_idx", "item.*"))
    return rows.withColumnRenamed("item", "value")
