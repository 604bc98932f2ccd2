"""Projections: strict ``* EXCEPT`` (PRJ1/PRJ2), renames (PRJ3), DATE->text (PRJ4), schema (PRJ5)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidemark.functions._col import quote


class UnknownColumnError(ValueError):
    """An excluded / renamed column does not exist (the source engine's bind error)."""


def resolve(df: DataFrame, name: str) -> str:
    """Case-insensitive name resolution, as in both SQL engines; error if absent."""
    lower = name.lower()
    for c in df.columns:
        if c.lower() == lower:
            return c
    raise UnknownColumnError(f"column {name!r} not found among {df.columns}")


def rest_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Columns of ``df`` in order, minus ``exclude``; unknown names raise (``df.drop`` is silent)."""
    gone = {resolve(df, n).lower() for n in exclude}
    return [c for c in df.columns if c.lower() not in gone]


def star_except(df: DataFrame, exclude: Iterable[str], leading: Sequence[Column] = ()) -> DataFrame:
    """``SELECT <leading>, * EXCEPT (<exclude>)`` with the strictness of the source SQL."""
    rest = [F.col(quote(c)) for c in rest_columns(df, exclude)]
    return df.select(*leading, *rest)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ3: rename to business names (strict: every source name must exist)."""
    return df.withColumnsRenamed({resolve(df, k): v for k, v in mapping.items()})


def date_columns(df: DataFrame) -> list[str]:
    """PRJ5: names of the DATE columns, from the schema (``DESCRIBE``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, DateType)]


def dates_to_string(df: DataFrame) -> DataFrame:
    """Every DATE column cast to text in place; other columns unchanged."""
    dates = set(date_columns(df))
    return df.select(*[F.col(quote(c)).cast("string").alias(c) if c in dates else F.col(quote(c))
                       for c in df.columns])
