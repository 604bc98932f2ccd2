from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a Column or a column name; names are back-ticked so ``Pers.No.`` resolves."""
    if isinstance(c, Column):
        return c
    if len(c) > 1 and c[0] == "`" and c[-1] == "`":
        return F.col(c)
    return F.col(quote(c))


def quote(name: str) -> str:
    """Back-tick a column name for ``F.col`` / SQL (names carry dots, spaces, parentheses)."""
    return "`" + name.replace("`", "``") + "`"
