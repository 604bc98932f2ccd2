"""Text helpers (FN4, FN5, FN16 and the Python-style strip used by report extraction)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._col import as_col

# Python's str.strip() removes every character for which str.isspace() holds (tabs, CR, NBSP,
# the Unicode space separators ...); Spark's trim() removes only 0x20.  The set is derived by
# that rule and handed to btrim, which strips any of its characters from both ends.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace exactly like Python ``str.strip()``."""
    return F.btrim(as_col(c), F.lit(PY_WHITESPACE))


def trimmed(c) -> Column:
    """SQL ``TRIM`` (spaces only) -- the trim the SQL templates use (FN4)."""
    return F.trim(as_col(c))


def blank_to_null(c) -> Column:
    """``NULLIF(TRIM(x), '')`` (FN5)."""
    t = F.trim(as_col(c))
    return F.nullif(t, F.lit(""))


def is_blank(c) -> Column:
    """``TRIM(CAST(x AS STRING)) = '' OR x IS NULL`` -- never NULL itself (AGG2)."""
    col = as_col(c)
    return F.coalesce(F.trim(col.cast("string")) == F.lit(""), F.lit(False)) | col.isNull()
