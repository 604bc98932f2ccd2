"""Overlap joins of inputs that are stored by the same key: no shuffle of the fact (JN1, JN2).

Where fact and dimensions are bucketed alike, every bucket of the fact joins the same bucket of each
dimension in place: a sort-merge join on the key, the overlap as residual.  That compares each fact
with all dimension rows of its key, which is fine while a key has few, and its task holds the whole
key.  So keys with more than ``hot_rows`` fact rows, counted first, go the way of the time-bucketed
join, which splits a key; if there are none that way is not in the plan at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import as_col, quote
from tidemark.operators.temporal import DimSpec, overlap_left_join

HOT_ROWS = 100_000


def hot_keys(fact: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, fewer than rows / ``hot_rows`` of them; a NULL key counts as blank."""
    k = F.coalesce(as_col(key), F.lit("")).alias("hot")
    return fact.groupBy(k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select("hot")


def colocated_left_join(fact: DataFrame, key: str, valid_from: str, valid_to: str, dims: Sequence[DimSpec], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``overlap_left_join`` of inputs bucketed by their keys (``read_bucketed``).

    Keys are compared as stored; a dimension's must be trimmed when it is written.  The order of
    columns is that of ``overlap_left_join``.
    """
    spark = fact.sparkSession
    hot = [r.hot for r in hot_keys(fact, key, hot_rows).collect()]
    k, f0, f1 = as_col(key), as_col(valid_from), as_col(valid_to)
    cold = fact
    if hot:
        hot_table = F.broadcast(spark.createDataFrame([(h,) for h in hot], "hot string"))
        is_hot = F.coalesce(k, F.lit("")) == F.col("hot")
        cold = fact.join(hot_table, is_hot, "left_anti")
    out = cold
    for i, d in enumerate(dims):
        names = {as_: src for as_, src in [(d.from_as, d.valid_from), (d.to_as, d.valid_to), *d.attributes.items()]}
        # the key keeps its name: a renamed bucket column still is one, an expression would not be
        side = d.df.select(as_col(d.key).alias(f"_co{i}"), *[F.col(quote(src)).alias(as_) for as_, src in names.items()]).hint("shuffle_merge")
        on = (k == F.col(f"_co{i}")) & (k != "") & (f0 <= F.col(quote(d.to_as))) & (f1 >= F.col(quote(d.from_as)))
        out = out.join(side, on, "left").drop(f"_co{i}")
    if hot:
        apart = fact.join(hot_table, is_hot, "left_semi")
        few = [DimSpec(d.df.join(hot_table, as_col(d.key) == F.col("hot"), "left_semi"), d.key, d.valid_from, d.valid_to, d.attributes, d.from_as, d.to_as, trim_key=False) for d in dims]
        out = out.unionByName(overlap_left_join(apart, key, valid_from, valid_to, few))
    return out
