"""Row counts, blank profiles, mergeable profile states and previews (AGG1, AGG2, AGG3, SRT2, PRJ5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import quote
from tidemark.functions.text import is_blank


def blank_profile(df: DataFrame, total_as: str = "total_rows", suffix: str = "_blanks") -> DataFrame:
    """AGG2: one global aggregate -- ``COUNT(*)`` and, per column of the schema,
    ``SUM(CASE WHEN TRIM(CAST(col AS STRING)) = '' OR col IS NULL THEN 1 ELSE 0 END)``.

    A single pass with map-side partial aggregation: each task ships one row.  On an empty
    table the sums are NULL (as in SQL).
    """
    aggs = [F.count(F.lit(1)).alias(total_as)]
    for f in df.schema.fields:
        aggs.append(F.sum(F.when(is_blank(F.col(quote(f.name))), F.lit(1)).otherwise(F.lit(0)))
                    .cast("bigint").alias(f.name + suffix))
    return df.agg(*aggs)


def blank_profile_rows(df: DataFrame, name_as: str = "metric", value_as: str = "value") -> DataFrame:
    """AGG3: the profile transposed -- one row per metric (columns become rows)."""
    prof = blank_profile(df)
    return prof.unpivot([], [quote(c) for c in prof.columns], name_as, value_as)


#: One row per column of a table: everything in it adds up, or is a sketch or extreme that merges.
STATE = "position int, metric string, n_rows bigint, blanks bigint, shortest int, longest int, distinct binary"


def profile_state(df: DataFrame) -> DataFrame:
    """The profile of a table as a state that merges with others: a row per column, of schema ``STATE``.

    ``distinct`` is a HyperLogLog sketch of the values as text (blank ones left out), ``shortest``
    and ``longest`` are lengths of the trimmed text of values that are not blank.  One global aggregate.
    """
    if not df.columns:
        return df.sparkSession.createDataFrame([], STATE)
    stats = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(quote(f.name))
        text = F.when(~is_blank(c), F.trim(c.cast("string")))
        stats.append(F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("metric"), F.count(F.lit(1)).alias("n_rows"),
                              F.count_if(is_blank(c)).alias("blanks"), F.min(F.length(text)).alias("shortest"),
                              F.max(F.length(text)).alias("longest"), F.hll_sketch_agg(text, 12).alias("distinct")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def merge_states(states: DataFrame) -> DataFrame:
    """States of the parts of a table (``part`` names each), merged by column name: schema ``STATE``, a row per column.

    A column that only some parts have counts as blank in the rows of the others.  Order and
    grouping do not matter: merged states merge again.
    """
    merged = states.groupBy("metric").agg(
        F.min("position").alias("position"), F.sum("n_rows").alias("own"), F.sum("blanks").alias("blanks"), F.min("shortest").alias("shortest"),
        F.max("longest").alias("longest"), F.hll_union_agg("distinct").alias("distinct"))
    n_rows = states.groupBy("part").agg(F.max("n_rows").alias("n")).agg(F.sum("n")).scalar()
    out = merged.withColumn("n_rows", n_rows)
    return out.select("position", "metric", "n_rows", (F.col("blanks") + F.col("n_rows") - F.col("own")).alias("blanks"), "shortest", "longest", "distinct")


def state_rows(state: DataFrame, total_as: str = "total_rows", suffix: str = "_blanks") -> DataFrame:
    """AGG3 of a state: the metrics of ``blank_profile_rows``, (metric, value)."""
    rows = state.select(F.concat("metric", F.lit(suffix)).alias("metric"), F.col("blanks").alias("value"))
    return state.agg(F.max("n_rows").alias("value")).select(F.lit(total_as).alias("metric"), "value").unionByName(rows)


def row_count(df: DataFrame) -> int:
    """AGG1."""
    return df.count()


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT2: the first ``n`` rows, for a look (``LIMIT n``); no order is implied."""
    return df.limit(n)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """PRJ5: ``DESCRIBE`` -- (column, type) from the schema, no job runs."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
