"""Ordered list aggregates used by the reports.

Lists are built as ``ARRAY<STRUCT<order, value>>`` and rendered to the
reference's delimited strings only at the report edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ordered_values(order: Column, value: Column) -> Column:
    """Aggregate: values sorted by ``order`` (an array of ``value``)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))),
                       lambda s: s["v"])


def render(values: Column, sep: str = ", ", trailing: bool = False) -> Column:
    """Join an array; ``trailing`` adds the separator after every item (the
    reference's ``a, b, `` style); an empty array renders as ''."""
    joined = F.array_join(values, sep)
    if trailing:
        return F.when(F.size(values) > 0, F.concat(joined, F.lit(sep))).otherwise(F.lit(""))
    return F.coalesce(joined, F.lit(""))


def chunked_lists(rows: DataFrame, group: list[str], size: int, sep: str = ", ") -> DataFrame:
    """Ordered lists of any length as numbered chunks: per group (null-free
    columns) ``chunk`` (from 1), ``n_values`` and ``items``, the chunk's values
    joined. ``rows`` has ``no`` (from 1, the value's place in an order that all
    groups share, once per group) and ``value``. A chunk holds the values of
    ``size`` places, so none is larger, however many a group has; the chunks of a
    group, joined in order, are its list."""
    cut = rows.withColumn("_cell", F.expr(f"(no - 1) div {size}"))
    # Chunk numbers come from counts, without the values.
    cells = cut.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("n_values"))
    cells = cells.withColumn("chunk", F.row_number().over(Window.partitionBy(*group).orderBy("_cell")))
    texts = cut.groupBy(*group, "_cell").agg(F.array_join(ordered_values(F.col("no"), F.col("value")), sep).alias("items"))
    return texts.join(cells, [*group, "_cell"]).select(*group, "chunk", "n_values", "items")
