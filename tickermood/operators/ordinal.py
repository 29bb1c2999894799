"""Row numbers for groups of any size."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickermood.session import saved


def ranged(df: DataFrame, *order, part="_part") -> DataFrame:
    """``df`` with the number of the equal-frequency range that its row falls into.

    Range partitioning samples the rows for its bounds, so an outlier or a crowded
    stretch of keys widens no range beyond about its share; equal keys stay together.
    The numbers are written with the rows: what is computed from them later agrees,
    whatever is computed again.
    """
    return saved(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")


def earlier_parts(rows: DataFrame, by, value: Column, part="_part", out="_before") -> DataFrame:
    """``(part, by..., out)``: the sum of ``value`` over the earlier parts of each group."""
    by = list(by)
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(part, *by).agg(value.alias("_sum"))
    return sums.select(part, *by, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(out))


def article_ordinal(df: DataFrame, by, order, key, tie_break=(), out="ordinal") -> DataFrame:
    """Number the rows of each ``by`` group 1, 2, 3 ... by ``order``, ``key`` and ``tie_break``.

    One stock in one fetch window may hold a large part of all articles, so no
    task sorts a whole group: the rows are dealt out in ranges of equal size, numbered
    inside a range, and the rows of a group in earlier ranges are added. All columns of
    ``df`` travel; give it the narrow ones.
    """
    by = list(by)
    columns = [F.col(c) if isinstance(c, str) else c for c in (*by, *order, key, *tie_break)]
    rows = ranged(df, *columns)
    inside = Window.partitionBy("_part", *by).orderBy(*order, key, *tie_break)
    before = earlier_parts(rows, by, F.count(F.lit(1)))
    # A struct as key: its nulls compare as equal.
    cell = F.struct("_part", *by).alias("_cell")
    numbered = rows.withColumn("_row", F.row_number().over(inside)).withColumn("_cell", cell)
    met = numbered.join(before.select(cell, "_before"), "_cell")
    return met.select(*df.columns, (F.col("_before") + F.col("_row")).alias(out))
