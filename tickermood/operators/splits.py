"""Chronological splits and sequences over daily frames.

As in ``operators.market`` the windows rely on one row per symbol and day.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F


def _cuts(rows: Column, fractions) -> list[Column]:
    """Row numbers where the nested cuts fall: floor(n f1), floor(floor(n f1) f2) ..."""
    cuts, size = [], rows
    for fraction in fractions:
        size = F.floor(size * F.lit(float(fraction)))
        cuts.append(size)
    return cuts


def chrono_split(df: DataFrame, fractions=(0.8,), by="symbol", order="date", out="split") -> DataFrame:
    """Label each symbol's rows by time: earlier rows train, later rows test.

    One fraction gives train and test. A second one cuts the train rows again and
    gives train, valid and test. Order and duplicate rows are kept.
    """
    if len(fractions) not in (1, 2):
        raise ValueError("give one fraction (train) or two (train, then train within train)")
    group = Window.partitionBy(by)
    numbered = df.withColumn("_row", F.row_number().over(group.orderBy(order))).withColumn(
        "_rows", F.count(F.lit(1)).over(group)
    )
    cuts = _cuts(F.col("_rows"), fractions)
    if len(cuts) == 1:
        split = F.when(F.col("_row") <= cuts[0], "train").otherwise("test")
    else:
        split = (
            F.when(F.col("_row") <= cuts[1], "train").when(F.col("_row") <= cuts[0], "valid").otherwise("test")
        )
    return numbered.withColumn(out, split).drop("_row", "_rows")


def except_split(df: DataFrame, fraction=0.8, by="symbol", order="date") -> tuple[DataFrame, DataFrame]:
    """Train rows, and all rows EXCEPT DISTINCT the train rows.

    Kept to compare with ``chrono_split``: the test part loses duplicates and any
    row equal to a train row.
    """
    parts = chrono_split(df, (fraction,), by, [order, *[c for c in df.columns if c not in (by, order)]])
    train = parts.filter(F.col("split") == "train").drop("split")
    return train, df.subtract(train)


def make_sequences(df: DataFrame, cols, target: str, length=10, by="symbol", order="date") -> DataFrame:
    """For each row the ``cols`` of the ``length`` rows before it, and its target.

    Rows with fewer rows before them are left out.
    """
    keys = [by] if isinstance(by, str) else list(by)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(-length, -1)
    row = F.array(*[F.col(c).cast("double") for c in cols])
    return (
        df.withColumn("seq", F.collect_list(row).over(before))
        .filter(F.size("seq") == length)
        .select(*keys, order, "seq", F.col(target).alias("target"))
    )


def sample_arrays(df: DataFrame, cols, target: str, keys=("symbol", "date")) -> DataFrame:
    """(keys, x, label): the inputs of a row as one array, kept distributed."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    return df.select(*keys, x.alias("x"), F.col(target).cast("double").alias("label"))


def latest_row(df: DataFrame, by="symbol", order="date") -> DataFrame:
    """The last row of each symbol, by an aggregate with map-side partials."""
    rest = [c for c in df.columns if c != by]
    return df.groupBy(by).agg(F.max_by(F.struct(*rest), order).alias("last")).select(by, "last.*")
